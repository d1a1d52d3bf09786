"""Calls level by level give what a walk through each document gives, and a repeated run asks nothing again."""

import pytest

from lectern.operators import generate, tree


class Plain:
    """Requests that are their texts."""

    def system(self):
        return ""

    def chunk(self, name, at, of, text, glossary):
        return text

    def merge(self, name, at, of, notes, glossary):
        return "+".join(notes)

    def final(self, name, notes, glossary):
        return "=".join([*notes, *glossary])

    def repair(self, name, notes, glossary, broken):
        return f"{broken}!" + "=".join(notes)


class Asks:
    """Shortens what it is asked, fails at marked words, and notes each call in a shared folder."""

    def __init__(self, folder=None):
        self.folder = folder

    def call(self, system, user, most_tokens=None):
        import uuid
        from pathlib import Path

        if self.folder:
            Path(self.folder, uuid.uuid4().hex).write_text(user)
        for word, error in (("QUOTA", "HTTP 429"), ("BOOM", "boom")):
            if word in user:
                raise RuntimeError(error)
        return f"<{user[:9]}{len(user)}{'/' + str(most_tokens) if most_tokens else ''}>"


DOCS = [
    ("long", [f"chunk {i} of many" for i in range(100)], ["t"]), ("one", ["short"], None), ("none", [], []), ("null", None, None), ("quota", ["a", "QUOTA x", "BOOM", "b"], []),
    ("boom", ["a", "b", "BOOM", "QUOTA"], []), ("late", ["ok"] * 5, ["QUOTA"]), ("late boom", ["ok"] * 40, ["BOOM"]),
]
SCHEMA = "path string, chunks array<string>, glossary array<string>"


@pytest.mark.parametrize("limit", [60, 100_000])
def test_equals_a_walk_through_each_document(spark, tmp_path, limit):
    df = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    more = {"prompts": Plain(), "merge_limit": limit, "tries": 1, "complete": lambda t: not t.startswith("<<")}
    want = sorted(tuple(r) for r in generate.map_reduce(df, Asks(), **more).collect())
    got = sorted(tuple(r) for r in tree.generate(df, Asks(), f"{tmp_path}/run", **more).collect())
    assert got == want and {r[1] for r in got} == {"done", "failed", "partial"}


def test_repairs(spark, tmp_path):
    df = spark.createDataFrame([(f"d{i}", ["x" * (i + 1)], []) for i in range(6)], SCHEMA)
    more = {"prompts": Plain(), "complete": lambda t: len(t) % 3 == 0, "repairs": 2, "base_tokens": 100}
    want = sorted(tuple(r) for r in generate.map_reduce(df, Asks(), **more).collect())
    assert sorted(tuple(r) for r in tree.generate(df, Asks(), f"{tmp_path}/run", **more).collect()) == want


def test_a_repeated_run_reads_whole_levels_and_makes_the_others(spark, tmp_path):
    import shutil

    df = spark.createDataFrame([d for d in DOCS if d[0] in ("long", "one", "none")], SCHEMA)
    first, again = tmp_path / "first", tmp_path / "again"
    first.mkdir(), again.mkdir()
    more = {"prompts": Plain(), "merge_limit": 60}
    want = sorted(tuple(r) for r in tree.generate(df, Asks(str(first)), f"{tmp_path}/run", **more).collect())
    assert len(list(first.iterdir())) == 101 + 17 + 3 + 3  # chunks, two levels of merges, final texts
    (tmp_path / "run/level=2/_SUCCESS").unlink()  # as if the run had ended there
    shutil.rmtree(tmp_path / "run" / "final")
    got = sorted(tuple(r) for r in tree.generate(df, Asks(str(again)), f"{tmp_path}/run", **more).collect())
    assert got == want and len(list(again.iterdir())) == 3 + 3


def test_a_long_document_is_dealt_over_tasks(spark, tmp_path):
    df = spark.createDataFrame([("p", [f"c{i}" for i in range(1000)], [])], SCHEMA)
    tree.generate(df, Asks(), f"{tmp_path}/run", prompts=Plain(), merge_limit=500).collect()
    files = spark.read.parquet(f"{tmp_path}/run/level=0").inputFiles()
    assert len(files) > 1


def test_tasks_of_a_level_do_not_grow_beyond_the_cores(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([(f"p{k}", [f"c{i}" for i in range(tree.CALLS_A_TASK)], []) for k in range(20 * cores)], SCHEMA)
    tree.generate(df, Asks(), f"{tmp_path}/run", prompts=Plain(), merge_limit=10**6).collect()
    files = spark.read.parquet(f"{tmp_path}/run/level=0").inputFiles()
    assert cores < len(files) <= tree.TASKS_A_CORE * cores
