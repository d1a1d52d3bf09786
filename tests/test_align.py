"""Running maxima give the greedy walk, for files of any length and in blocks of any size."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import align, running, search


def walk(script, entries):
    out, at = [], 0
    for line, text in script:
        found = next((k for k in range(at, len(entries)) if entries[k][2] == text), None)
        out.append((line, entries[found][1] if found is not None else ""))
        at = len(entries) if found is None else found + 1
    return out


def made(seed, letters):
    rng = random.Random(seed)
    entries = [(3 * i + rng.randint(0, 2), f"t{i}", rng.choice(letters)) for i in range(rng.randint(0, 25))]
    kept = [e for e in entries if rng.random() < 0.7]
    script = [(5 * i, e[2] if rng.random() < 0.93 else rng.choice([*letters, "new"])) for i, e in enumerate(kept)]
    if rng.random() < 0.3:
        rng.shuffle(script)
        script = [(i, t) for i, (_, t) in enumerate(script)]
    return script, entries


@pytest.mark.parametrize(("block", "letters"), [(100_000, "abcdefghijklmnop"), (4, "ab"), (9, "abc"), (7, "a")])
def test_equals_the_walk(spark, monkeypatch, block, letters):
    monkeypatch.setattr(running, "BLOCK", block)
    files = {f"f{i}": made(i * 31 + block, letters) for i in range(25)}
    script = spark.createDataFrame([(p, n, t) for p, (s, _) in files.items() for n, t in s], "path string, line_no int, text string").repartition(4)
    timed = spark.createDataFrame([(p, *e) for p, (_, es) in files.items() for e in es], "path string, line_no int, timestamp string, text string").repartition(3)
    want = sorted((p, n, t) for p, (s, es) in files.items() for n, t in walk(s, es))
    assert sorted(tuple(r) for r in align.greedy(script, timed).collect()) == want
    assert sorted(tuple(r) for r in search.align(script, timed).collect()) == want


def test_files_without_lines_or_entries(spark):
    script = spark.createDataFrame([("p", 1, "a"), ("q", 1, None)], "path string, line_no int, text string")
    none = spark.createDataFrame([], "path string, line_no int, timestamp string, text string")
    assert sorted(tuple(r) for r in align.greedy(script, none).collect()) == [("p", 1, ""), ("q", 1, "")]
    assert align.greedy(script.limit(0), none).count() == 0


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sums_and_maxima(spark, monkeypatch, inclusive):
    monkeypatch.setattr(running, "BLOCK", 6)
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), i, rng.randint(-9, 9)) for i in rng.sample(range(200), 90)] + [(None, 1, 5), ("x", None, 5)]
    df = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    got_sum = {(r["k"], r["at"]): r["n"] for r in running.running(df, ["k"], "at", F.col("v"), "n", inclusive=inclusive).collect()}
    got_max = {(r["k"], r["at"]): r["n"] for r in running.running(df, ["k"], "at", F.col("v"), "n", how="max", inclusive=inclusive).collect()}
    whole = [r for r in rows if None not in r]
    assert len(got_sum) == len(whole)
    for k, at, _ in whole:
        before = [v for kk, a, v in whole if kk == k and (a < at or inclusive and a == at)]
        assert got_sum[k, at] == sum(before) and got_max[k, at] == max(before, default=None)


def test_budgets(spark):
    df = spark.createDataFrame([(1, 4), (2, None), (3, 5), (4, 2), (5, 0)], "id long, n long").repartition(3)
    assert sorted((r["id"], r["spent"]) for r in running.within_budget(df, 10, F.col("n"), "id").collect()) == [(1, 0), (2, 4), (3, 4)]


def test_files_of_few_entries_take_no_rounds(spark, monkeypatch):
    """Repeated texts of which each waits for the one before: as many rounds as lines, before."""

    def rounds(*_):
        raise AssertionError("a short file by rounds")

    monkeypatch.setattr(align, "_raised", rounds)
    texts = [t for i in range(40) for t in ("ab" if i % 3 else "bba")]
    entries = [(i, f"t{i}", t) for i, t in enumerate(texts)]
    script = [(i, t) for i, t in enumerate(texts) if i % 7 != 3]
    rows = spark.createDataFrame([(p, *s) for p in (1, 2) for s in script], "path long, line_no int, text string").repartition(3)
    timed = spark.createDataFrame([(p, *e) for p in (1, 2) for e in entries], "path long, line_no int, timestamp string, text string").repartition(2)
    want = sorted((p, *x) for p in (1, 2) for x in walk(script, entries))
    assert sorted(tuple(r) for r in align.greedy(rows, timed).collect()) == want
