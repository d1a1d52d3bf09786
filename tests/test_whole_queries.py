"""Registered queries do their operator's whole job, on small tables; those without SQL equal slow versions."""

import difflib
import hashlib
import re

import pytest

from lectern.plans import catalogue, derived


def run(name, spark, sf):
    return catalogue.queries()[name](spark, str(sf)).collect()


def documents(spark, sf, texts):
    spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")


def dictionary(spark, sf, benchmark):
    spark.createDataFrame(list(enumerate(benchmark)), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(i, f"NATION_{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{sf}/nation.parquet")


def test_notes_are_whole(spark, tmp_path):
    turns = [(1, i, f"turn {i} of a conversation, which goes on after its twentieth character: {i}") for i in range(5)]
    spark.createDataFrame([(c, t, "user", x) for c, t, x in turns], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["group"]: (r["n_chars"], r["note_md5"]) for r in run("conversation_notes_whole", spark, tmp_path)}
    notes = ["\n\n====\n\n".join(x for _, _, x in turns[a : a + 3]) for a in (0, 3)]
    assert got == {k: (len(n), hashlib.md5(n.encode()).hexdigest()) for k, n in enumerate(notes)}


def test_reports_have_all_patterns_times_and_files(spark, tmp_path):
    docs = [(1, "the idiot\n0:07\nthe password and\n0:09 화자 2\ntoken = x"), (2, "nothing here"), (3, "Licensed under it")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["line"]: r["n"] for r in run("report_lines_whole", spark, tmp_path)}
    hits = {"- 1:1 [--:--] the idiot": 2, "- 1:3 [0:07] the password and": 3, "- 1:5 [0:09] token = x": 1, "- 3:1 [--:--] Licensed under it": 1}
    assert {k: n for k, n in got.items() if "[" in k} == hits
    assert {"- files_scanned: 3", "- unique_groups: 6", "- total_hits: 7", "## the", "## and", "## password", "## idiot", "## token = ", "## Licensed under"} <= set(got)


def test_rule_order_has_all_rules(spark, tmp_path):
    dictionary(spark, tmp_path, ["some words of an item", "other words"])
    rows = sorted(run("rule_order", spark, tmp_path), key=lambda r: r["ord"])
    assert [r["ord"] for r in rows] == list(range(len(rows)))
    sizes = [len(r["wrong"]) for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    said = {derived.in_syllables(w) for w in "some words of an item other".split()}
    assert said <= {r["wrong"] for r in rows} and len({(r["wrong"], r["right"]) for r in rows}) == len(rows)


TEXTS = ["some words, Some swords of other word items", "an item of others\nand other items", "swords of an items word somes", ""]


def test_usage_of_thousands_of_rules(spark, tmp_path):
    documents(spark, tmp_path, TEXTS)
    said = "some word words of an item items other osme ord rdwo no"
    spark.createDataFrame([(1, 0, "user", said)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rules = sorted({w for w in said.split() if 2 <= len(w) <= 12}, key=lambda w: (-len(w), w))
    want = {}
    for text in TEXTS:
        for w in rules:
            if n := text.count(w):
                want[w, w[1:] + w[0]] = want.get((w, w[1:] + w[0]), 0) + n
                text = text.replace(w, w[1:] + w[0])
    assert {(r["wrong"], r["right"]): r["uses"] for r in run("fold_thousands_usage", spark, tmp_path)} == want


def test_similar_words(spark, tmp_path):
    documents(spark, tmp_path, TEXTS)
    dictionary(spark, tmp_path, ["some words of seven item others", "wordsa itemes"])
    split = lambda texts: sorted({derived.in_syllables(w) for t in texts for w in re.findall("[A-Za-z0-9]+", t) if 2 <= len(w) <= 12})
    stems, terms, want = split(TEXTS), split(["some words of seven item others", "wordsa itemes"]), set()
    for s in stems:
        if len(s) >= 3 and (found := difflib.get_close_matches(s, terms, n=1, cutoff=0.85)):
            ratio = difflib.SequenceMatcher(None, s, found[0]).ratio()
            if abs(len(s) - len(found[0])) <= 1 and ratio >= 0.85:
                want.add((s, found[0], ratio))
    assert {tuple(r) for r in run("similar_words", spark, tmp_path)} == want and want
    fuzzy = run("fuzzy_suggest", spark, tmp_path)
    assert {r["reason"].split(":")[0] for r in fuzzy} <= {"similarity", "single-char-diff+별", "digit->korean"}


def test_documents_teach_those_after_them(spark, tmp_path):
    from test_feedback import walk

    from lectern.operators.rewrite import Rules

    documents(spark, tmp_path, TEXTS)
    items = ["some words of an item other"]
    dictionary(spark, tmp_path, items)
    ko = derived.in_syllables
    manual = [(w, w[::-1]) for w in sorted({ko(w) for w in items[0].split()}) if w != w[::-1]]
    pairs = [(ko(f"NATION_{i} de"), ko(f"NATION_{i}")) for i in range(3)]
    want, lessons = walk([(i, ko(t)) for i, t in enumerate(TEXTS)], Rules(), pairs, manual)
    got = {r["path"]: r for r in run("feedback_order", spark, tmp_path)}
    assert {i: r["text_md5"] for i, r in got.items()} == {i: hashlib.md5(t.encode()).hexdigest() for i, (t, _) in want.items()}
    assert {i: r["applied"] for i, r in got.items()} == {i: sum(s[3] for s in stats) for i, (_, stats) in want.items()}
    assert [tuple(r)[1:] for r in sorted(run("feedback_lessons", spark, tmp_path), key=lambda r: r["seq"])] == lessons and lessons


def test_concept_lists(spark, tmp_path):
    documents(spark, tmp_path, [*TEXTS, "as class as ass glass a b"])
    want = {}
    for i, text in enumerate([*TEXTS, "as class as ass glass a b"]):
        out = []
        for w in re.findall("[A-Za-z0-9]+", text.lower())[:40]:
            if len(out) < 10 and not any(x == w or (w in x and len(w) <= 2) for x in out):
                out.append(w)
        want[i] = " ".join(out)
    assert {r["path"]: r["concepts"] for r in run("concept_lists", spark, tmp_path)} == want


def test_study_sections_have_every_part(spark, tmp_path):
    documents(spark, tmp_path, TEXTS)
    rows = run("study_sections", spark, tmp_path)
    assert {r["part"] for r in rows} == {0, 1, 2, 3, 4} and len(rows) == 5 * len(TEXTS)


@pytest.mark.parametrize("name", ["fold_thousands", "aligned_lines", "tree_notes", "similar_words", "feedback_order", "budget_files"])
def test_empty_tables(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    dictionary(spark, tmp_path, [])
    assert run(name, spark, tmp_path) == []
