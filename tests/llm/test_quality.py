import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import common
from lectern.llm import quality as q
from tests_llm_cases import empty, odd, words


def slow_model(texts, order=q.ORDER):
    """Interpolated modified Kneser-Ney by the textbook, over tuples."""
    counts = {order: Counter(tuple([0] * (order - 1) + [b + 1 for b in t.encode()])[i : i + order] for t in texts for i in range(len(t.encode())))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc, after = {}, {}
    for k, c in counts.items():
        n = [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        own = [i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1] for i in (1, 2, 3)] if min(n) else [-1]
        disc[k] = own if all(0 < d <= i for i, d in enumerate(own, 1)) else [0.5, 1.0, 1.5]
        after[k] = defaultdict(list)
        for g, v in c.items():
            after[k][g[:-1]].append(v)
    size = len(counts[1]) + 1

    def p(g):
        if not g:
            return 1 / size
        k, seen = len(g), after[len(g)].get(g[:-1])
        if not seen:
            return p(g[1:])
        cut = lambda v: disc[k][min(v, 3) - 1]
        c = counts[k].get(g, 0)
        return (max(c - cut(c), 0) if c else 0) / sum(seen) + sum(map(cut, seen)) / sum(seen) * p(g[1:])

    return p


def slow_score(p, text):
    s = [0] * (q.ORDER - 1) + [b + 1 for b in text.encode()]
    n = len(text.encode())
    return -sum(math.log(p(tuple(s[i : i + q.ORDER]))) for i in range(n)) / n


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


CORPUS = {i: words(25, i) + ". É" for i in range(20)} | {50: "ZZZ!!! QQ 中中 𝒳", 51: "z", 52: words(3, 90), 53: "中文字" * 40}


@pytest.mark.parametrize(("block", "slice_", "piece"), [(q.BLOCK_BYTES, q.SLICE, q.PIECE), (300, 100, 7)])
def test_scores_equal_the_textbook(spark, monkeypatch, block, slice_, piece):
    for name, value in (("BLOCK_BYTES", block), ("SLICE", slice_), ("PIECE", piece)):
        monkeypatch.setattr(q, name, value)
    docs = spark.createDataFrame(list(CORPUS.items()), "doc_id long, text string").selectExpr("*", "'en' lang").repartition(3)
    marks = labels(spark, [(i, 1, 0) for i in range(15)] + [(50, 0, 0), (None, 1, 0), (1, 0, 0)])
    ids = spark.range(15).where(~q.is_held_out(F.col("id"))).collect()
    p = slow_model([CORPUS[r["id"]] for r in ids])
    assert 5 < len(ids) < 15
    got = {r["doc_id"]: r for r in q.score(docs, marks).collect()}
    assert got.keys() == CORPUS.keys()
    assert all(abs(got[i]["log_ppl"] - slow_score(p, t)) < 1e-9 for i, t in CORPUS.items())
    assert got[50]["rejected"]


def test_what_the_filter_lets_through_is_not_counted(spark, monkeypatch):
    docs = spark.createDataFrame(list(CORPUS.items()), "doc_id long, text string").selectExpr("*", "'en' lang")
    marks = labels(spark, [(i, 1, 0) for i in range(15)])
    want = {r["doc_id"]: r["log_ppl"] for r in q.score(docs, marks).collect()}
    monkeypatch.setattr(q, "bloom_filter", lambda keys: np.full(common.FILTER_BITS // 8, 255, np.uint8))
    got = {r["doc_id"]: r["log_ppl"] for r in q.score(docs, marks).collect()}
    assert all(abs(got[i] - x) < 1e-9 for i, x in want.items())


def test_the_limit_is_a_quantile_of_held_out_documents_of_the_language(spark):
    held = [r["id"] for r in spark.range(400).where(q.is_held_out(F.col("id"))).collect()]
    docs = spark.createDataFrame([(i, words(20 + i % 7, i), "de" if i % 2 else "en") for i in range(400)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in q.score(docs, labels(spark, [(i, 1, 0) for i in range(400)])).collect()}
    for lang in ("de", "en"):
        own = sorted(got[i]["log_ppl"] for i in held if got[i]["lang"] == lang)
        assert len(own) >= q.OWN_LIMIT
        mark = own[math.ceil(q.HIGH * len(own)) - 1]
        assert all(abs(r["limit"] - mark - q.SHORT_SLACK / math.sqrt(len(words(20 + i % 7, i)))) < 1e-9 for i, r in got.items() if r["lang"] == lang)


def test_null_and_empty_languages_are_two(spark):
    rows = [(i, words(20, i), None if i % 2 else "") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = q.score(docs, labels(spark, [(i, 1, 0) for i in range(400)])).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(400))
    assert {r["lang"] for r in got} == {None, ""}


def test_rows_that_pass_keep_their_columns(spark):
    marks = labels(spark, [(i, 1, 0) for i in (4, 5, 6, 7, 8, 9, 10, 11)])
    got = q.passed(odd(spark), marks)
    assert got.columns == odd(spark).columns
    kept = sorted(map(str, got.collect()))
    scores = q.score(odd(spark), marks).collect()
    assert len(kept) == sum(not r["rejected"] for r in scores)
    assert set(kept) <= {str(r) for r in odd(spark).collect()}
    assert q.passed(empty(spark), marks).count() == 0


def test_odd_rows(spark):
    got = q.score(odd(spark), labels(spark, [*((i, 1, 0) for i in (5, 6, 7, 8, 9, 11)), (10, 1, None), (4, None, 1), (6, 0, 0)])).collect()
    assert len(got) == 13
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["perplexity"] is None and by[i]["rejected"] for i in (1, 2))
    assert by[4]["log_ppl"] is not None and len([r for r in got if r["doc_id"] == 6]) == 2
    none = q.score(odd(spark), labels(spark, []))
    assert {r["doc_id"] for r in none.where("rejected").collect()} == {1, 2}
    assert q.score(empty(spark), labels(spark, [(1, 1, 0)])).count() == 0


def test_grams_pack_symbols():
    g, own = q.grams([b"ab", b"", "é".encode()])
    assert own.tolist() == [0, 0, 2, 2] and g[0] == ord("a") + 1 and g[1] == (ord("a") + 1) << q.BITS | ord("b") + 1 and g[2] == 0xC3 + 1
    x = np.array([5, 1 << 62, 0, 7])
    assert q._unpack(q._pack(x)).tolist() == x.tolist() and not len(q._unpack(q._pack(x[:0])))
