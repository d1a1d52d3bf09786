import hashlib
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lectern.llm import mixing
from tests_llm_cases import SCHEMA, empty, odd, odd_rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, weights=(5, 2, 1), share=150, most=2):
    """rows of (id, text, source): each one's (id, size, source_size, target, taken), targets by rounds of sharing out."""
    sized = [(i, len(WORD.findall(t or "")), s, hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()) for i, t, s in rows]
    names = sorted({s for *_, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(z for _, z, s, _ in sized if s == n) for n in names}
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, left = {}, Fraction(share * sum(total.values()), 100)
    while free := [n for n in names if n not in target]:
        unit = left / sum(weight[n] for n in free)
        over = [n for n in free if weight[n] * unit > most * total[n]]
        for n in over or free:
            target[n] = Fraction(most * total[n]) if over else weight[n] * unit
            left -= target[n]
    out = []
    for n in names:
        before, budget = 0, int(target[n])
        epochs = min(budget // total[n], most) if total[n] else 0
        rest = budget - epochs * total[n]
        for i, z, _, _ in sorted((r for r in sized if r[2] == n), key=lambda r: (r[3], str(r[0]))):
            out.append((i, z, total[n], float(target[n]), epochs * z + max(0, min(z, rest - before))))
            before += z
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def same(a, b):
    return [(*x[:3], x[4]) for x in a] == [(*x[:3], x[4]) for x in b] and [x[3] for x in a] == pytest.approx([x[3] for x in b], rel=1e-12)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_slow_version(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "ROWS_A_RANGE", 40)
    rng = random.Random(seed)
    sizes = [400, 3, 60, 5, 0, 20, 1]
    names = ["b", "a", "é", "zz", "B", None, "𝄞"]
    rows = [(rng.choice([i, i, None]), None if rng.random() < 0.05 else words(rng.randint(0, 30), i) if n != "B" else "", n) for i, n in enumerate(x for n, k in zip(names, sizes, strict=True) for x in [n] * k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    have = got(mixing.mix(df))
    assert same(have, slow(rows)) and have == got(mixing.mix(df.repartition(2)))
    of = {(r[2], r[3]): sum(x[4] for x in have if x[2:4] == r[2:4]) for r in have}
    assert all(abs(taken - t) <= 1 for (_, t), taken in of.items() if t) and all(r[4] <= 2 * r[1] for r in have)


def test_odd_rows_copies_and_empty_tables(spark, monkeypatch):
    assert same(got(mixing.mix(odd(spark))), slow([(r[0], r[1], r[3]) for r in odd_rows()]))
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0
    monkeypatch.setattr(mixing, "COPIES_A_TASK", 7)
    rows = [(1, "same words here", "a")] * 100 + [(i, words(3, i), "b") for i in range(30)] + [(None, None, None)] * 20
    assert same(got(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6))), slow(rows))
    none = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert got(mixing.mix(none)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_the_mix_holds_what_was_planned(spark):
    rows = [(i, f"\n {words(9, i)}  \t" if i % 3 else "twice " * 4, "ab"[i % 5 > 0]) for i in range(60)] + [(7, words(5, 3), "a")] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r[0]: r[1] for r in mixing.mix(df).groupBy("doc_id").agg(F.sum("taken")).collect() if r[1]}
    mixed = mixing.mixed(df).collect()
    assert all(len(WORD.findall(r["text"])) == r["words"] > 0 for r in mixed)
    have: dict = {}
    for r in mixed:
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + r["words"]
    assert have == taken
    whole = {(r[0], r[2], r[1]) for r in rows}
    assert all(any(w[0] == r["doc_id"] and w[1] == r["source"] and w[2].startswith(r["text"]) for w in whole) for r in mixed)


def test_more_sources_than_a_range(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_A_RANGE", 16)
    rows = [(i, words(1 + i % 17, i), f"s{i % 90:02d}") for i in range(400)]
    assert same(got(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))), slow(rows))
    assert "source" in SCHEMA
