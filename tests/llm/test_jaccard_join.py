import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import common
from lectern.llm import jaccard_join as jj
from lectern.llm.common import WordHashes, components
from tests_llm_cases import empty, odd, odd_rows, words


def brute(rows, size=4, per=85, of=100):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = [r[0] for r in rows]
    named = [(i, a) for i, a in enumerate(sets) if a and label[i] is not None]
    links = [(i, j) for i, a in named for j, b in named if of * len(a & b) >= per * len(a | b)]  # once, not once a round
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return sorted(((r[0], len(s), x) for r, s, x in zip(rows, sets, label, strict=True)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert got(jj.group(odd(spark))) == brute(rows)
    assert jj.group(empty(spark)).count() == 0


def test_near_copies_and_shared_passages(spark):
    rng = random.Random(5)
    base, passage = words(120, 3).split(), words(14, 4)
    rows = []
    for i in range(150):  # copies with ever more edits, around the threshold
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((i * 3, " ".join(w)))
    rows += [(1000 + i, f"{passage} {words(rng.randint(1, 12), i + 50)}") for i in range(80)]
    rows += [(2000 + i, passage) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(jj.group(df)) == brute(rows)
    assert got(jj.group(df, size=5, per=80)) == brute(rows, 5, 80)


def test_hot_shingles_and_one_group_of_half_of_the_rows(spark, monkeypatch):
    for name, value in (("LEAST_HOT", 4),):
        monkeypatch.setattr(jj, name, value)
    rng = random.Random(9)
    passage = words(30, 8)
    rows = [(i, f"{passage} {words(1 + i % 9, i + 300)}") for i in range(45)]
    rows += [(500 + i, words(60, 70)) for i in range(8)] + [(600 + i, words(25, 700 + i)) for i in range(20)]
    rows += [(700 + i, " ".join(rng.sample(passage.split(), 30))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(jj.group(df)) == brute(rows)
    assert got(jj.group(df, size=2, per=80)) == brute(rows, 2, 80)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=40, unique=True), st.lists(st.integers(0, 40), min_size=1, max_size=40, unique=True), st.integers(0, 9))
def test_linked_sets_share_what_their_prefixes_ask_for(a, b, seed):
    levels = np.random.default_rng(seed).integers(0, 60, jj.SKETCH).astype(np.uint8)
    spread = lambda xs: np.unique(np.array(xs, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x, y = spread(a), spread(b)
    common = len(np.intersect1d(x, y))
    if 100 * common >= 85 * (len(x) + len(y) - common):
        (p, l1), (q, l2) = jj.prefix(x, levels, 5.0, 85, 100), jj.prefix(y, levels, 5.0, 85, 100)
        need = -(-85 * (len(x) + len(y)) // 185)
        least = min(l1, l2)
        inside = [t for t in p.tolist() if t in q.tolist() and p.tolist().index(t) - least < len(x) - need and q.tolist().index(t) - least < len(y) - need]
        assert len(inside) >= least


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=300), st.sets(st.integers(0, 400), min_size=1, max_size=300))
def test_bitmaps_never_hide_what_sets_share(a, b):
    spread = lambda xs: np.array(sorted(xs), np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(7)
    bound = jj.most_common(len(a), jj.bitmap(spread(a)), len(b), jj.bitmap(spread(b)))
    assert len(a & b) <= bound <= min(len(a), len(b))
    assert jj.most_common(len(a), jj.bitmap(spread(a)), len(a), jj.bitmap(spread(a))) == len(a)


def test_hashes_do_not_depend_on_the_memo():
    memo = WordHashes()
    memo.LIMIT = 3
    w = [str(i).encode() for i in range(50)]
    assert (jj.shingle_hashes(w, 4, memo) == jj.shingle_hashes(w, 4, WordHashes())).all()
    assert len(jj.shingle_hashes(w[:2], 4, memo)) == 1 and len(jj.shingle_hashes([], 4, memo)) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (7, 7), (300, 301)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long").repartition(6)).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 150: 100, 200: 100, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_of_more_edges_than_a_task_takes(spark, monkeypatch):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(6)
    want = common.forest((a, b) for a, b in edges if a != b)
    for most in (10, 120, 100_000):  # steps to the end, few steps, none
        monkeypatch.setattr(common, "EDGES_A_TASK", most)
        assert {r["node"]: r["component"] for r in components(df).collect()} == want


def test_few_edges_cost_the_driver_few_jobs(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(0, 300, 2)], "u long, v long").repartition(6)
    spark.sparkContext.setJobGroup("few-edges", "components of few edges")
    assert components(df).count() == 300
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-edges")) <= 10
