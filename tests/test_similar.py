"""The similarity join equals difflib over all pairs."""

import difflib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import mining, similar

SYLLABLES = "가나다라마바사아자차카타파하거너더러머버"


def strings(n, seed, letters=SYLLABLES, low=1, high=12):
    rng = random.Random(seed)
    out = ["".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)]
    for _ in range(n):  # near ones
        w = list(rng.choice(out) or "x")
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = rng.choice(letters)
        elif kind == 1:
            w.insert(at, rng.choice(letters))
        else:
            del w[at]
        out.append("".join(w))
    return out


def brute_pairs(stems, terms, cutoff):
    out = set()
    for s in {s for s in stems if s and len(s) >= 3}:
        for t in {t for t in terms if t}:
            score = difflib.SequenceMatcher(None, t, s).ratio()
            if score >= cutoff:
                out.add((s, t, score, difflib.SequenceMatcher(None, s, t).ratio()))
    return out


def brute_closest(stems, terms, cutoff):
    out = set()
    for s in {s for s in stems if s and len(s) >= 3}:
        if found := difflib.get_close_matches(s, terms, n=1, cutoff=cutoff):
            ratio = difflib.SequenceMatcher(None, s, found[0]).ratio()
            if abs(len(s) - len(found[0])) <= 1 and ratio >= cutoff:
                out.add((s, found[0], ratio))
    return out


def table(spark, words, name):
    return spark.createDataFrame([(w, 1) for w in words], f"{name} string, other int").repartition(3)


@pytest.mark.parametrize(("cutoff", "letters"), [(0.85, SYLLABLES), (0.85, "abc"), (0.7, "abcdef"), (0.6, "abcdef"), (0.95, "ab")])
def test_pairs_and_best_ones_equal_difflib(spark, cutoff, letters):
    stems, terms = [*strings(90, 1, letters), "", None, "aa"], [*strings(90, 2, letters), "", None, "x" * 40]
    stems += [w + letters[0] for w in terms[:40] if w]
    left, right = table(spark, stems, "stem"), table(spark, [*terms, *terms[:9]], "term")
    assert {tuple(r) for r in similar.pairs(left, right, cutoff).collect()} == brute_pairs(stems, terms, cutoff)
    assert {tuple(r) for r in similar.closest(left, right, cutoff).collect()} == brute_closest(stems, [t for t in terms if t], cutoff)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "term string")
    assert similar.closest(none, none, 0.85).count() == 0 and similar.closest(table(spark, ["abcd"], "s"), none, 0.85).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", min_size=1, max_size=14), st.text("abcd", min_size=1, max_size=14), st.sampled_from([0.6, 0.7, 0.8, 0.85, 0.9, 1.0]))
def test_pairs_that_reach_a_cutoff_share_what_is_promised(a, b, cutoff):
    if difflib.SequenceMatcher(None, a, b).ratio() >= cutoff:
        assert len(b) in similar.partners(len(a), cutoff)
        for q in (1, 2):
            assert len(set(similar.grams(a, q)) & set(similar.grams(b, q))) >= similar.shared(len(a), len(b), cutoff, q)


def test_more_terms_than_one_task_would_hold(spark, monkeypatch):
    """There is no bound on terms: suggestions over some thousands equal those by difflib."""
    terms = sorted(set(strings(1500, 5, high=7)))
    tokens = sorted({w for w in strings(60, 6, low=3, high=7)} | {t[:-1] + "힣" for t in terms[:200] if len(t) > 6})
    lines = spark.createDataFrame([("p", i, w) for i, w in enumerate(tokens)], "path string, line_no int, text string")
    words = spark.createDataFrame(list(enumerate(terms)), "seq long, term string")
    none = spark.createDataFrame([], "seq long, wrong string, right string")
    counts = mining.token_counts(lines)
    got = {r["wrong"]: (r["right"], round(r["score"], 9)) for r in mining.suggest_replacements(counts, words, none, most=10_000).collect() if r["reason"].startswith("similarity")}
    rows = mining.typo_candidates(counts, words, none, 1).collect()
    want = {}
    best = {s: (t, r) for s, t, r in brute_closest([r["stem"] for r in rows], terms, 0.85)}
    for r in rows:
        if r["stem"] in best and (right := best[r["stem"]][0] + r["suffix"]) != r["token"]:
            want[r["token"]] = right, round(best[r["stem"]][1], 9)
    assert got == want and len(want) > 20
