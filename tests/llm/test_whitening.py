import math
from fractions import Fraction

import numpy as np
import pytest

from lectern.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, label int, x array<int>, id string, dims int"


def fine(v):
    return v and all(c is not None and math.isfinite(c) for c in v)


def slow(rows, top=16):
    """Rows of (id, vector) of one length: exact sums by Python numbers; returns n, deviations, eigenvalues, trace and a function that whitens."""
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if fine(v)]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    off = [[Fraction(n * c - s, n) for c, s in zip(x, sums, strict=True)] for x in fit]
    cov = np.array([[float(sum(r[i] * r[j] for r in off) / n) for j in range(len(sums))] for i in range(len(sums))])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for _, x in xs]
    projected = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for _, x in xs]) @ vectors / np.sqrt(values)
    return n, [i for i, _ in xs], deviations, values, np.trace(cov), projected, fit


def compare(got, rows):
    n, ids, deviations, values, trace, projected, fit = slow(rows)
    k = len(values)
    assert len(got) == len(ids) * k and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for c in range(k):
        want = {}
        for i, d, p in zip(ids, deviations, projected[:, c].tolist(), strict=True):
            want.setdefault(i, []).append((d, p))
        sign = None
        for i, some in want.items():
            have = sorted((r["deviation"], r["whitened"]) for r in by[i, c + 1])
            assert [h[0] for h in have] == sorted(d for d, _ in some)
            if len(some) == 1 and abs(some[0][1]) > 1e-6:
                sign = sign or math.copysign(1, have[0][1] * some[0][1])
                assert have[0][1] == pytest.approx(sign * some[0][1], abs=1e-8)
        assert list({r["explained"] for r in got if r["component"] == c + 1}) == [pytest.approx(values[c] / trace, rel=1e-9)]
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, [1], "clash", 3) for i, v in rows], SCHEMA).repartition(3)


def test_equals_exact_sums_and_leaves_rows_out(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=20).tolist()) for i in range(300)]
    rows += [(i, rows[3][1]) for i in range(300, 400)] + [(3, rows[4][1]), (None, rows[5][1])]  # copies count once in the fit list
    rows += [(900, None), (901, [math.nan] * 20), (902, [math.inf] + [0.0] * 19), (903, [None] + [0.0] * 19)]
    compare(wh.whiten(table(spark, rows)).collect(), rows)


def test_fewer_dimensions_than_components_and_lengths_by_themselves(spark):
    rng = np.random.default_rng(2)
    short, long = [(i, (rng.normal(size=3) * [1, 5, 25]).tolist()) for i in range(50)], [(100 + i, rng.normal(size=7).tolist()) for i in range(60)]
    got = wh.whiten(table(spark, [*short, *long, (800, []), (801, [1.0] * 5), (802, [1.0] * 5)])).collect()
    compare([r for r in got if r["vec_id"] < 100], short)
    compare([r for r in got if r["vec_id"] >= 100], long)


def test_pieces_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(wh, "TILE", 4)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=10) @ rng.normal(size=(10, 10))).tolist()) for i in range(80)]
    compare(wh.whiten(table(spark, rows)).collect(), rows)


def test_wide_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * 2.0**28).tolist()) for i in range(40)]
    got = wh.whiten(table(spark, rows)).collect()
    n, ids, deviations, values, _, projected, _ = slow(rows)
    of = {(r["vec_id"], r["component"]): r for r in got}
    for i, d, p in zip(ids, deviations, projected, strict=True):
        assert [of[i, c + 1]["deviation"] for c in range(4)] == [d if d < 1 << 63 else None] * 4
        assert [abs(of[i, c + 1]["whitened"]) for c in range(4)] == pytest.approx(np.abs(p).tolist(), abs=1e-7)
    assert wh.whiten(table(spark, [(1, [2.0**60, 0.0]), (2, [1e30, 1.0])])).count() == 0


def test_equal_vectors_and_empty_tables(spark):
    assert wh.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    flat = [(i, [float(i), 2.0, float(-i)]) for i in range(9)]  # one direction only
    got = wh.whiten(table(spark, flat)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 9 and got[0]["explained"] == pytest.approx(1)
    assert wh.whiten(table(spark, []).limit(0)).count() == 0
