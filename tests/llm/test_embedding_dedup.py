import math
from types import SimpleNamespace

import numpy as np

from lectern.llm import embedding_dedup as ed

SCHEMA = "vec_id long, embedding array<float>, label int, sig string, key int, links int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "clash", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, least=0.9):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    links = x @ x.T >= least
    np.fill_diagonal(links, False)
    ids = np.array([i for i, _ in good])
    comp = ids.copy()
    for _ in range(len(ids)):
        low = np.where(links, comp[None, :], comp[:, None]).min(1)
        if (np.minimum(comp, low) == comp).all():
            break
        comp = np.minimum(comp, low)
    return {int(i): (int(n), int(c)) for i, n, c in zip(ids, links.sum(1), comp, strict=True)}


def test_recall_hot_groups_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 32)  # so that hot buckets are tiled
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 64))
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(1000 + i, base[i % 40] + rng.normal(size=64) * 0.18) for i in range(160)]
    hot = rng.normal(size=64)
    rows += [(2000 + i, hot + rng.normal(size=64) * 0.12) for i in range(150)]
    rows += [(3000 + i, base[5]) for i in range(60)] + [(3500, base[6] * 2)]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    bad = [(4000, None), (4001, []), (4002, [0.0] * 64), (4003, [None] + [1.0] * 63), (4004, [float("nan")] * 64), (4005, [float("inf")] * 64), (4006, [1.0, 2.0]), (None, rows[0][1])]
    got = {r["vec_id"]: r for r in ed.deduplicate(frame(spark, rows + bad).repartition(3)).collect()}
    assert len(got) == len(rows + bad)
    want = brute(rows)
    found, total = sum(got[i]["n_links"] for i in want), sum(n for n, _ in want.values())
    assert 0.97 * total <= found <= total
    assert all(got[i]["n_links"] <= n for i, (n, _) in want.items())
    assert np.mean([got[i]["component_id"] == c for i, (_, c) in want.items()]) > 0.98
    assert got[3500]["component_id"] == 6 and got[3000]["n_links"] >= 60
    for i, _ in bad[:-1]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values() if r["vec_id"] is not None)


def test_empty_and_tiny_tables(spark):
    assert ed.deduplicate(frame(spark, [])).count() == 0
    out = {r["vec_id"]: tuple(r)[1:] for r in ed.deduplicate(frame(spark, [(2, [1.0, 0.0]), (1, [2.0, 0.01]), (3, [0.0, 1.0])])).collect()}
    assert out == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True)}


def test_codes_are_balanced_and_tables_cover_near_codes():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 32)) @ rng.normal(size=(32, 32))
    codes = ed.codes_of(x, *ed.learn_rotations(x))
    bits = (codes[:, 0][:, None] >> np.arange(32, dtype=np.uint64)) & np.uint64(1)
    assert (np.abs(bits.mean(0) - 0.5) < 0.1).all()
    assert ed._substrings(codes, 8, 32).shape == (2000, 4 * ed.ROTATIONS)


def test_recall_at_the_threshold_with_substrings_of_large_tables(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1)[:, None] * x
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    pairs = 0.905 * x + np.sqrt(1 - 0.905**2) * aside
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, pairs]))]
    want = sum(n for n, _ in brute(rows).values())
    for n in (10**6, 10**7):
        monkeypatch.setattr(ed, "math", SimpleNamespace(ceil=math.ceil, sqrt=math.sqrt, log2=lambda _, n=n: math.log2(n)))
        found = sum(r["n_links"] for r in ed.deduplicate(frame(spark, rows)).collect())
        assert 0.94 * want <= found <= want


def test_vectors_of_every_length_are_linked(spark):
    rng = np.random.default_rng(8)
    long, short = rng.normal(size=(40, 64)), rng.normal(size=(40, 32))
    rows = [(i, v.tolist()) for i, v in enumerate([*long, *(long + 0.1 * rng.normal(size=long.shape))])]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate([*short, *(short + 0.1 * rng.normal(size=short.shape)), short[0]])]
    rows += [(2000, [1.0, 2.0, 3.0]), (2001, [2.0, 4.0, 6.0]), (2002, [5.0])]
    want = {i: x for a, b in ((0, 1000), (1000, 2000), (2000, 2002), (2002, 3000)) for i, x in brute([r for r in rows if a <= r[0] < b]).items()}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ed.deduplicate(frame(spark, rows)).collect()}
    assert got == want and got[1080][0] >= 2 and got[2001] == (1, 2000)
