"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, exact rerank.

Equal vectors form a class; one of them is coded.  Rotations learnt on a bounded sample balance
the sign bits of the projected vectors.  Each code is cut into substrings, one table for each;
vectors with an equal substring meet in a bucket.  A pair is tested in the first table where
it meets and only there, so no list of pairs is kept: pairs near in Hamming distance are tested
by cosine in double precision, and a task hands on sums of links and a spanning star.  Large
buckets are dealt in tiles of two blocks, so no task gets a whole bucket.

Substrings get longer as the table grows, and a longer one agrees less often.  So rotations are
added until partners made at the threshold meet as often as at every other size; when there are
MOST_ROTATIONS, substrings get shorter instead, so buckets grow and no recall is lost.

The index holds every vector; the sample (SAMPLE vectors, by hash) only shapes the rotations and
sets their number.

Vectors of each length are searched by themselves, with rotations and tables of their own.

Defined results: null, zero, empty and non-finite vectors and vectors with null components
link with nothing and are kept, and vectors of different lengths do not link; a row without an id
links with nothing, has no component and is not kept; repeated rows are vectors of their own; an
empty table gives an empty result.  Labels and other columns play no part.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import components, cut, forest, hot_lookup, tidy

#: Most vectors that the rotations are learnt from.
SAMPLE = 8_192
#: Rotations at least, which are also those that the Hamming distance is taken over.
ROTATIONS, CODE_BITS, ITERATIONS = 6, 64, 30
#: Rotations at most, and the share of pairs at the threshold that may meet in no table.
MOST_ROTATIONS, MISSED = 32, 0.02
#: Vectors of the sample that get partners to measure that share.
PROBED = 2_048
#: Members of a block of a bucket.
BLOCK = 128
#: Share of differing bits up to which a pair is reranked; at a cosine of 0.9 about 0.144 differ.
HAMMING_SHARE = 0.25


def learn_rotations(sample: np.ndarray, seed: int = 7, enough=lambda found: len(found) == ROTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projections of shape rotations x dims x bits) by iterative quantisation, until enough(projections)."""
    dims = sample.shape[1]
    bits = min(dims, CODE_BITS)
    mean = sample.mean(0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    basis = axes[:, ::-1][:, :bits]
    low = centred @ basis
    rng = np.random.default_rng(seed)
    out = []
    while not enough(out):
        r, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
        for _ in range(ITERATIONS):
            u, _, vt = np.linalg.svd(low.T @ np.where(low @ r >= 0, 1.0, -1.0))
            r = u @ vt
        out.append(basis @ r)
    return mean, np.stack(out)


def codes_of(vectors: np.ndarray, mean: np.ndarray, projections: np.ndarray) -> np.ndarray:
    """uint64 codes, a column for each rotation."""
    weights = np.uint64(1) << np.arange(projections.shape[2], dtype=np.uint64)
    return np.stack([((vectors - mean) @ p >= 0) @ weights for p in projections], 1)


def _substrings(codes: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Substrings by table: rotations x (bits // width) columns."""
    per = max(1, bits // width)
    mask = np.uint64((1 << width) - 1)
    return np.stack([(codes[:, r] >> np.uint64(k * width)) & mask for r in range(codes.shape[1]) for k in range(per)], 1)


def partners(sample: np.ndarray, least: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and, at a cosine of least to each, one partner in any direction and one towards another vector."""
    if sample.shape[1] == 1:
        return sample, sample
    noise = np.random.default_rng(seed).normal(size=sample.shape)
    x = np.concatenate([sample, sample])
    aside = np.concatenate([noise, np.roll(sample, 1, 0) + 1e-6 * noise])
    aside -= (aside * x).sum(1)[:, None] * x
    return x, least * x + math.sqrt(max(0.0, 1 - least * least)) * aside / np.linalg.norm(aside, axis=1)[:, None]


def missed(a: np.ndarray, b: np.ndarray, width: int, bits: int) -> float:
    """Share of the pairs of codes that meet in no table."""
    return 1 - (_substrings(a, width, bits) == _substrings(b, width, bits)).any(1).mean()


def plan(sample: np.ndarray, n: int, least: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, projections, width of a substring) for n vectors: at the threshold at most MISSED pairs are missed."""
    bits = min(sample.shape[1], CODE_BITS)
    width = min(bits, max(8, math.ceil(math.log2(max(n, 2))) - 2), 32)
    x, y = partners(sample[:PROBED], least)
    mean, a, b = sample.mean(0), [], []

    def enough(found):
        for p in found[len(a) :]:
            a.append(codes_of(x, mean, p[None])[:, 0])
            b.append(codes_of(y, mean, p[None])[:, 0])
        return len(found) >= ROTATIONS and (n < 2 or len(found) >= MOST_ROTATIONS or missed(np.stack(a, 1), np.stack(b, 1), width, bits) <= MISSED)

    mean, projections = learn_rotations(sample, enough=enough)
    while n > 1 and width > 1 and missed(np.stack(a, 1), np.stack(b, 1), width, bits) > MISSED:
        width -= 1
    return mean, projections, width


def _prepare(batches):
    for batch in batches:
        sigs, vecs, dims = [], [], []
        for key, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            good = None
            if key is not None and v and None not in v:
                x = np.array(v, float)
                if np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    good = (x + 0.0).tobytes()
            sigs.append(good and hashlib.blake2b(good, digest_size=16).digest())
            vecs.append(good)
            dims.append(len(v) if good else 0)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sigs, pa.binary()), pa.array(vecs, pa.binary()), pa.array(dims, pa.int32())], ["vec_id", "sig", "vec", "dims"])


def _unit(vecs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vecs)).reshape(len(vecs), -1)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _code(model):
    def rows(batches):
        mean, projections = model.value
        for batch in batches:
            codes = codes_of(_unit(batch.column("vec").to_pylist()), mean, projections) if batch.num_rows else np.zeros((0, 1), np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], [*batch.schema.names, "codes"])

    return tidy(rows)


def _index(width, bits):
    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            subs = _substrings(codes, width, bits)
            n, tables = subs.shape
            keys = (np.arange(tables, dtype=np.int64) << 40) | subs.astype(np.int64)
            some = pa.array([c.tobytes() for c in codes[:, :ROTATIONS]], pa.binary())
            for lo in range(0, n, rows_of := max(1, 100_000 // tables)):
                part = keys[lo : lo + rows_of]
                at = pa.array(np.repeat(np.arange(lo, lo + len(part)), tables))
                yield pa.RecordBatch.from_arrays([pa.array(part.ravel()), batch.column("class_id").take(at), some.take(at)], ["key", "class_id", "codes"])

    return tidy(rows)


def _near(codes: np.ndarray, blocks: np.ndarray, key: int, low: int, high: int, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a tile that are near and whose first common table is the tile's.

    Codes of fewer rotations than the index has leave in pairs that meet in none of their tables.
    """
    if low == high:
        i, j = np.triu_indices(len(codes), 1)
    else:
        i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(blocks == low), np.flatnonzero(blocks == high), indexing="ij"))
    some = codes[:, :ROTATIONS]
    apart = np.bitwise_count(some[i] ^ some[j]).sum(1)
    near = apart <= HAMMING_SHARE * bits * some.shape[1]
    i, j = i[near], j[near]
    if len(i):
        subs = _substrings(codes, width, bits)
        same = subs[i] == subs[j]
        first = np.where(same.any(1), same.argmax(1) == key >> 40, key >> 40 >= subs.shape[1])
        i, j = i[first], j[first]
    return i, j


def _tiles(batches, columns):
    """Lists of rows of one tile from rows sorted by tile; a tile may span batches."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if row[:3] != at:
                if len(held) > 1:
                    yield at, held
                at, held = row[:3], []
            held.append(row[3:])
    if len(held) > 1:
        yield at, held


def _candidates(width, bits):
    def rows(batches):
        out = []
        for (key, low, high), held in _tiles(batches, ("key", "low", "high", "class_id", "codes", "block")):
            codes = np.frombuffer(b"".join(r[1] for r in held), np.uint64).reshape(len(held), -1)
            i, j = _near(codes, np.array([r[2] for r in held]), key, low, high, width, bits)
            out += [(key, low, high, held[k][0], held[k][2]) for k in np.union1d(i, j).tolist()]
            if len(out) > 50_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    def _batch(out):
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["key", "low", "high", "class_id", "block"])

    return tidy(rows)


def _rerank(width, bits, least):
    def rows(batches):
        out = []
        for (key, low, high), held in _tiles(batches, ("key", "low", "high", "class_id", "block", "codes", "vec", "copies")):
            ids, blocks, codes, vecs, copies = zip(*held, strict=True)
            i, j = _near(np.frombuffer(b"".join(codes), np.uint64).reshape(len(held), -1), np.array(blocks), key, low, high, width, bits)
            x = _unit(list(vecs))
            linked = (x @ x.T)[i, j] >= least
            i, j = i[linked], j[linked]
            if len(i):
                weight = np.array(copies)
                links = np.bincount(i, weight[j], len(held)) + np.bincount(j, weight[i], len(held))
                root = forest((ids[a], ids[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True))
                out += [(ids[k], int(links[k]), root[ids[k]]) for k in np.flatnonzero(links).tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["u", "links", "v"])

    return tidy(rows)


def _links(classes: DataFrame, n: int, dims: int, least: float) -> DataFrame:
    """(u, links, v): links of the n classes of one length, and edges that span its components."""
    spark = classes.sparkSession
    part = F.pmod(F.xxhash64("sig"), F.lit(1_000_000)) < int(1e6 * min(1.0, SAMPLE / n)) + 1
    sample = [bytes(r["vec"]) for r in classes.where(part).select("vec").limit(2 * SAMPLE).collect()] or [np.ones(dims).tobytes()]
    *rotations, width = plan(_unit(sample), n, least)
    model = spark.sparkContext.broadcast(rotations)
    bits = min(dims, CODE_BITS)
    coded = cut(classes.select("sig", "class_id", "copies", "vec").mapInArrow(_code(model), "sig binary, class_id long, copies long, vec binary, codes binary"), "itq-codes")
    index = coded.select("class_id", "codes").mapInArrow(_index(width, bits), "key long, class_id long, codes binary")
    sizes = cut(index.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "itq-buckets")
    dealt = hot_lookup(index, sizes, ["key"], "members", "inner").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "class_id", "codes", "block")
    by = ("key", "low", "high")
    near = tiles.repartition(*by).sortWithinPartitions(*by).mapInArrow(_candidates(width, bits), "key long, low int, high int, class_id long, block int")
    full = cut(near, "itq-near").join(coded.select("class_id", "codes", "vec", "copies"), "class_id")
    return cut(full.repartition(*by).sortWithinPartitions(*by).mapInArrow(_rerank(width, bits, least), "u long, links long, v long"), "itq-links")


def deduplicate(table: DataFrame, least: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    vecs = cut(rows.mapInArrow(_prepare, "vec_id long, sig binary, vec binary, dims int"), "itq-vectors")
    classes = vecs.where("dims > 0").groupBy("dims", "sig").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
    classes = cut(classes, "itq-classes")
    sizes = {r["dims"]: r["count"] for r in classes.groupBy("dims").count().where("count > 1").collect()}
    alone = classes.where(~F.col("dims").isin(list(sizes)))
    named = alone.select("sig", "copies", (F.col("copies") - 1).alias("n_links"), F.col("class_id").alias("component_id"))
    for dims, n in sorted(sizes.items()):
        own = classes.where(F.col("dims") == dims)
        found = _links(own, n, dims, least)
        groups = components(found.select("u", "v"))
        links = found.groupBy(F.col("u").alias("class_id")).agg(F.sum("links").alias("links"))
        both = own.select("sig", "class_id", "copies").join(links, "class_id", "left").join(groups.withColumnRenamed("node", "class_id"), "class_id", "left")
        named = named.unionByName(cut(both.select("sig", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class_id").alias("component_id")), "itq-named"))
    out = hot_lookup(vecs.select("vec_id", "sig"), named, ["sig"], "copies")
    component = F.coalesce("component_id", "vec_id")
    return out.select(F.col("vec_id").cast(table.schema[id_col].dataType).alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
