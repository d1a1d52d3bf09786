"""Shared pieces of the training-data operators: lineage cuts, hot-key joins, components, hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import os
import shutil
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where tables that cut lineage go when a local session (tests) names no shared folder; removed at exit.
LOCAL_CHECKPOINTS = "/tmp/checkpoints/lectern"
_OWN: set[str] = set()

#: A key counts as hot when it has over 1/HOT_SHARE of all rows, so at most HOT_SHARE keys are hot.
HOT_SHARE = 64

#: Bytes of a row group of scratch tables: a writer and a reader hold one for each column.
ROW_GROUP = 32 << 20

MASK64 = (1 << 64) - 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a local session may lack one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    own = f"{LOCAL_CHECKPOINTS}/{os.getpid()}"
    if own not in _OWN:
        _OWN.add(own)
        atexit.register(shutil.rmtree, own, ignore_errors=True)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, name: str, key: str | tuple[str, ...], buckets: int) -> tuple[DataFrame, Callable[[], None]]:
    """Like cut(), with rows in buckets of a key, or of several columns, so that later groups and joins on it don't move them; and what drops the table."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = f"lectern_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, *([key] if isinstance(key, str) else key)).option("path", path).option("compression", "zstd").option("parquet.block.size", ROW_GROUP).saveAsTable(table)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        _delete(spark, path)

    return spark.table(table), drop


#: Most buckets of a table that cut_by() writes.
MOST_BUCKETS = 20_000


def partitions_of(df: DataFrame) -> int:
    return df._jdf.queryExecution().toRdd().getNumPartitions()


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files behind a table made by cut() that nothing will read again."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rsplit("/", 1)[0])


def hot_lookup(facts: DataFrame, dim: DataFrame, keys: list[str], count: str, how: str = "left") -> DataFrame:
    """Join facts with a dim that is unique by keys, where a few keys may hold most facts.

    dim[count] is how many facts have the key.  Hot keys (at most HOT_SHARE of them, by the
    definition of hot) are broadcast; all other keys are shuffled, so no task gets a hot key.
    Facts whose key is null match nothing; they are spread by a hash of the row.
    """
    total = dim.agg(F.coalesce(F.sum(count), F.lit(0)).alias("__total"))
    limit = max(1, total.first()[0] // HOT_SHARE)
    hot = F.broadcast(dim.where(F.col(count) > limit).withColumn("__hot", F.lit(True)))
    values = [c for c in dim.columns if c not in keys]
    first = facts.join(hot, keys, "left")
    is_hot = F.col("__hot").isNotNull()
    done = first.where(is_hot).select(*facts.columns, *values)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    rest = first.where(~is_hot).select(*facts.columns, F.when(missing, F.xxhash64(*facts.columns)).otherwise(0).alias("__salt"))
    rest = rest.join(dim.where(F.col(count) <= limit).withColumn("__salt", F.lit(0).cast("long")), [*keys, "__salt"], how)
    return done.unionByName(rest.select(*facts.columns, *values))


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null reads as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


@functools.cache
def _libc():
    """The C library, told to map large arrays by themselves, so that they go back to the system when freed."""
    with contextlib.suppress(OSError, AttributeError):  # only glibc has these
        lib = ctypes.CDLL(None)
        lib.mallopt(-3, 1 << 20)
        lib.malloc_trim(0)
        return lib
    return None


def give_back() -> None:
    """Give unused memory back to the system.  Workers live on for other stages; what they keep would count against those."""
    pa.default_memory_pool().release_unused()
    if lib := _libc():
        lib.malloc_trim(0)


def tidy(rows):
    """rows for mapInArrow that gives memory back at the task's end."""

    def run(batches):
        _libc()
        yield from rows(batches)
        give_back()

    return run


#: Bytes of text that a task turns into Python objects at once.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], column: int | str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a text column has at most about `most` bytes in each; single texts stay whole."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets all when it has too many."""

    LIMIT = 60_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        if len(self) > self.LIMIT:
            self.clear()
        return out


#: Bits of a Bloom filter, and probes in it: FILTER_BITS / 8 bytes at every corpus size.
FILTER_BITS, PROBES = 1 << 26, 4
_PAGE = 1 << 15


def bloom_keys(column: pa.Array) -> np.ndarray:
    """uint64 keys of a column of longs, or of binary digests of at least eight bytes."""
    if pa.types.is_integer(column.type):
        return column.drop_null().cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64)
    return np.frombuffer(b"".join(h[:8] for h in column.to_pylist()), "<u8")


def _probes(keys: np.ndarray) -> list[np.ndarray]:
    return [(mix64(keys + np.uint64(0x9E3779B97F4A7C15 * i & MASK64)) & np.uint64(FILTER_BITS - 1)).astype(np.int64) for i in range(1, PROBES + 1)]


def _bits(batches):
    for batch in batches:
        at = np.unique(np.concatenate(_probes(bloom_keys(batch.column(0)))))
        yield pa.RecordBatch.from_arrays([pa.array(at // _PAGE), pa.array(at % _PAGE)], ["page", "bit"])


def _pages(batches):
    pages: dict[int, np.ndarray] = {}
    for batch in batches:
        page, bit = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        order = np.argsort(page, kind="stable")
        page, bit = page[order], bit[order]
        starts = np.flatnonzero(np.diff(page, prepend=-1))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(page)], strict=True):
            pages.setdefault(int(page[a]), np.zeros(_PAGE, bool))[bit[a:b]] = True
    rows = [(p, np.packbits(x, bitorder="little").tobytes()) for p, x in pages.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["page", "bits"])


def bloom_filter(keys: DataFrame) -> np.ndarray:
    """Filter of the values of a one-column table, for a broadcast.

    False positives must do no harm to the caller: a saturated filter lets everything through.
    """
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    pages = keys.mapInArrow(_bits, "page long, bit long").repartition("page").mapInArrow(_pages, "page long, bits binary")
    for r in pages.toLocalIterator():
        out[r["page"] * _PAGE // 8 : (r["page"] + 1) * _PAGE // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def in_bloom(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    hit = np.ones(len(keys), bool)
    for at in _probes(keys):
        hit &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return hit


def _find(parent: dict, x):
    root = x
    while parent.get(root, root) != root:
        root = parent[root]
    while parent.get(x, x) != root:
        parent[x], x = root, parent[x]
    return root


def forest(pairs: Iterable[tuple[int, int]]) -> dict[int, int]:
    """Node to the smallest node that it reaches over the pairs."""
    parent: dict[int, int] = {}
    for a, b in pairs:
        x, y = _find(parent, a), _find(parent, b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            parent.setdefault(min(x, y), min(x, y))
    return {x: _find(parent, x) for x in list(parent)}


#: Edges that a task of components() takes.
EDGES_A_TASK = 100_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's edges become stars: as many rows as nodes, with the same components."""
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = _find(parent, a), _find(parent, b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
    stars = [(x, r) for x in list(parent) if (r := _find(parent, x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([s[0] for s in stars], pa.int64()), pa.array([s[1] for s in stars], pa.int64())], ["u", "v"])


def _label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Node and component of all edges, which one task has: stars, and each component's own node."""
    for stars in _contract(batches):
        node, root = stars.columns
        own = root.unique()
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([node, own]), pa.concat_arrays([root, own])], ["node", "component"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (u, v): one row (node, component) per node, component the smallest node.

    Alternates large-star and small-star steps, each a partial minimum and an equi-join on a
    table in the shared folder, until nothing changes or one task may take the edges that are left:
    a step has a dozen exchanges to plan and compile, which costs the driver the same memory for few edges
    as for many.  Nulls and loops are ignored; an empty table gives an empty result.
    """
    e = cut(edges.where("u <> v").select("u", "v").mapInArrow(_contract, "u long, v long").distinct(), name)
    seen = tasks = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] <= EDGES_A_TASK:
            return e.coalesce(1).mapInArrow(tidy(_label), "node long, component long")
        if now == seen:
            break
        seen, tasks = now, tasks or now[0] // EDGES_A_TASK + 4  # fewer than the session's partitions where edges are few
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).coalesce(tasks)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct().coalesce(tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
        old, e = e, cut(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").coalesce(tasks).distinct().coalesce(tasks), name)
        drop_table(old)
    roots = e.select(F.col("v").alias("u")).distinct().select("u", F.col("u").alias("v"))
    return e.select("u", "v").union(roots).groupBy("u").agg(F.min("v").alias("v")).toDF("node", "component")
