"""Training-order materialisation: sequences of token ids in shuffled, fixed-stride shards.

Each text becomes its token ids and END.  Ids are one, two or four bytes wide, little-endian, and
END is the largest number of the width: with a tokenizer's file texts are encoded; without one, a
text column stands for ids of one byte, those of its UTF-8 form, which never has END, and a
binary column for ids of any width.  Texts stand one after the other in the order of a hash of
the row, whatever the partitions of the table, and are cut into sequences of a fixed length; only
the last sequence is padded, with END.  A keyed Feistel permutation over the smallest even power of
two, walked along its cycles until it falls into the range, gives each sequence a global slot: a
bijection that any worker can compute alone.  A shard is a range of slots, and its file holds the
slots' records one after the other, stride(width) bytes each, so with n = shard_slots(width), slot
s lies at (s % n) * stride(width) in its shard.  A reader resumes at any slot by that sum.

Texts are encoded once, into blocks in a bucketed table of the shared folder.  Where each text
begins is a prefix sum over hashes and lengths alone; its results come back to the blocks, which
do not move.  The pieces of the sequences then move once, to their shards.

Defined results: null reads as empty text, which is END alone; rows without an id are texts like
others; rows with one id and one text follow each other; an empty table gives no shard.  Other
columns play no part.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.llm.common import MOST_BUCKETS, cut, cut_by, drop_table, give_back, mix64, partitions_of, scratch_path, slices, texts_of, tidy
from lectern.llm.tokens import encoder

#: Ids of a sequence, the id of one byte that ends a text and pads, and the byte after each record.
LENGTH, END, SEPARATOR = 2048, 255, "\n"
STRIDE = LENGTH + len(SEPARATOR)
#: Slots of a shard of ids of one byte; wider ids make fewer, so that shards have as many bytes.
SHARD_SLOTS = 1 << 14
ROUNDS = 6
#: Bytes of ids in a block, texts whose places are summed up by one task, and most tasks that write shards.
BLOCK_BYTES, TEXTS_A_TASK, MOST_TASKS = 8 << 20, 1_000_000, 20_000


def feistel(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """Slots of the indices below total: a bijection of range(total) for every key."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & (1 << 64) - 1))

    def once(x):
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (mix64(right + k) & mask)
        return (left << shift) | right

    out = once(index.astype(np.uint64))
    while (far := out >= np.uint64(total)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def stride(width: int) -> int:
    """Bytes of a record of ids of width bytes."""
    return LENGTH * width + len(SEPARATOR)


def shard_slots(width: int) -> int:
    return max(1, SHARD_SLOTS // width)


def _ends(ids: bytes, width: int) -> int:
    return int((np.frombuffer(ids, f"<u{width}") == (1 << 8 * width) - 1).sum())


TEXT, DATA = 0, 1
_BLOCK = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("h", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("copies", pa.int64()), ("data", pa.binary())])
_BLOCK_SQL = "kind int, block long, h long, h2 long, n long, copies long, data binary"


def _blocks(blob, width):
    """Blocks of texts' ids; and of each block's different texts, their hashes, lengths and numbers."""

    def ids_of(enc, texts: list[bytes]) -> list[bytes]:
        if enc is None:
            if any(len(t) % width or width > 1 and _ends(t, width) for t in texts):
                raise ValueError(f"not ids of {width} bytes, or one of them is END")
            return texts
        ids = enc.encode(texts)
        return ids if enc.width == width else [np.frombuffer(x, f"<u{enc.width}").astype(f"<u{width}").tobytes() for x in ids]

    def block_rows(block: int, texts: dict):
        keys = sorted(texts)  # the order in the data
        yield pa.RecordBatch.from_pylist([{"kind": DATA, "block": block, "data": pa.Codec("zstd", 3).compress(b"".join(texts[k][0] for k in keys), asbytes=True)}], _BLOCK)
        n = len(keys)
        columns = [[TEXT] * n, [block] * n, [k[0] for k in keys], [k[1] for k in keys], [len(texts[k][0]) // width for k in keys], [texts[k][1] for k in keys], [None] * n]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BLOCK, strict=True)], schema=_BLOCK)

    def rows(batches):
        enc, end = encoder(blob.value) if blob else None, bytes([END]) * width
        block, size, held = TaskContext.get().partitionId() << 32, 0, {}
        for batch in slices(batches, "text", 4 << 20):
            hashes = zip(batch.column("h").to_pylist(), batch.column("h2").to_pylist(), strict=True)
            for k, ids in zip(hashes, ids_of(enc, texts_of(batch.column("text"))), strict=True):
                old = held.get(k)
                held[k] = (old[0], old[1] + 1) if old else (ids + end, 1)
                size += len(ids) + width  # copies count, so those of one text go to several blocks
            if size >= BLOCK_BYTES:
                yield from block_rows(block, held)
                block, size, held = block + 1, 0, {}
        if held:
            yield from block_rows(block, held)
        if enc:
            enc.forget()

    return tidy(rows)


def _pieces(total, key, width):
    """Pieces of sequences: slot, place in the record and ids, from a block's ids and the places where its texts begin."""
    size = LENGTH * width
    fields = pa.schema([("slot", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])

    def rows(block: pa.Table, starts: pa.Table) -> pa.Table:
        give_back()
        texts = sorted(zip(*(starts.column(c).to_pylist() for c in ("h", "h2", "n", "copies", "start")), strict=True))
        lengths = np.array([t[2] for t in texts], np.int64) * width
        data = pa.Codec("zstd").decompress(block.column("data")[0].as_py(), int(lengths.sum()), asbytes=True)
        ends = np.cumsum(lengths).tolist()
        sequence, at, sizes, pieces, codec = [], [], [], [], pa.Codec("zstd", 3)
        for (_, _, n, copies, start), a, b in zip(texts, [0, *ends], ends, strict=False):
            for i in range(copies):
                begin = (start + i * n) * width
                cuts = [begin, *range((begin // size + 1) * size, begin + b - a, size), begin + b - a]
                for x, y in pairwise(cuts):
                    sequence.append(x // size)
                    at.append(x % size // width)
                    sizes.append(y - x)
                    pieces.append(codec.compress(data[a + x - begin : a + y - begin], asbytes=True))
        slots = feistel(np.array(sequence, np.int64), total, key)
        return pa.Table.from_arrays([pa.array(slots), pa.array(at, pa.int32()), pa.array(sizes, pa.int32()), pa.array(pieces, pa.binary())], schema=fields)

    return rows


def _records(total, key, width):
    """Whole records from pieces sorted by slot and place."""
    size = LENGTH * width
    last = int(feistel(np.array([total - 1]), total, key)[0])

    def record(slot: int, parts: list[tuple[int, int, bytes]]) -> bytes:
        codec, out = pa.Codec("zstd"), bytearray()
        for at, n, data in parts:
            if at * width != len(out):
                raise ValueError(f"slot {slot} has a hole")
            out += codec.decompress(data, n, asbytes=True)
        if len(out) < size and slot != last:
            raise ValueError(f"slot {slot} is not full")
        return bytes(out.ljust(size, bytes([END])))

    def rows(batches):
        slot, parts = None, []
        for batch in batches:
            out = []
            for s, at, n, data in zip(*(batch.column(c).to_pylist() for c in ("slot", "at", "n", "data")), strict=True):
                if s != slot:
                    if parts:
                        out.append((slot, record(slot, parts)))
                    slot, parts = s, []
                parts.append((at, n, data))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["slot", "data"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int64()), pa.array([record(slot, parts)], pa.binary())], ["slot", "data"])

    return tidy(rows)


def _starts(texts: DataFrame) -> tuple[DataFrame, int]:
    """(block, h, h2, n, copies, start): where the first of the copies begins in the stream of all ids; and the ids in all."""
    places = texts.count() // TEXTS_A_TASK + 1
    top = F.shiftrightunsigned("h", 40)  # the order is that of h without its sign
    rows = texts.withColumn("part", F.shiftright(top * F.lit(places), 24).cast("int")).withColumn("size", F.col("n") * F.col("copies"))
    sums = sorted(rows.groupBy("part").agg(F.sum("size").alias("size")).collect())
    base, total = [], 0
    for part, size in sums:
        base.append((part, total))
        total += size
    told = F.broadcast(texts.sparkSession.createDataFrame(base, "part int, base long"))  # a row for TEXTS_A_TASK texts
    before = W.partitionBy("part").orderBy(F.shiftrightunsigned("h", 1), "h", "h2", "block").rowsBetween(W.unboundedPreceding, -1)
    out = rows.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0))).join(told, "part")
    return out.select("block", "h", "h2", "n", "copies", (F.col("base") + F.col("before")).alias("start")), total


def id_width(tokenizer: str) -> int:
    """Bytes of an id of a tokenizer's file, with one number left for END."""
    return 2 if encoder(Path(tokenizer).read_text()).size < 1 << 16 else 4


def materialise(docs: DataFrame, path: str, key: int = 20240229, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, width: int = 1) -> int:
    """Write the shards under path (one file in each shard=N folder); returns the number of slots.

    text_col holds texts, which the tokenizer's file encodes, or without one, binary ids of 1, 2 or 4 bytes.
    """
    spark = docs.sparkSession
    blob = spark.sparkContext.broadcast(Path(tokenizer).read_text()) if tokenizer else None
    width = id_width(tokenizer) if tokenizer else width
    name, text = F.col(id_col).cast("string"), F.col(text_col)
    rows = docs.select(F.xxhash64(name, text).alias("h"), F.xxhash64(text, name, F.lit(1)).alias("h2"), text.alias("text"))
    blocks, drop = cut_by(rows.mapInArrow(_blocks(blob, width), _BLOCK_SQL), "training-blocks", "block", min(MOST_BUCKETS, 2 * partitions_of(rows)))
    starts, total_ids = _starts(blocks.where(F.col("kind") == TEXT).drop("kind", "data"))
    total = -(-total_ids // LENGTH)
    if total:
        starts = cut(starts, "training-starts")
        data = blocks.where(F.col("kind") == DATA).select("block", "data")
        pieces = data.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(_pieces(total, key, width), "slot long, at int, n int, data binary")
        shard = F.floor(F.col("slot") / shard_slots(width))
        shards = -(-total // shard_slots(width))
        tasks = min(shards, MOST_TASKS)
        dealt = pieces.repartitionById(tasks, F.floor(shard * tasks / shards).cast("int")).sortWithinPartitions("slot", "at")
        records = dealt.mapInArrow(_records(total, key, width), "slot long, data binary")
        records.select(shard.alias("shard"), F.col("data").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).partitionBy("shard").text(path)
        drop_table(starts)
    drop()
    return total


def _cut_up(first, last, width):
    size, step, slots_each = LENGTH * width, stride(width), shard_slots(width)

    def rows(batches):
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if len(data) % step:
                    raise ValueError(f"shard {shard} is not a whole number of records")
                start = shard * slots_each
                lo, hi = max(first, start), min(last, start + len(data) // step)
                for a in range(lo, hi, at_once := max(1, 8192 // width)):
                    slots = range(a, min(a + at_once, hi))
                    records = [data[(s - start) * step : (s - start) * step + size] for s in slots]
                    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array([shard] * len(slots), pa.int64()), pa.array([(s - start) * step for s in slots], pa.int64()), pa.array([_ends(r, width) for r in records], pa.int64()), pa.array([hashlib.sha256(r).hexdigest() for r in records]), pa.array(records, pa.binary())], ["slot", "shard", "byte_offset", "n_ends", "ids_sha256", "ids"])

    return rows


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int = 1 << 62, width: int = 1) -> DataFrame:
    """Records of the slots from first up to last (exclusive); other shards are not opened."""
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, shard long").option("basePath", path).option("pathGlobFilter", "*.txt").load(path)
    some = files.where(F.col("shard").between(first // shard_slots(width), (last - 1) // shard_slots(width))).select("shard", "content")
    return some.mapInArrow(_cut_up(first, last, width), "slot long, shard long, byte_offset long, n_ends long, ids_sha256 string, ids binary")


def round_trip(docs: DataFrame, tokenizer: str | None = None, width: int = 1, **columns) -> DataFrame:
    """Write shards of all rows to the shared folder; per slot, what the shards hold."""
    spark = docs.sparkSession
    path = scratch_path(spark, "training-order")
    if not materialise(docs, path, tokenizer=tokenizer, width=width, **columns):
        return spark.createDataFrame([], "slot long, shard long, byte_offset long, n_ends long, ids_sha256 string")
    return read_slots(spark, path, width=id_width(tokenizer) if tokenizer else width).drop("ids")
