"""Quality classifier: interpolated modified Kneser-Ney model of UTF-8 byte 5-grams.

Counts come from all trusted text but the part held out for the quantiles.  Texts are dealt to
blocks of bounded size, in the order in which a task reads them; a block asks for the n-grams that
its texts have, each once, and counts those of its trusted texts.  Both go to bins by a hash of the
n-gram.  The counts are joined, sharded by n-gram and by context, into the probability of every
n-gram that is asked for, order by order; lower orders use continuation counts.  Bins then
answer blocks, and a block's texts get their perplexities from its answers.  Neither the model nor
texts go to the driver, and nothing is broadcast but a filter of fixed size.  The way is the same
at every size.

A document is rejected where the logarithm of its perplexity a byte exceeds the HIGH quantile of
trusted documents of its language; these are held out from the counts, as others are scored out
of sample too, and the limit is wider for short texts, whose mean is noisy.

Which documents may be trusted is told to the blocks by a Bloom filter.  What it lets through in
error is found by a join of ids alone, and the counts of those texts are taken off again, so the
counts are exact.

Defined results: null and empty texts have no perplexity and are rejected; a null language is a
language of its own, other than the empty one; languages with fewer than OWN_LIMIT held-out documents
use the quantile of all held-out documents; without any trusted text nothing but empty text is
rejected; repeated rows each get a row; rows without an id are scored and not trusted; repeated or
contradictory labels count as trusted if one is; an empty table gives an empty result.  Other
columns play no part, and passed() keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm.common import MOST_BUCKETS, bloom_filter, cut, cut_by, drop_table, give_back, in_bloom, mix64, partitions_of, slices, texts_of, tidy

#: Bytes of an n-gram; 0 stands before the text, and byte b is symbol b + 1.
ORDER, BITS = 5, 9
#: Discounts where the counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)
#: Bytes of text in a block, of a slice of it that is worked on at once, and of a piece of a long text.
BLOCK_BYTES, SLICE, PIECE = 8 << 20, 1 << 20, 1 << 20
#: Bins of n-grams, and blocks whose requests to a bin go to one task.
BINS, BLOCKS_A_TASK = 256, 2_048
#: Rejected: log perplexity over this quantile of trusted documents of the language.
HIGH = 0.99
#: One of so many trusted documents, by a hash of the id, is held out; a language's own limit needs so many.
HELD_OUT, OWN_LIMIT = 5, 20
#: Added for short texts, over the square root of the number of bytes: the mean of few is noisy.
SHORT_SLACK = 2.0


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER-gram that ends at each byte of the texts, and the text that each belongs to."""
    parts, owner, sizes = [], [], []
    pad = np.zeros(ORDER - 1, np.int64)
    for i, text in enumerate(texts):
        for at in range(0, len(text), PIECE):
            piece = np.frombuffer(text, np.uint8, min(PIECE, len(text) - at), at)
            before = pad if at == 0 else np.frombuffer(text, np.uint8, ORDER - 1, at - ORDER + 1).astype(np.int64) + 1
            parts += [before, piece.astype(np.int64) + 1]
            owner.append(i)
            sizes.append(len(piece))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    s = np.concatenate(parts)
    n = len(s) - ORDER + 1
    out = s[:n].copy()
    for i in range(1, ORDER):
        out = (out << BITS) | s[i : i + n]
    own = np.repeat(np.arange(len(sizes)), np.array(sizes))
    at = np.arange(len(own)) + own * (ORDER - 1)  # a piece has ORDER - 1 symbols before it
    return out[at], np.array(owner)[own]


def _bin(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys.view(np.uint64)) >> np.uint64(56)).astype(np.int32) % BINS


def _pack(numbers: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed byte plane by byte plane."""
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, kind=np.int64) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], n * 8, "zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    every = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    every = every[order]
    starts = np.flatnonzero(np.diff(every, prepend=-1))
    sums = np.add.reduceat(np.concatenate(counts)[order], starts) if len(starts) else np.zeros(0, np.int64)
    return every[starts], sums


_BLOCK = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bin", pa.int32()), ("keys", pa.binary()), ("values", pa.binary()), ("data", pa.binary()), ("h", pa.int64())])
_BLOCK_SQL = "kind int, block long, bin int, keys binary, values binary, data binary, h long"
REQUEST, DATA, MAYBE = 0, 1, 2


def _rows(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def _blocks(bits):
    """Texts in blocks; the n-grams that a block asks for with their counts in texts that may be trusted; hashes of these texts' ids."""

    def block_rows(block: int, held: list[pa.RecordBatch], asked, counted) -> Iterator[pa.RecordBatch]:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
            for b in held:
                out.write_batch(b)
        yield _rows([(DATA, block, -1, None, None, sink.getvalue().to_pybytes(), None)], _BLOCK)
        keys = np.unique(np.concatenate(asked)) if asked else np.zeros(0, np.int64)
        counts = np.zeros(len(keys), np.int64)
        known, sums = _tally(*zip(*counted, strict=True)) if counted else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        counts[np.searchsorted(keys, known)] = sums
        bins = _bin(keys)
        order = np.argsort(bins, kind="stable")
        keys, counts, bins = keys[order], counts[order], bins[order]
        ends = np.searchsorted(bins, np.arange(BINS + 1))
        yield _rows([(REQUEST, block, k, _pack(keys[a:b]), _pack(counts[a:b]), None, None) for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)) if b > a], _BLOCK)

    def rows(batches):
        block, size = TaskContext.get().partitionId() << 32, 0
        held, asked, counted = [], [], []
        for batch in slices(batches, "__text", SLICE):
            texts, hashes = texts_of(batch.column("__text")), batch.column("__h")
            maybe = np.zeros(len(texts), bool)
            valid = hashes.is_valid().to_numpy(zero_copy_only=False)
            maybe[valid] = in_bloom(bits.value, hashes.drop_null().to_numpy(zero_copy_only=False).view(np.uint64))
            held.append(batch.drop_columns(["__h"]))
            g, own = grams(texts)
            asked.append(np.unique(g))
            if maybe.any():
                counted.append(np.unique(g[maybe[own]], return_counts=True))
                yield _rows([(MAYBE, block, -1, None, None, None, h) for h in np.unique(hashes.drop_null().to_numpy(zero_copy_only=False)[maybe[valid]]).tolist()], _BLOCK)
            size += sum(map(len, texts))
            if size >= BLOCK_BYTES:
                yield from block_rows(block, held, asked, counted)
                block, size = block + 1, 0
                held, asked, counted = [], [], []
        if held:
            yield from block_rows(block, held, asked, counted)

    return tidy(rows)


@tidy
def _merge(batches):
    """(n-gram, count) of requests, summed over as many as fit at once."""
    keys, counts, size = [], [], 0
    for batch in batches:
        for k, c in zip(batch.column("keys").to_pylist(), batch.column("values").to_pylist(), strict=True):
            keys.append(_unpack(k))
            counts.append(_unpack(c))
            size += len(keys[-1])
            if size > 4_000_000:
                g, c = _tally(keys, counts)
                keys, counts, size = [g], [c], len(g)
                if size > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], ["g", "c"])
                    keys, counts, size = [], [], 0
    g, c = _tally(keys, counts)
    yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c)], ["g", "c"])


@tidy
def _take_off(batches):
    for batch in slices(batches, 0, SLICE):
        g, c = np.unique(grams(texts_of(batch.column(0)))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(-c)], ["g", "c"])


def _suffix(g: str, k: int) -> Column:
    return F.col(g).bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def _discounts(counts: DataFrame) -> list[float]:
    n = counts.agg(*(F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4))).first()
    if min(n) > 0:
        y = n[0] / (n[0] + 2 * n[1])
        own = [i - (i + 1) * y * n[i] / n[i - 1] for i in (1, 2, 3)]
        if all(0 < d <= i for i, d in enumerate(own, 1)):
            return own
    return list(FALLBACK)


def probabilities(counts: DataFrame) -> DataFrame:
    """(g, p) of every row of counts (g, c); rows with a count of 0 are only asked for."""
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = cut(levels[k + 1].groupBy(_suffix("g", k).alias("g")).agg(F.count_if(F.col("c") > 0).alias("c")), "quality-counts")
    size = levels[1].where("c > 0").count() + 1
    below = None
    for k in range(1, ORDER + 1):
        c, d = levels[k].withColumn("h", F.shiftright("g", BITS)), _discounts(levels[k])
        freed = F.when(F.col("c") == 0, 0.0).when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        of = c.groupBy("h").agg(F.sum("c").alias("total"), F.sum(freed).alias("freed")).where("total > 0")
        rows = c.join(of, "h", "left").withColumn("s", _suffix("g", k - 1))
        rows = rows.join(below.select(F.col("g").alias("s"), F.col("p").alias("lower")), "s") if k > 1 else rows.withColumn("lower", F.lit(1.0 / size))
        old, below = below, cut(rows.select("g", F.coalesce((F.col("c") - freed) / F.col("total") + F.col("freed") / F.col("total") * F.col("lower"), "lower").alias("p")), "quality-level")
        if old is not None:
            drop_table(old)
        if k < ORDER:
            drop_table(levels[k])
    return below


_ANSWER = pa.schema([("block", pa.int64()), ("bin", pa.int32()), ("logs", pa.binary())])


@tidy
def _answer(batches):
    """Rows sorted by bin, task and kind: a bin's n-grams with their logarithms, then requests."""
    at, g, p, known, logs = None, [], [], None, None
    for batch in batches:
        out = []
        columns = [batch.column(c) for c in ("bin", "part", "kind", "block", "keys")]
        number, values = batch.column("g").to_numpy(zero_copy_only=False), batch.column("log").to_numpy(zero_copy_only=False)
        bins, parts, kinds = (c.to_numpy(zero_copy_only=False) for c in columns[:3])
        starts = np.flatnonzero((np.diff(bins, prepend=-1) != 0) | (np.diff(parts, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(bins)], strict=True):
            if (bins[a], parts[a]) != at:
                at, g, p, known = (bins[a], parts[a]), [], [], None
            if kinds[a] == 0:
                g.append(number[a:b].astype(np.int64))
                p.append(values[a:b])
                continue
            if known is None:
                known, logs = np.concatenate(g), np.concatenate(p)
                order = np.argsort(known)
                known, logs = known[order], logs[order]
                g, p = [], []
            for block, data in zip(columns[3][a:b].to_pylist(), columns[4][a:b].to_pylist(), strict=True):
                out.append((block, int(bins[a]), _pack(logs[np.searchsorted(known, _unpack(data))])))
        yield _rows(out, _ANSWER)


def _score(columns: list[str], fields: pa.Schema):
    """The scored rows of a block, from its own rows and from the answers to it."""

    def scored(batch: pa.RecordBatch, known, logs) -> pa.RecordBatch:
        texts = texts_of(batch.column("__text"))
        g, own = grams(texts)
        distinct, inverse = np.unique(g, return_inverse=True)
        sums = np.bincount(own, logs[np.searchsorted(known, distinct)][inverse], len(texts)) if len(g) else np.zeros(len(texts))
        sizes = list(map(len, texts))
        mean = [-s / n if n else None for s, n in zip(sums.tolist(), sizes, strict=True)]
        found = [*(batch.column(c) for c in columns), batch.column("__id"), batch.column("__lang"), pa.array(sizes, pa.int64()), pa.array(mean, pa.float64())]
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(found, fields, strict=True)], schema=fields)

    def rows(block: pa.Table, answers: pa.Table) -> pa.Table:
        give_back()
        told = dict(zip(answers.column("bin").to_pylist(), answers.column("logs").to_pylist(), strict=True))
        kinds, bins, keys, data = (block.column(c).to_pylist() for c in ("kind", "bin", "keys", "data"))
        asked = [(_unpack(k), _unpack(told[b], np.float64)) for kind, b, k in zip(kinds, bins, keys, strict=True) if kind == REQUEST]
        known, logs = (np.concatenate(x) for x in zip(*asked, strict=True)) if asked else (np.zeros(0, np.int64), np.zeros(0))
        order = np.argsort(known)
        known, logs = known[order], logs[order]
        parts = [part for kind, d in zip(kinds, data, strict=True) if kind == DATA for part in pa.ipc.open_stream(d)]
        return pa.Table.from_batches([scored(part, known, logs) for part in parts], fields)

    return rows


def is_held_out(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(HELD_OUT)) == 0


def _hash(key: str) -> Column:
    return F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("string")))


def _scored(docs: DataFrame, labels: DataFrame, keep: list[str], id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The columns in keep (as __0, __1, ...), __id, __lang, __size (bytes) and __log (log perplexity a byte) of each row, and __limit."""
    kept = [f"__{i}" for i in range(len(keep))]
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("__id")).distinct()
    counted = good.where(~is_held_out(F.col("__id")))
    bits = docs.sparkSession.sparkContext.broadcast(bloom_filter(counted.select(_hash("__id"))))
    rows = docs.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)), F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"), F.col(text_col).alias("__text"), _hash(id_col).alias("__h"))
    blocks, drop_blocks = cut_by(rows.mapInArrow(_blocks(bits), _BLOCK_SQL), "quality-blocks", "block", min(MOST_BUCKETS, 2 * partitions_of(rows)))
    wrong = blocks.where(F.col("kind") == MAYBE).select(F.col("h").alias("__h")).distinct().join(counted.select(_hash("__id").alias("__h")), "__h", "left_anti")
    wrong = cut(wrong, "quality-wrong")  # of known size now, so the few are broadcast, and texts move only where they are many
    texts = docs.select(F.col(text_col).alias("__text"), _hash(id_col).alias("__h")).where("__h is not null").join(wrong, "__h", "left_semi").select("__text")
    tasks = blocks.where(F.col("kind") == DATA).count() // BLOCKS_A_TASK + 1
    part = F.pmod(F.xxhash64("block"), F.lit(tasks)).cast("int")
    requests = blocks.where(F.col("kind") == REQUEST)
    merged = requests.select("bin", part.alias("part"), "keys", "values").repartition("bin", "part").mapInArrow(_merge, "g long, c long")
    counts = cut(merged.unionByName(texts.mapInArrow(_take_off, "g long, c long")).groupBy("g").agg(F.sum("c").alias("c")), "quality-counts")
    model = probabilities(counts)
    drop_table(counts)
    told = model.mapInArrow(_binned, "bin int, g long, log double").select("bin", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("binary").alias("keys"), "g", "log")
    asked = requests.select("bin", part.alias("part"), F.lit(1).alias("kind"), "block", "keys", F.lit(0).cast("long").alias("g"), F.lit(0.0).alias("log"))
    answers = told.unionByName(asked).repartition("bin", "part").sortWithinPartitions("bin", "part", "kind").mapInArrow(_answer, "block long, bin int, logs binary")
    schema = T.StructType([*(T.StructField(k, docs.schema[c].dataType) for c, k in zip(keep, kept, strict=True)), T.StructField("__id", docs.schema[id_col].dataType), T.StructField("__lang", T.StringType()), T.StructField("__size", T.LongType()), T.StructField("__log", T.DoubleType())])
    own = blocks.where(F.col("kind").isin(REQUEST, DATA)).select("block", "kind", "bin", "keys", "data").groupBy("block")
    out = cut(own.cogroup(answers.groupBy("block")).applyInArrow(_score(kept, to_arrow_schema(schema)), schema), "quality-scores")
    drop_table(model)
    drop_table(wrong)
    drop_blocks()
    mark = F.expr(f"percentile_approx(__log, {HIGH}, 10000)")
    base = out.where("__log is not null").select("__id", "__lang", "__log").join(good.where(is_held_out(F.col("__id"))), "__id", "left_semi")
    limits = base.groupBy(F.col("__lang").alias("__of")).agg(mark.alias("__own"), F.count("*").alias("n")).where(F.col("n") >= OWN_LIMIT).drop("n")
    limits = cut(limits, "quality-limits")  # of known size now, so that few languages are broadcast, and texts do not move by language
    every = base.agg(mark.alias("q")).first()["q"]
    general = F.lit(float("inf") if every is None else every)
    out = out.join(limits, F.col("__lang").eqNullSafe(F.col("__of")), "left")
    return out.withColumn("__limit", F.coalesce("__own", general) + SHORT_SLACK / F.sqrt(F.greatest("__size", F.lit(1)))).drop("__own", "__of")


def _binned(batches):
    for batch in batches:
        g = batch.column("g").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(_bin(g)), batch.column("g"), pa.array(np.log(batch.column("p").to_numpy()))], ["bin", "g", "log"])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, lang, log_ppl (a byte), perplexity, limit (of log_ppl), rejected."""
    rows = _scored(docs, labels, [], id_col, text_col, lang_col)
    return rows.select(F.col("__id").alias("doc_id"), F.col("__lang").alias("lang"), F.col("__log").alias("log_ppl"), F.exp("__log").alias("perplexity"), F.col("__limit").alias("limit"), F.coalesce(F.col("__log") > F.col("__limit"), F.lit(True)).alias("rejected"))


def passed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that are not rejected, each judged by itself; all columns as they were."""
    return _scored(docs, labels, docs.columns, id_col, text_col, lang_col).where("__log <= __limit").select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)))
