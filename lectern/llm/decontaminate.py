"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts become canonical byte strings: ASCII lower case, words joined and framed by single
spaces.  A window of an item is then the byte string of its words, framed likewise, so a
substring hit is a hit on whole words.  Block shift tables skip positions where no window can
end, a suffix and prefix block select the windows to test, and a direct comparison confirms.

Defined results: null and empty texts have no words and no hits; an item without words has no
window; windows of an item without an id hit like others, but it is not among the items found; rows with
one item id are one item; repeated rows each get a row; an empty benchmark marks nothing; an empty table gives an
empty result.  Other columns of the input play no part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import cut, drop_table, slices, texts_of

#: Words in a window.
WINDOW = 10
#: Windows in one table; more windows are searched by further tables, each broadcast by itself.
WINDOWS_PER_TABLE = 200_000
#: Tables that workers hold at once.
TABLES_AT_ONCE = 4
#: Bytes of each lane of the search.
LANE = 2048
#: Windows shorter than this use blocks of three bytes, others of eight.
SHORT = 24

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
_CANON = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if b >= 128 or b in _KEEP else 32 for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_CANON).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """Framed windows of consecutive words; a shorter sequence is one window."""
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))]


class _Tables:
    """Shift table and suffix-prefix buckets of windows of one kind."""

    def __init__(self, patterns: list[bytes], block: int):
        self.block, self.m = block, min(map(len, patterns))
        first = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        values = [self._value(first, j - block) for j in range(block, self.m + 1)]
        self.bits = np.uint64(64 - min(24, max(12, int(np.log2(len(patterns) * len(values))) + 4)))
        self.shift = np.full(1 << (64 - int(self.bits)), min(255, self.m - block + 1), np.uint8)
        for j, v in enumerate(values):
            h = self._hash(v)
            self.shift[h] = np.minimum(self.shift[h], min(255, self.m - block - j))
        self.buckets = defaultdict(list)
        for p, k in zip(patterns, self._key(values[-1], values[0]).tolist(), strict=True):
            self.buckets[k].append(p)
        self.keys = np.array(sorted(self.buckets), np.uint64)

    def _value(self, rows: np.ndarray, at: int) -> np.ndarray:
        v = np.zeros(len(rows), np.uint64)
        for i in range(self.block):
            v |= rows[:, at + i].astype(np.uint64) << np.uint64(8 * i)
        return v

    def _hash(self, v: np.ndarray) -> np.ndarray:
        return ((v * _ODD) >> self.bits).astype(np.int64)

    @staticmethod
    def _key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return suffix * np.uint64(0xD6E8FEB86659FD93) + (prefix ^ (prefix >> np.uint64(31))) * _ODD

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, window) of every occurrence in text."""
        n, m = len(text), self.m
        if n < m:
            return
        padded = text + bytes(8)
        loads = np.ndarray((n,), np.dtype("<u8"), padded, strides=(1,))
        mask = np.uint64((1 << (8 * self.block)) - 1)
        load = (lambda at: loads[at]) if self.block == 8 else (lambda at: loads[at] & mask)
        pos = np.arange(m, n + 1, LANE)  # where a window of m bytes would end
        stop = np.minimum(pos + LANE, n + 1)
        ends = []
        while len(pos):
            step = self.shift[self._hash(load(pos - self.block))]
            if not step.all():
                ends.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            on = pos < stop
            if not on.all():
                pos, stop = pos[on], stop[on]
        if not ends:
            return
        ends = np.concatenate(ends)
        keys = self._key(load(ends - self.block), load(ends - m))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        for end, key in zip(ends[hit].tolist(), keys[hit].tolist(), strict=True):
            for p in self.buckets[key]:
                if text.startswith(p, end - m):
                    yield end - m, p


class Matcher:
    """Search for a bounded set of windows."""

    def __init__(self, items: dict[bytes, list]):
        self.items = items
        kinds = ([p for p in items if len(p) < SHORT], 3), ([p for p in items if len(p) >= SHORT], 8)
        self.tables = [_Tables(sorted(p), b) for p, b in kinds if p]

    def mark(self, texts: list[bytes]) -> list[tuple[int, set[int], set]]:
        """Of each text: the number of words, the indices of hit words, the items that occur."""
        words = [words_of(t) for t in texts]
        framed = [b" " + b" ".join(w) + b" " for w in words]
        out = [(len(w), set(), set()) for w in words]
        first = np.cumsum([0, *map(len, framed)])
        buffer = b"".join(framed)
        spaces = None
        for table in self.tables:
            for start, p in table.search(buffer):
                if spaces is None:
                    spaces = np.cumsum(np.frombuffer(buffer, np.uint8) == 32, dtype=np.int32)
                k = int(np.searchsorted(first, start, "right")) - 1
                at = int(spaces[start] - spaces[first[k]])
                out[k][1].update(range(at, at + p.count(b" ") - 1))
                out[k][2].update(i for i in self.items[p] if i is not None)
        return out


def _tables(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> Iterator[list]:
    """Broadcast matchers, each over about WINDOWS_PER_TABLE (window, item) pairs, at most TABLES_AT_ONCE together."""
    spark = benchmark.sparkSession

    def cut_up(batches):
        for batch in batches:
            pairs = [(w, i) for t, i in zip(texts_of(batch.column(1)), batch.column(0).to_pylist(), strict=True) for w in set(windows_of(words_of(t), size))]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.string())], ["w", "item"])

    pairs = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("t")).mapInArrow(cut_up, "w binary, item string").distinct()
    pairs = cut(pairs.withColumn("part", F.pmod(F.xxhash64("w"), F.lit(1 << 20))).sortWithinPartitions("part"), "benchmark-windows")
    shards = pairs.count() // WINDOWS_PER_TABLE + 1
    some = []
    for k in range(shards):
        items = defaultdict(list)
        low, high = ((1 << 20) * i // shards for i in (k, k + 1))
        for w, item in pairs.where(F.col("part").between(low, high - 1)).select("w", "item").toLocalIterator():
            items[bytes(w)].append(item)
        if items:
            some.append(spark.sparkContext.broadcast(Matcher(dict(items))))
        if len(some) == TABLES_AT_ONCE:
            yield some
            some = []
    if some:
        yield some
    drop_table(pairs)


def _through(rows: DataFrame, groups: Iterator[list], step) -> tuple[DataFrame, bool]:
    """rows after a step for each matcher, and whether there was one.

    Between groups of matchers the rows are written and the group is taken from all workers.
    """
    last: list = []
    for some in groups:
        if last:
            rows = cut(rows, "overlaps")
            for matcher in last:
                matcher.unpersist()
        for matcher in some:
            rows = step(rows, matcher)
        last = some
    return rows, bool(last)


def _searcher(matcher):
    def search(batches):
        for batch in slices(batches, "text"):
            marks = matcher.value.mark(texts_of(batch.column("text")))
            hits = [sorted(words.union(old)) for (_, words, _), old in zip(marks, batch.column("hits").to_pylist(), strict=True)]
            items = [sorted(found.union(old)) for (_, _, found), old in zip(marks, batch.column("items").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text"), pa.array([m[0] for m in marks], pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], ["id", "text", "n_words", "hits", "items"])

    return search


def _count_words(batches):
    for batch in batches:
        n = [len(words_of(t)) for t in texts_of(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), *batch.columns[3:]], batch.schema.names)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row of docs: id, n_words, hits (indices of hit words), items (ids, sorted as strings).

    The text passes once through each table of windows, without a shuffle; TABLES_AT_ONCE tables share a stage.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, text string, n_words long, hits array<int>, items array<string>"
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    out, any_window = _through(out, _tables(benchmark, item_id, item_text, size), lambda rows, matcher: rows.mapInArrow(_searcher(matcher), schema))
    if not any_window:
        out = out.mapInArrow(_count_words, schema)
    return out.drop("text")


def digest(overlaps: DataFrame) -> DataFrame:
    return overlaps.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """Rows of docs with no hit; all columns as they were."""
    keys = {"id_col": "doc_id", "text_col": "text"} | columns
    tables = _tables(benchmark, keys.get("item_id", "item_id"), keys.get("item_text", "text"), keys.get("size", WINDOW))
    at = docs.columns.index(keys["text_col"])

    def keep(matcher):
        def rows(batches):
            for batch in slices(batches, at):
                yield batch.filter(pa.array([not words for _, words, _ in matcher.value.mark(texts_of(batch.column(at)))], pa.bool_()))

        return rows

    return _through(docs, tables, lambda rows, matcher: rows.mapInArrow(keep(matcher), docs.schema))[0]
