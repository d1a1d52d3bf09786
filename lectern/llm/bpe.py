"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts texts where their content says so, so passages that documents share become
equal chunks.  A chunk that occurs in two documents or more is encoded once, in a table keyed by
its digest; what lies between such chunks is encoded where it is read.  Then the joins are
repaired: the last segments before a join and the first after it (a segment ends where white
space begins) are encoded together, and more of them, until the result agrees on both sides with
the ids that the chunks have there.  Where the chunks' ends do not settle it, the whole text is
encoded anew.  This takes any tokenizer file; see tokens.Encoder.

Which chunks are shared is told to the tasks by a Bloom filter of fixed size.  A false positive
only moves one more chunk to the table, so the result is exact at every size.

Defined results: null reads as empty text, which has no ids; repeated rows each get a row; a
null id stays null; an empty table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import bloom_filter, bloom_keys, cut, hot_lookup, in_bloom, mix64, slices, texts_of, tidy
from lectern.llm.tokens import Part, encoder, join_parts

#: A chunk has about 1 << CHUNK_BITS bytes, and at least CHUNK_LEAST.
CHUNK_BITS, CHUNK_LEAST, WINDOW = 10, 64, 32
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def boundaries(text: bytes) -> list[int]:
    """Ends of the chunks of a text, by content; never within a character."""
    n = len(text)
    if n <= CHUNK_LEAST:
        return [n] if n else []
    raw = np.frombuffer(text, np.uint8)
    h = _GEAR[raw]
    for s in (1, 2, 4, 8, 16):
        h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    ends = np.flatnonzero((h >> np.uint32(32 - CHUNK_BITS)) == 0) + 1
    out, last = [], 0
    for e in ends[ends >= WINDOW].tolist():
        while e < n and raw[e] & 0xC0 == 0x80:
            e += 1
        if e - last >= CHUNK_LEAST and e < n:
            out.append(e)
            last = e
    return [*out, n]


def chunks(text: bytes) -> list[bytes]:
    ends = boundaries(text)
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


@tidy
def _digests(batches):
    for batch in slices(batches, 0):
        found = [h for t in texts_of(batch.column(0)) for h in {_digest(c) for c in chunks(t)}]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["h"])


def shared_filter(texts: DataFrame):
    """Bloom filter of the digests of chunks that two documents or more have."""
    return bloom_filter(texts.mapInArrow(_digests, "h binary").groupBy("h").count().where("count > 1").select("h"))


_FIELDS = pa.schema([("kind", pa.int32()), ("row", pa.int64()), ("id", pa.string()), ("idx", pa.int32()), ("n", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("h", pa.binary()), ("text", pa.string()), ("ids", pa.binary()), ("head_n", pa.list_(pa.int32())), ("tail_n", pa.list_(pa.int32()))])
_SQL = "kind int, row long, id string, idx int, n long, ids_sha256 string, decoded_sha256 string, h binary, text string, ids binary, head_n array<int>, tail_n array<int>"
_PART = "text string, ids binary, head_n array<int>, tail_n array<int>"
DONE, PART, REF = 0, 1, 2
#: Bytes of text that are encoded at once: a word is looked up once in each.
AT_ONCE = 4 << 20


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)


def _first_pass(blob, bits):
    """Documents without shared chunks end here; others become parts and references to chunks."""

    def rows(batches):
        enc, told = encoder(blob.value), set()
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, 1, AT_ONCE):
            names, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
            cuts = [chunks(t) for t in texts]
            keys = [[_digest(c) for c in some] for some in cuts]
            shared = iter(in_bloom(bits.value, bloom_keys(pa.array([h for some in keys for h in some], pa.binary()))).tolist())
            whole, runs, out = [], [], []
            for name, text, some, hashes in zip(names, texts, cuts, keys, strict=True):
                row += 1
                marks = [next(shared) for _ in some]
                if not any(marks):
                    whole.append((row, name, text))
                    continue
                run: list[bytes] = []
                for idx, (chunk, h, is_shared) in enumerate([*zip(some, hashes, marks, strict=True), (b"", b"", True)]):
                    if not is_shared:
                        run.append(chunk)
                        continue
                    if run:
                        runs.append((row, name, idx - 1, b"".join(run)))
                        run = []
                    if h:
                        out.append((REF, row, name, idx, None, None, None, h, None if h in told else chunk.decode(), None, None, None))
                        told.add(h)
            for (r, name, _), ids in zip(whole, enc.encode([w[2] for w in whole]), strict=True):
                out.append((DONE, r, name, 0, *enc.digests(ids), None, None, None, None, None))
            for (r, name, idx, _), p in zip(runs, enc.parts([x[3] for x in runs]), strict=True):
                out.append((PART, r, name, idx, None, None, None, None, *p))
            yield _batch(out, _FIELDS)
        enc.forget()

    return tidy(rows)


def _encode_chunks(blob):
    fields = pa.schema([("h", pa.binary()), ("n_refs", pa.int64()), *list(_FIELDS)[-4:]])

    def rows(batches):
        enc = encoder(blob.value)
        for batch in slices(batches, "text", AT_ONCE):
            parts = enc.parts(texts_of(batch.column("text")))
            yield _batch([(h, n, *p) for h, n, p in zip(batch.column("h").to_pylist(), batch.column("n_refs").to_pylist(), parts, strict=True)], fields)
        enc.forget()

    return tidy(rows)


def _stitch(blob):
    """Rows sorted by row and index; a document's rows may span batches."""
    fields = pa.schema([("id", pa.string()), ("n", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def rows(batches):
        enc = encoder(blob.value)
        at, name, parts = None, None, []
        for batch in slices(batches, "text"):
            out = []
            for row, own, *part in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text", "ids", "head_n", "tail_n")), strict=True):
                if row != at:
                    if at is not None:
                        out.append((name, *enc.digests(join_parts(enc, parts))))
                    at, name, parts = row, own, []
                parts.append(Part(*part))
            yield _batch(out, fields)
        if at is not None:
            yield _batch([(name, *enc.digests(join_parts(enc, parts)))], fields)
        enc.forget()

    return tidy(rows)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    sc = docs.sparkSession.sparkContext
    blob = sc.broadcast(Path(tokenizer).read_text())
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    bits = sc.broadcast(shared_filter(texts.select("text")))
    first = cut(texts.mapInArrow(_first_pass(blob, bits), _SQL), "bpe-parts")
    refs = first.where(F.col("kind") == REF)
    table = refs.groupBy("h").agg(F.min("text").alias("text"), F.count("*").alias("n_refs"))
    table = cut(table.select("h", "n_refs", "text").mapInArrow(_encode_chunks(blob), f"h binary, n_refs long, {_PART}"), "bpe-chunks")
    columns = ["row", "id", "idx", "text", "ids", "head_n", "tail_n"]
    found = hot_lookup(refs.select("row", "id", "idx", "h"), table, ["h"], "n_refs", "inner").select(columns)
    parts = first.where(F.col("kind") == PART).select(columns).unionByName(found)
    stitched = parts.repartition("row").sortWithinPartitions("row", "idx").mapInArrow(_stitch(blob), "id string, n long, ids_sha256 string, decoded_sha256 string")
    both = first.where(F.col("kind") == DONE).select("id", "n", "ids_sha256", "decoded_sha256").unionByName(stitched)
    return both.select(F.col("id").cast(docs.schema[id_col].dataType).alias("doc_id"), F.col("n").alias("n_tokens"), "ids_sha256", "decoded_sha256")
