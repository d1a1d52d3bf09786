"""WARC archives: writing with revisit records, and reading back by boundary-chain verification.

Writing: pages with equal payloads of DEDUP_BYTES or more keep one response, that with the
smallest id; the others become revisit records that name it.  Archives are gzip files of at most
ARCHIVE_BYTES unpacked, written by Spark's text writer; the blank lines that end a record are its
line separator.

Reading: a task finds every version line in an archive, also those inside payloads, and takes
each as a candidate record whose header says where its successor begins.  Pointer jumping from
the file's start (each round doubles the distance) marks the candidates that are reachable; the
rest are magic inside payloads.  A chain must end at the file's end, and payload digests must
agree, or reading fails.

Defined results: a null html is an empty payload; small payloads are never revisits; repeated
rows of one id with one payload are a response each, as no smaller id has it, and have one record id; a
row without an id is a response of its own, whose record id is made of its payload and address; an empty table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import cut, hot_lookup, scratch_path, tidy

# Fixed values of the format.
MAGIC, END = b"WARC/1.1\r\n", "\r\n\r\n"
_HEADER = re.compile(rb"WARC/1\.1\r\n((?:[A-Za-z0-9-]+: [^\r\n]*\r\n)+)\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads of fewer bytes are never revisits.
DEDUP_BYTES = 100
#: Most bytes of an archive, unpacked; a larger record has one to itself.
ARCHIVE_BYTES = 32 << 20


def plan(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", uri_col: str = "url") -> DataFrame:
    """Rows to write: page_id, url, html, payload_bytes, payload_digest, refers_to.

    Only ids and digests are grouped; html moves once, keyed by the page.
    """
    html = F.coalesce(F.col(text_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(uri_col), F.lit("")).alias("url"), html.alias("html"))
    rows = rows.withColumn("payload_bytes", F.octet_length("html").cast("long")).withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256))
    large = rows.where((F.col("payload_bytes") >= DEDUP_BYTES) & F.col("page_id").isNotNull())
    groups = large.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count("*").alias("copies")).where("first < last")
    groups = cut(groups.select(F.col("payload_digest").alias("key"), "first", "copies"), "warc-groups")
    key = F.when((F.col("payload_bytes") >= DEDUP_BYTES) & F.col("page_id").isNotNull(), F.col("payload_digest"))
    out = hot_lookup(rows.withColumn("key", key), groups, ["key"], "copies")  # small payloads have no key, and are spread
    return out.withColumn("refers_to", F.when(F.col("first") < F.col("page_id"), F.col("first"))).drop("key", "first", "copies")


@tidy
def _deal(batches):
    """Rows with the number of the task's archive that they go to: a new one where ARCHIVE_BYTES would be passed."""
    archive, size = 0, 0
    for batch in batches:
        numbers = []
        for n in pc.binary_length(batch.column("value")).to_pylist():
            if size and size + n + len(END) > ARCHIVE_BYTES:
                archive, size = archive + 1, 0
            size += n + len(END)
            numbers.append(archive)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), batch.column("value")], ["archive", "value"])


def _uuid(name) -> F.Column:
    h = F.md5(name.cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12)), F.lit(">"))


def write(planned: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write archives of records; a revisit has no block of its own."""
    nl = F.lit("\r\n")
    revisit = F.col("refers_to").isNotNull()
    uri = F.regexp_replace("url", r"[\r\n]", "")
    header = lambda k, v: F.concat(F.lit(f"{k}: "), v, nl)
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    name = F.when(F.col("page_id").isNotNull(), F.concat(F.lit("page:"), page)).otherwise(F.concat(F.lit("payload:"), F.col("payload_digest"), F.lit(" "), F.col("url")))
    record = F.concat(
        F.lit(MAGIC.decode()),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", _uuid(name)),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", uri),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        header("X-Page-ID", page),
        header("X-Payload-Bytes", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(header("WARC-Profile", F.lit(REVISIT_PROFILE)), header("WARC-Refers-To", _uuid(F.concat(F.lit("page:"), F.col("refers_to").cast("string")))), header("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(""),
        header("Content-Type", F.lit("text/html; charset=utf-8")),
        header("Content-Length", F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string"))),
        nl,
        F.when(revisit, "").otherwise(F.col("html")),
    )
    dealt = planned.select(record.alias("value")).mapInArrow(_deal, "archive int, value string")
    dealt.write.partitionBy("archive").option("lineSep", END).option("compression", "gzip").text(path)


def candidates(data: bytes) -> list[tuple[int, int, bytes]]:
    """(offset, successor's offset, header lines) of everything that looks like a record."""
    out = []
    at = data.find(MAGIC)
    while at >= 0:
        m = _HEADER.match(data, at)
        if m and (n := re.search(rb"^Content-Length: (\d+)\r$", m[1], re.M)):
            out.append((at, m.end() + int(n[1]) + len(END), m[1]))
        at = data.find(MAGIC, at + 1)
    return out


def reachable(offsets: np.ndarray, successors: np.ndarray, size: int) -> np.ndarray:
    """Marks of the candidates on the chain from offset 0, by pointer jumping.

    Raises ValueError where the chain does not end at the file's size.
    """
    n = len(offsets)
    if n == 0:
        if size:
            raise ValueError("no record at the start")
        return np.zeros(0, bool)
    at = np.searchsorted(offsets, successors)
    known = (at < n) & (offsets[np.minimum(at, n - 1)] == successors)
    jump = np.append(np.where(known, at, n), n)
    marks = np.zeros(n + 1, bool)
    marks[0] = offsets[0] == 0
    last = -1
    while marks.sum() != last:
        last = marks.sum()
        marks[jump[marks]] = True
        jump = jump[jump]
    marks = marks[:n]
    if not marks.any() or successors[marks].max() != size:
        raise ValueError("the chain of records breaks before the end of the file")
    return marks


def _records(data: bytes):
    found = candidates(data)
    marks = reachable(np.array([c[0] for c in found], np.int64), np.array([c[1] for c in found], np.int64), len(data))
    for (_, after, lines), on_chain in zip(found, marks.tolist(), strict=True):
        if not on_chain:
            continue
        head = dict(x.split(": ", 1) for x in lines.decode().split("\r\n") if x)
        end = after - len(END)
        payload = data[end - int(head["Content-Length"]) : end]
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if head["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"payload digest of page {head['X-Page-ID']} differs")
        yield head, digest, payload


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])


def _read(with_payload: bool):
    schema = _READ.append(pa.field("payload", pa.binary())) if with_payload else _READ

    def rows(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                data = gzip.decompress(data)
                out = []
                for head, digest, payload in _records(data):
                    number = lambda k: int(x) if (x := head.get(k)) else None  # noqa: E731, B023
                    out.append((number("X-Page-ID"), number("X-Payload-Bytes"), digest, head["WARC-Type"], number("X-Refers-To-Page"), head["WARC-Target-URI"], payload)[: len(schema)])
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return rows


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records on the chains of all archives under path; a revisit's payload is empty."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("content")
    return files.mapInArrow(_read(with_payload), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write archives of all pages to the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(plan(pages, **columns), path)
    return read(spark, path)
