import gzip
import hashlib
from importlib.util import find_spec

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm import queries
from lectern.llm import training_order as to
from lectern.llm import warc
from lectern.llm.queries import tokenizer_path
from tests_llm_cases import LONG, empty, odd, odd_rows, words

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: x\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def test_round_trip_rejects_magic_in_payloads(spark):
    big = "<p>" + "é" * 200
    rows = [(5, "u\r\nX: y", big), (3, "u", big), (9, None, big), (4, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"), (10, "u", FAKE), (11, "u", FAKE * 3), (12, "u", "\r\n\r\n" + FAKE), (13, "u", LONG), (None, "u", big), (20, "u", "x" * 99), (21, "u", "x" * 99), (22, "u", "x" * 100), (23, "u", "x" * 100)]
    pages = spark.createDataFrame([(*r, 1, "clash") for r in rows], "page_id long, url string, html string, copies int, payload_digest string").repartition(3)
    path = warc.scratch_path(spark, "warc-test")
    warc.write(warc.plan(pages), path)
    got = {r["page_id"]: r for r in warc.read(spark, path, with_payload=True).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, html in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (html or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        want = first.setdefault(data, i) if len(data) >= 100 else i
        assert (r["record_type"], r["refers_to"]) == (("response", None) if want == i else ("revisit", want))
        assert bytes(r["payload"]) == (data if want == i else b"")
    assert got[None]["record_type"] == "response"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chains():
    a = np.array([0, 10, 17, 30], np.int64)
    assert warc.reachable(a, np.array([10, 30, 99, 40]), 40).tolist() == [True, True, False, True]
    with pytest.raises(ValueError):
        warc.reachable(a, np.array([10, 29, 99, 40]), 40)
    with pytest.raises(ValueError):
        warc.reachable(a[:0], a[:0], 5)
    offsets = np.arange(0, 5000, 5)
    assert warc.reachable(offsets, offsets + 5, 5000).all()


def test_a_changed_payload_is_found(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x" * 200)], "page_id long, url string, html string")
    warc.write(warc.plan(pages), str(tmp_path / "w"))
    file = next(p for p in (tmp_path / "w").rglob("*.gz") if gzip.decompress(p.read_bytes()))
    with pytest.raises(ValueError, match="digest"):
        list(warc._records(gzip.decompress(file.read_bytes()).replace(b"xxx", b"xyx")))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000, 4097])
def test_feistel_is_a_bijection(n):
    for key in (0, 7, 2**63 + 5):
        assert sorted(to.feistel(np.arange(n), n, key).tolist()) == list(range(n))
    assert n < 17 or (to.feistel(np.arange(n), n, 1) != to.feistel(np.arange(n), n, 2)).any()


def test_archives_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    rows = [(i, f"http://x/{i}", "p" * (i * 37 % 1500)) for i in range(200)] + [(900, "http://long", "z" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    warc.write(warc.plan(pages), path)
    files = [gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("archive=*/part-*.gz")]
    assert len(files) > 10 and all(len(f) <= 4000 or f.count(warc.MAGIC) == 1 for f in files)
    got = {r["page_id"]: r for r in warc.read(spark, path).collect()}
    assert {i: r["payload_bytes"] for i, r in got.items()} == {i: len(h) for i, _, h in rows}


def test_half_of_the_pages_are_empty(spark):
    rows = [(i, None, None if i % 2 else f"page {i}" * 40) for i in range(400)] + [(None, None, None)] * 50
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    assert len(got) == 450 and all(r["record_type"] == "response" for r in got)


def slow_feistel(i, total, key):
    """The same network over Python integers."""
    m64 = (1 << 64) - 1

    def mix(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & m64
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & m64
        return x ^ (x >> 31)

    half = 1
    while 1 << 2 * half < total:
        half += 1
    mask = (1 << half) - 1
    keys = [mix((r * 0x9E3779B97F4A7C15 + key) & m64) for r in range(1, 7)]
    while True:
        a, b = i >> half, i & mask
        for k in keys:
            a, b = b, a ^ (mix((b + k) & m64) & mask)
        i = a << half | b
        if i < total:
            return i


@pytest.mark.parametrize("total", [1, 2, 5, 16, 17, 300])
def test_permutation_equals_the_slow_one(total):
    assert to.feistel(np.arange(total), total, 7).tolist() == [slow_feistel(i, total, 7) for i in range(total)]


def slow_records(spark, rows, ids, width, key):
    """Records by slot, from (id, text) rows and the ids of each text."""
    df = spark.createDataFrame([(str(i) if i is not None else None, t) for i, t in rows], "i string, t string" if all(isinstance(t, str | None) for _, t in rows) else "i string, t binary")
    hashes = [tuple(r) for r in df.selectExpr("1", "shiftrightunsigned(xxhash64(i, t), 1)", "xxhash64(i, t)", "xxhash64(t, i, 1)").collect()]
    order = sorted(range(len(rows)), key=lambda k: hashes[k][1:])
    stream = b"".join(ids[k] + b"\xff" * width for k in order)
    size = to.LENGTH * width
    records = [stream[a : a + size].ljust(size, b"\xff") for a in range(0, len(stream), size)]
    return {slow_feistel(i, len(records), key): r for i, r in enumerate(records)}


def test_shards_hold_the_stream_in_slot_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(to, "SHARD_SLOTS", 16)
    rows = [(r[0], r[1]) for r in odd_rows()]
    want = slow_records(spark, rows, [(t or "").encode() for _, t in rows], 1, 5)
    for parts, block in ((1, to.BLOCK_BYTES), (4, 5000), (7, 1)):
        monkeypatch.setattr(to, "BLOCK_BYTES", block)
        path = str(tmp_path / f"s{parts}")
        assert to.materialise(odd(spark).repartition(parts), path, key=5) == len(want)
        assert {r["slot"]: bytes(r["ids"]) for r in to.read_slots(spark, path).collect()} == want
        assert sorted(r["slot"] for r in to.read_slots(spark, path, 10, 40).collect()) == list(range(10, 40))
    files = sorted((tmp_path / "s1").glob("shard=*/part-*"), key=lambda p: int(p.parent.name[6:]))
    for k, f in enumerate(files):  # plain seeks find the records
        data = f.read_bytes()
        for j in range(len(data) // to.STRIDE):
            assert data[j * to.STRIDE : j * to.STRIDE + to.LENGTH] == want[k * 16 + j]
    assert to.round_trip(odd(spark)).count() == len(want) and to.round_trip(empty(spark)).count() == 0


def test_many_texts_and_one_in_half_of_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(to, "TEXTS_A_TASK", 50)
    monkeypatch.setattr(to, "BLOCK_BYTES", 4000)
    rows = [(i, f"text {i} " * (i % 90)) for i in range(300)] + [(7, "again and again")] * 300
    want = slow_records(spark, rows, [t.encode() for _, t in rows], 1, 20240229)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "m")
    to.materialise(df, path)
    assert {r["slot"]: bytes(r["ids"]) for r in to.read_slots(spark, path).collect()} == want


def test_shards_hold_the_ids_of_a_vocabulary(spark, tmp_path):
    if find_spec("public_tokenizers") is None:
        pytest.skip("no tokenizer files")
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = [(r[0], r[1]) for r in odd_rows()]
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for _, t in rows]
    records = slow_records(spark, rows, ids, 2, 20240229)
    sf = str(tmp_path / "sf")
    odd(spark).repartition(3).write.parquet(f"{sf}/documents.parquet")
    want = {s: (s * (2 * to.LENGTH + 1), int((np.frombuffer(x, "<u2") == 65535).sum()), hashlib.sha256(x).hexdigest()) for s, x in records.items()}
    got = queries.op10_training_order(spark, sf).collect()
    assert {r["slot"]: (r["byte_offset"], r["n_ends"], r["ids_sha256"]) for r in got} == want


@pytest.mark.parametrize("width", [1, 2, 4])
def test_ids_of_any_width_come_back(spark, tmp_path, monkeypatch, width):
    monkeypatch.setattr(to, "SHARD_SLOTS", 4 * width)
    rng = np.random.default_rng(2)
    ids = [rng.integers(0, 256**width - 1, n).astype(f"<u{width}").tobytes() for n in (0, 5000, 1, 30_000)]
    rows = [(i, x) for i, x in enumerate(ids)] + [(9, None)]
    want = slow_records(spark, rows, [*ids, b""], width, 3)
    docs = spark.createDataFrame([(i, None if x is None else bytearray(x)) for i, x in rows], "doc_id long, ids binary").repartition(2)
    path = str(tmp_path / "w")
    assert to.materialise(docs, path, key=3, text_col="ids", width=width) == len(want)
    assert {r["slot"]: bytes(r["ids"]) for r in to.read_slots(spark, path, width=width).collect()} == want
    if width > 1:
        with pytest.raises(Exception, match="is END"):
            to.materialise(spark.createDataFrame([(1, bytearray(b"\xff" * width))], "doc_id long, ids binary"), str(tmp_path / "x"), text_col="ids", width=width)


def test_copies_of_one_text_go_to_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(to, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(to, "slices", lambda batches, column, most: (b.slice(k, 10) for b in batches for k in range(0, b.num_rows, 10)))
    rows = [(1, "copy " * 20)] * 300 + [(i, words(20, i)) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    some = docs.selectExpr("xxhash64(doc_id) AS h", "xxhash64(doc_id, text) AS h2", "text").mapInArrow(to._blocks(None, 1), to._BLOCK_SQL).where("kind = 0").collect()
    each = {}
    for r in some:
        each[r["block"]] = each.get(r["block"], 0) + r["n"] * r["copies"]
    assert max(each.values()) <= 4000 + 10 * 200 and sum(r["copies"] for r in some) == len(rows)
    assert sorted((r["slot"], r["ids_sha256"]) for r in to.round_trip(docs).collect()) == sorted((r["slot"], r["ids_sha256"]) for r in to.round_trip(docs.repartition(3)).collect())
