"""Cross-tokenizer alignment: which tokens of a byte-level BPE and of a piece BPE stand for the same bytes.

A text with a space before it is encoded by A, a byte-level file of the library tokenizers, and the
text by B, a file of sentencepiece, which puts the space there itself.  Byte offsets where tokens of
both end cut the tokens into groups; every A token of a group is linked with every B token of it.
A pair of ids counts the documents that hold it linked, and is best where no other pair of its A id
counts more.

Neither tokenizer joins a space or a new line with the character before it, unless that is white
space too, or a letter with the sign that follows.  So a text is taken apart there: each distinct
part of a task is encoded and aligned once, and a document's tokens, groups and links are those of
its parts.  The vocabularies are asked at the start which of these hold; where they tell nothing, the
whole text is one part.

Links are dealt by stripes of A ids (id modulo the number of stripes, so that frequent ids spread) and
shards of the table's partitions.  A task adds the links of a stripe and a shard into a dense block of
counts, A ids by B ids; sums over shards give the corpus's counts, whose row maxima tell the best
pairs.  Links stay where they lie in a bucketed table, counts come to them, and only sums for each
document go on.

Defined results: null and empty texts, and texts that A's or B's tokens do not give back byte by byte,
have no tokens; rows without an id, or with one id, are documents like others; an empty table gives an
empty result.  Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import MOST_BUCKETS, cut_by, give_back, partitions_of, slices, tidy

#: The mark that sentencepiece has for a space.
_MARK = chr(0x2581)
#: What a space is not parted from, as a class of a pattern: white space of any kind, and the mark.
_WHITE = "\t-\r\x1c-\x20\x85\xa0" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x2060), (0x2581, 0x2581), (0x3000, 0x3000), (0xFEFF, 0xFEFF)))
_OTHER = _WHITE.replace("\x1c-\x20", "\x1c-\x1f").replace("\t-\r", "\t\x0b-\r")
#: Letters of words that are parts by themselves, and signs that may end them.
_LETTERS, _SIGNS = "A-Za-zÀ-ÖØ-öø-ÿ", ",.;:!?()\"-"
#: Characters that every library takes for the same letters and signs.
_PLAIN = re.compile(r"[\n\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# Fixed value: the pattern that splits text before the merges of byte-level vocabularies.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stands before a part for B: never in a piece with others, so that what follows is encoded as within a text.
_GUARD = "\n"

#: Parts that a task remembers, and their links.
MOST_PARTS, MOST_LINKS = 150_000, 3_000_000
#: Cells of a stripe's block of counts.
CELLS = 1 << 23
#: Links and documents of a block of documents, and partitions of the table that make a shard.
BLOCK_LINKS, BLOCK_DOCS, PARTITIONS_A_SHARD = 1_000_000, 20_000, 64

DOC, LINK = 0, 1
_HELD: dict[str, Aligner] = {}


def _byte_of_char() -> dict[str, int]:
    """Bytes of the characters that a byte-level vocabulary is written in: printable ones stand for themselves, the others for 256 and on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Grown:
    """Rows of whole numbers that grow by appending."""

    def __init__(self, columns: int):
        self.data, self.n = np.zeros((1024, columns), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros((max(len(self.data), 2 * len(rows)), self.data.shape[1]), np.int64)])
        self.data[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Aligner:
    """Encodes with both tokenizers, and remembers the parts that it has met."""

    def __init__(self, a_blob: str, b_blob: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_blob)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_blob)
        self.n_a, self.n_b = self.a.get_vocab_size(with_added_tokens=True), self.b.get_piece_size()
        self.pairs = self.n_a * self.n_b
        byte, spec = _byte_of_char(), json.loads(a_blob)
        added = {t["id"] for t in spec.get("added_tokens", [])}
        tokens = [self.a.id_to_token(i) or "" for i in range(self.n_a)]
        self.a_bytes = [t.encode() if i in added or any(c not in byte for c in t) else bytes(byte[c] for c in t) for i, t in enumerate(tokens)]
        self.ranked = self._ranked(spec)
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in some], np.int64) for some in (self.a_bytes, self.b_bytes))
        self.pattern = self._pattern(pieces) if self._splits_at_spaces(spec) else None
        self.guard = len(self.b.encode(_GUARD))
        sides = [f"{i}{mark}" for size, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks for i in range(size)]
        self.sides, self.side_size = sides, np.array([len(x) for x in sides], np.int64)
        self.forget()

    @staticmethod
    def _splits_at_spaces(spec: dict) -> bool:
        """Whether A splits words by the usual pattern of byte-level vocabularies, and changes no character."""
        split = spec.get("pre_tokenizer") or {}
        return spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")

    def _ranked(self, spec: dict):
        """A's vocabulary as ranks for tiktoken, which is several times as fast; None where ids are not bytes and then merges in their order."""
        model = spec["model"]
        vocab, merges = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        more = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if more or not self._splits_at_spaces(spec) or any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
            return None
        import tiktoken

        return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks={b: i for i, b in enumerate(self.a_bytes[: 256 + len(merges)])}, special_tokens={})

    @staticmethod
    def _pattern(pieces: list[str]) -> re.Pattern | None:
        """Of parts that neither tokenizer joins; None where B's pieces join words, or lines."""
        many = [p for p in pieces if len(p) > 1]
        if any(_GUARD in p for p in many) or any(re.search(f"[^{_WHITE}][ {_MARK}]", p) for p in many):
            return None
        signs = "".join(s for s in _SIGNS if not any(re.search(f"[{_LETTERS}]{re.escape(s)}", p) for p in many))
        word = f" ?[{_LETTERS}]+(?=[ \n{re.escape(signs)}]|\\Z)"
        rest = f"(?:[{_OTHER}][{_WHITE}]*[^{_WHITE}]*)*"
        return re.compile(f"{word}|\n(?=[^{_WHITE}])|[{_WHITE}]+[^{_WHITE}]*{rest}|[^{_WHITE}]+{rest}")

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.texts: list[str] = []
        self.numbers = _Grown(6)  # A tokens, B tokens, groups, links, whether bytes are lost, where its links end
        self.links = _Grown(2)  # pair of ids as one number, links

    def places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(parts of each text, their places in what is remembered)."""
        if len(self.texts) > MOST_PARTS or self.links.n > MOST_LINKS:
            self.forget()
        cut = self.pattern.findall if self.pattern else lambda whole: [whole]
        parts = [cut(" " + t) if t else [] for t in texts]
        flat = list(chain.from_iterable(parts))
        at = np.fromiter(map(self.at.get, flat, repeat(-1)), np.int64, len(flat))
        if len(none := np.flatnonzero(at < 0)):
            some = [flat[k] for k in none.tolist()]
            self._learn(list(dict.fromkeys(some)))
            at[none] = np.fromiter(map(self.at.__getitem__, some), np.int64, len(some))
        return np.array([len(p) for p in parts], np.int64), at

    def _encoded(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of parts by A and by B, and whether a part's bytes are lost; then it has none."""
        a_ids = [self.ranked.encode_ordinary(p) if self.ranked and _PLAIN.fullmatch(p) else None for p in parts]
        rest = iter(self.a.encode_batch_fast([p for p, x in zip(parts, a_ids, strict=True) if x is None], add_special_tokens=False))
        a_ids = [next(rest).ids if x is None else x for x in a_ids]
        if self.pattern:
            b_ids = [x[self.guard :] for x in self.b.encode([_GUARD + p for p in parts], num_threads=1)]
        else:
            b_ids = self.b.encode([p[1:] for p in parts], num_threads=1)
        whole = [p.encode() for p in parts]
        size, lost = np.array([len(w) for w in whole], np.int64), np.zeros(len(parts), bool)
        for table, ids in ((self.a_bytes, a_ids), (self.b_bytes, b_ids)):
            said = [b"".join([table[i] for i in x]) for x in ids] if len(parts) < 2 else self._said(table, ids, size, whole)
            if said is not None:
                lost |= np.array([x != w for x, w in zip(said, whole, strict=True)])
        for k in np.flatnonzero(lost).tolist():
            a_ids[k], b_ids[k] = [], []
        return a_ids, b_ids, lost

    @staticmethod
    def _said(table: list[bytes], ids: list[list[int]], size: np.ndarray, whole: list[bytes]) -> list[bytes] | None:
        """Bytes of each part's tokens; None if all are those of the parts."""
        tokens = [table[i] for i in chain.from_iterable(ids)]
        n = np.array([len(x) for x in ids], np.int64)
        ends = np.cumsum(np.array([len(t) for t in tokens], np.int64))
        of_part = np.diff(np.r_[0, ends][np.cumsum(n)], prepend=0)
        if (of_part == size).all() and b"".join(tokens) == b"".join(whole):
            return None
        return [b"".join([table[i] for i in x]) for x in ids]

    def _learn(self, parts: list[str]) -> None:
        a_ids, b_ids, lost = self._encoded(parts)
        self.at.update(zip(parts, range(len(self.texts), len(self.texts) + len(parts)), strict=True))
        na, nb = (np.array([len(x) for x in some], np.int64) for some in (a_ids, b_ids))
        a, b = (np.fromiter(chain.from_iterable(some), np.int64, int(n.sum())) for some, n in ((a_ids, na), (b_ids, nb)))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cuts = np.intersect1d(a_end, b_end)
        of_a, of_b = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_part = np.repeat(np.arange(len(parts)), na)
        last = np.searchsorted(of_a, np.arange(len(cuts)), "right") - 1  # the last A token of each group
        part_of = a_part[last]
        groups = np.bincount(part_of, minlength=len(parts))
        group, ids_a, ids_b, times = _products(of_a, a, of_b, b, len(cuts))
        part = part_of[group]
        order = np.argsort(part, kind="stable")
        n_links = np.bincount(part, times, len(parts)).astype(np.int64)
        self.texts += self._written(a, of_a, b, of_b, na + nb)
        ends = self.links.n + np.cumsum(np.bincount(part, minlength=len(parts)))
        self.numbers.add(np.stack([na, nb, groups, n_links, lost, ends], 1))
        self.links.add(np.stack([ids_a * self.n_b + ids_b, times], 1)[order])

    def _written(self, a, of_a, b, of_b, tokens: np.ndarray) -> list[str]:
        """Groups of each part as text: ids joined by commas, sides by a bar, and a semicolon after each group."""
        ends_a, ends_b = (np.diff(x, append=x[-1:] + 1) > 0 for x in (of_a, of_b))
        side = np.concatenate([a + self.n_a * ends_a, 2 * self.n_a + b + self.n_b * ends_b])
        side = side[np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")]
        whole = "".join([self.sides[i] for i in side.tolist()])
        ends = np.r_[0, np.cumsum(self.side_size[side])][np.cumsum(tokens)].tolist()
        return [whole[i:j] for i, j in zip([0, *ends], ends, strict=False)]


def _products(of_a, a, of_b, b, groups: int) -> tuple[np.ndarray, ...]:
    """(group, A id, B id, links): each group's distinct A ids by its distinct B ids, with products of their numbers."""

    def distinct(of, ids):
        width = int(ids.max(initial=0)) + 1
        keys, n = np.unique(of * width + ids, return_counts=True)
        return keys // width, keys % width, n, np.bincount(keys // width, minlength=groups)

    ga, ia, ca, na = distinct(of_a, a)
    gb, ib, cb, nb = distinct(of_b, b)
    each = nb[ga]  # B ids that each distinct A id of a group meets
    left = np.repeat(np.arange(len(ga)), each)
    first = np.cumsum(nb) - nb
    right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + first[ga[left]]
    return ga[left], ia[left], ib[right], ca[left] * cb[right]


def aligner(a_blob: str, b_blob: str) -> Aligner:
    """The worker's aligner for two files; B's is in base 64."""
    key = hashlib.sha256(f"{a_blob}\n{b_blob}".encode()).hexdigest()
    if key not in _HELD:
        _HELD[key] = Aligner(a_blob, base64.b64decode(b_blob))
    return _HELD[key]


def links_of(al: Aligner, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple[np.ndarray, ...]]:
    """Of each text A tokens, B tokens, groups and links; the digest of its groups; and (text, A id, B id, links) of all, distinct and in order."""
    sizes, flat = al.places(texts)
    doc = np.repeat(np.arange(len(texts)), sizes)
    numbers = al.numbers.data
    lost = np.bincount(doc, numbers[flat, 4], len(texts)) > 0
    said, ends = [], np.cumsum(sizes).tolist()
    for i, j, bad in zip([0, *ends], ends, lost.tolist(), strict=False):
        groups = "".join([al.texts[k] for k in flat[i:j].tolist()])[:-1]
        said.append("" if bad or i == j else hashlib.sha256(groups.encode()).hexdigest())
    keep = ~lost[doc]
    doc, flat = doc[keep], flat[keep]
    sums = np.zeros((len(texts), 4), np.int64)
    np.add.at(sums, doc, numbers[flat, :4])
    n = numbers[flat, 5] - (begin := np.where(flat > 0, numbers[flat - 1, 5], 0))
    row = np.repeat(np.arange(len(flat)), n)
    found = al.links.data[np.arange(len(row)) + (begin - np.cumsum(n) + n)[row]]
    key = doc[row] * al.pairs + found[:, 0]
    order = np.argsort(key)
    key, times = key[order], found[order, 1]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times, first) if len(first) else times
    pair = key[first] % al.pairs
    return sums, said, (key[first] // al.pairs, pair // al.n_b, pair % al.n_b, times)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of numbers of four or eight bytes, byte by byte of their width, compressed."""
    planes = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns)
    return pa.Codec("zstd", 3).compress(planes, asbytes=True)


def _unpacked(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    raw, out, at = np.frombuffer(pa.Codec("zstd").decompress(data, n * sum(widths), asbytes=True), np.uint8), [], 0
    for kind, w in zip(kinds, widths, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(kind).ravel())
        at += n * w
    return out


#: Of a blob of links: the text's place in its block, less that of the link before; cell of the stripe's block of counts; links.
_LINKS = ("<u4", "<u4", "<u4")


def stripes_of(n_a: int, n_b: int) -> int:
    """Stripes of A ids whose blocks have at most CELLS cells, or one row."""
    return -(-n_a // max(1, CELLS // n_b))


def _encode(blobs, stripes, key_type):
    key_arrow = pa.int64() if key_type == "bigint" else pa.int32() if key_type == "int" else pa.string()
    fields = pa.schema([("kind", pa.int32()), ("stripe", pa.int32()), ("shard", pa.int64()), ("block", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("data", pa.binary()), ("key", key_arrow), ("sums", pa.list_(pa.int64())), ("sha", pa.string())])

    def block_rows(block, shard, docs, links, n_b) -> Iterator[pa.RecordBatch]:
        n = len(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([DOC] * n, pa.int32()), pa.array([-1] * n, pa.int32()), pa.array([block + i for i in range(n)], pa.int64()), pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
             pa.array([d[0] for d in docs], key_arrow), pa.array([d[1] for d in docs], pa.list_(pa.int64())), pa.array([d[2] for d in docs], pa.string())],
            schema=fields,
        )
        doc, a, b, times = (np.concatenate(x) for x in zip(*links, strict=True))
        stripe = (a % stripes).astype(np.uint16 if stripes <= 1 << 16 else np.int64)
        order = np.argsort(stripe, kind="stable")
        doc, cell, times = doc[order], ((a // stripes) * n_b + b)[order], times[order]
        ends = np.cumsum(np.bincount(stripe, minlength=stripes)).tolist()
        for lo in range(0, stripes, 64):
            out = []
            for s in range(lo, min(lo + 64, stripes)):
                i, j = ends[s - 1] if s else 0, ends[s]
                if i < j:
                    step = np.diff(doc[i:j], prepend=0)
                    out.append((s, j - i, _packed(*(x.astype(k) for x, k in zip((step, cell[i:j], times[i:j]), _LINKS, strict=True)))))
            m = len(out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([LINK] * m, pa.int32()), pa.array([r[0] for r in out], pa.int32()), pa.array([shard] * m, pa.int64()), pa.array([block] * m, pa.int64()), pa.nulls(m, pa.int32()), pa.array([r[1] for r in out], pa.int32()),
                 pa.array([r[2] for r in out], pa.binary()), pa.nulls(m, key_arrow), pa.nulls(m, pa.list_(pa.int64())), pa.nulls(m, pa.string())],
                schema=fields,
            )

    def rows(batches):
        al = aligner(*blobs.value)
        part = TaskContext.get().partitionId()
        block, docs, links, size = part << 32, [], [], 0
        for batch in slices(batches, "text"):
            sums, said, (doc, a, b, times) = links_of(al, batch.column("text").to_pylist())
            links.append((doc + len(docs), a, b, times))
            docs += zip(batch.column("key").to_pylist(), sums.tolist(), said, strict=True)
            size += len(doc)
            if size >= BLOCK_LINKS or len(docs) >= BLOCK_DOCS:
                yield from block_rows(block, part // PARTITIONS_A_SHARD, docs, links, al.n_b)
                block, docs, links, size = block + 1, [], [], 0
        if docs:
            yield from block_rows(block, part // PARTITIONS_A_SHARD, docs, links, al.n_b)
        al.forget()

    return tidy(rows)


def _count(rows_of, n_b):
    """Non-zero counts of a stripe over a shard, added up in a dense block."""

    def rows(table: pa.Table) -> pa.Table:
        give_back()
        counts = np.zeros(rows_of * n_b, np.int32)
        for data, n in zip(table.column("data"), table.column("n").to_pylist(), strict=True):
            np.add.at(counts, _unpacked(data.as_py(), n, *_LINKS)[1], 1)  # a document has a pair once
        cells = np.flatnonzero(counts)
        return pa.table({"stripe": pa.array(np.full(len(cells), table.column("stripe")[0].as_py()), pa.int32()), "cell": pa.array(cells, pa.int64()), "n": pa.array(counts[cells], pa.int64())})

    return rows


def _stripe_counts(table: pa.Table) -> pa.Table:
    """A stripe's counts as one row."""
    cells, n = (table.column(c).to_numpy() for c in ("cell", "n"))
    return pa.table({"stripe": table.column("stripe")[:1], "cells": pa.array([len(cells)], pa.int64()), "counts": pa.array([_packed(cells.astype("<u4"), n.astype("<i8"))], pa.binary())})


def _score(rows_of, n_b):
    """Of each block of documents, the links of a stripe that are best, and sums of their counts."""

    def rows(links: pa.Table, counts: pa.Table) -> pa.Table:
        give_back()
        dense = np.zeros((rows_of, n_b), np.int64)
        for data, n in zip(counts.column("counts"), counts.column("cells").to_pylist(), strict=True):
            cells, number = _unpacked(data.as_py(), n, "<u4", "<i8")
            dense.ravel()[cells] = number
        best, flat = dense.max(1), dense.ravel()
        blocks, sizes, out = [], [], []
        for block, data, n in zip(links.column("block").to_pylist(), links.column("data"), links.column("n").to_pylist(), strict=True):
            step, cell, times = _unpacked(data.as_py(), n, *_LINKS)
            doc, times, count = np.cumsum(step.astype(np.int64)), times.astype(np.int64), flat[cell]
            first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            top = np.add.reduceat(times * (count == best[cell // n_b]), first)
            blocks.append(block)
            sizes.append(len(first))
            out.append(_packed(doc[first].astype("<u4"), top.astype("<i8"), np.add.reduceat(times * count, first).astype("<i8")))
        return pa.table({"block": pa.array(blocks, pa.int64()), "n": pa.array(sizes, pa.int32()), "data": pa.array(out, pa.binary())})

    return rows


def _finish(docs: pa.Table, scores: pa.Table) -> pa.Table:
    """Documents of a block with the sums over all stripes."""
    n = docs.num_rows
    both = np.zeros((n, 2), np.int64)
    for data, m in zip(scores.column("data"), scores.column("n").to_pylist(), strict=True):
        at, top, total = _unpacked(data.as_py(), m, "<u4", "<i8", "<i8")
        both[at, 0] += top
        both[at, 1] += total
    own = both[docs.column("at").to_numpy()]
    sums = np.array(docs.column("sums").to_pylist(), np.int64).reshape(n, 4)
    columns = [*(pa.array(sums[:, k]) for k in range(4)), *(pa.array(own[:, k]) for k in range(2))]
    return pa.table([docs.column("key"), *columns, docs.column("sha")], ["key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def _read(a_path: str, b_path: str) -> tuple[str, str]:
    return Path(a_path).read_text(), base64.b64encode(Path(b_path).read_bytes()).decode()


class Alignment:
    """Links of a table's documents, in a table of the shared folder; drop() deletes it.

    counts() tells what the corpus says of pairs of ids, scores() what it says of each document.
    """

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"):
        spark = docs.sparkSession
        files = _read(a_path, b_path)
        own = Aligner(files[0], base64.b64decode(files[1]))
        self.n_b, self.stripes = own.n_b, stripes_of(own.n_a, own.n_b)
        self.rows_of = -(-own.n_a // self.stripes)
        del own
        give_back()
        self.id_col, self.id_type = id_col, docs.schema[id_col].dataType
        kind = self.id_type.simpleString() if isinstance(self.id_type, T.LongType | T.IntegerType) else "string"
        rows = docs.select(F.col(id_col).cast(kind).alias("key"), F.col(text_col).alias("text"))
        schema = f"kind int, stripe int, shard long, block long, at int, n int, data binary, key {kind}, sums array<long>, sha string"
        made = rows.mapInArrow(_encode(spark.sparkContext.broadcast(files), self.stripes, kind), schema)
        buckets = min(MOST_BUCKETS, max(8, (partitions_of(rows) // PARTITIONS_A_SHARD + 1) * self.stripes // 4))
        self.table, self.drop = cut_by(made.repartition(buckets, "stripe", "shard"), "alignment-links", ("stripe", "shard"), buckets)
        self.links = self.table.where(F.col("kind") == LINK).select("stripe", "shard", "block", "n", "data")

    def _cells(self) -> DataFrame:
        some = self.links.groupBy("stripe", "shard").applyInArrow(_count(self.rows_of, self.n_b), "stripe int, cell long, n long")
        return some.groupBy("stripe", "cell").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        """(a_id, b_id, n_docs, best): documents that hold a pair linked, and whether no pair of its A id has more."""
        cells = self._cells().select((F.floor(F.col("cell") / self.n_b) * self.stripes + F.col("stripe")).alias("a_id"), (F.col("cell") % self.n_b).alias("b_id"), F.col("n").alias("n_docs"))
        most = cells.groupBy("a_id").agg(F.max("n_docs").alias("__most"))
        return cells.join(most, "a_id").withColumn("best", F.col("n_docs") == F.col("__most")).drop("__most")

    def scores(self) -> DataFrame:
        """A row for each document: tokens, groups, links, links that are best, counts over links, digest of the groups."""
        packed = self._cells().groupBy("stripe").applyInArrow(_stripe_counts, "stripe int, cells long, counts binary")
        told = self.links.select("stripe", "shard").distinct().join(packed, "stripe").select(F.col("stripe").alias("of_stripe"), F.col("shard").alias("of_shard"), "cells", "counts")
        scored = self.links.groupBy("stripe", "shard").cogroup(told.groupBy("of_stripe", "of_shard")).applyInArrow(_score(self.rows_of, self.n_b), "block long, n int, data binary")
        docs = self.table.where(F.col("kind") == DOC).select("block", "at", "key", "sums", "sha")
        kind = docs.schema["key"].dataType.simpleString()
        out = docs.groupBy("block").cogroup(scored.groupBy("block")).applyInArrow(_finish, f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
        return out.withColumn("key", F.col("key").cast(self.id_type)).withColumnRenamed("key", self.id_col)


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every document; the links' table stays, as the result reads it."""
    return Alignment(docs, a_path, b_path, id_col, text_col).scores()
