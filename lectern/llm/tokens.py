"""Encoding with the files of public tokenizers: whole texts, and parts that are joined later.

A tokenizer of words drops white space and splits at it before it merges, so a text's ids are
those of its words one after the other.  Its words are told apart in Arrow; each distinct word of
a batch is looked up once, and those not remembered are encoded together, with a mark between
them.  Every other tokenizer encodes each text by itself.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Sequence
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pre-tokenizer and normalizers of tokenizers that drop white space, and split at it.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ("NFC", "Lowercase", "Replace")

#: Letters that every normalizer above keeps or puts in lower case, and never joins with others.
_PLAIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: What the letters beyond ASCII become byte by byte: printable bytes stay, the others get characters from U+0100 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_BYTES = {c: "".join(_BYTE[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
#: Signs that are a piece of their own beside letters; the apostrophe may begin a piece with letters.
SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~<>|"
#: Runs of letters or signs that are remembered in each of two generations, and the longest of them.
RUNS, LONGEST = 200_000, 100
#: Segments that a part keeps at either end, and segments on each side of a join that are encoded first.
EDGE, FIRST_TRY = 4, 2
_SYNC = re.compile(r"[\S\x1c-\x1f](?=[^\S\x1c-\x1f])")  # \x1c to \x1f are white space to Python, but not to tokenizers
#: Characters of an end of a part that are searched for its segments first.
_NEAR = 256
_HELD: dict[str, Encoder] = {}


class Part(NamedTuple):
    """A run of a text with its ids; head_n and tail_n: ids of each of the first and last EDGE segments.

    A part with too few segments has neither ids nor these numbers.
    """

    text: str
    ids: bytes
    head_n: list[int]
    tail_n: list[int]


class _Memo:
    """Ids of words, in two generations: words not seen for a whole generation are forgotten."""

    def __init__(self, make):
        self.make = make
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        young, old = self.young, self.old
        out = [young.get(w) for w in words]
        missing = [i for i, x in enumerate(out) if x is None]
        if not missing:
            return out
        if len(young) + len(missing) > RUNS:
            self.old, self.young = young, {}
            young, old = self.young, young
        new = []
        for i in missing:
            if (x := old.get(words[i])) is None:
                new.append(i)
            else:
                out[i] = young[words[i]] = x
        for i, x in zip(new, self.make([words[i] for i in new]), strict=True):
            out[i] = x
            if len(words[i]) <= LONGEST:
                young[words[i]] = x
        return out


def _drops_white_space(spec: dict) -> bool:
    """Whether the file is one of those whose pieces never touch white space and have no decoder."""
    normal = spec.get("normalizer") or {}
    steps = normal.get("normalizers", [normal] if normal else [])
    if any(s["type"] not in WORD_NORMALIZERS or s["type"] == "Replace" and (s["pattern"], s["content"]) != ({"Regex": r"\s+"}, " ") for s in steps):
        return False
    split, *more = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    alone = split.get("type") == "Split" and split.get("pattern") == {"Regex": WORD_PATTERN} and split.get("behavior") == "Removed" and split.get("invert")
    level = all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in more)
    added = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in spec.get("added_tokens", []))
    return bool(alone and level and added and spec.get("decoder") is None and spec.get("post_processor") is None)


class Encoder:
    """Encodes and decodes as the tokenizer's file says, without special tokens, truncation or padding."""

    def __init__(self, blob: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(blob)
        self.tokenizer = Tokenizer.from_str(blob)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.typecode = "H" if self.size <= 1 << 16 else "I"
        self.width = array(self.typecode).itemsize
        self.decimal = np.array([f"{i} ".encode() for i in range(self.size)])
        self.tokens = None if spec.get("decoder") else [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.by_words = _drops_white_space(spec)
        if self.by_words:
            added = [t["content"] for t in spec.get("added_tokens", [])]
            self._signs = "" if any(t.isalpha() for t in added) else "".join(c for c in SIGNS if not any(c in t for t in added))
            self._model = self.tokenizer.model
            self._model._resize_cache(0)  # RUNS takes its place
            self._runs = _Memo(self._new_runs)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _pack(self, ids: Sequence[int]) -> bytes:
        return array(self.typecode, ids).tobytes()

    def _new_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of plain letters or of signs: each run is one piece, which the model encodes as it stands."""
        tokenize = self._model.tokenize
        return [array(self.typecode, [t.id for t in tokenize(r if r.isascii() else r.translate(_BYTES))]).tobytes() for r in runs]

    def _words(self, words: pa.StringArray) -> list[bytes]:
        """Ids of distinct words: plain letters between signs are three runs at most, other words are encoded whole."""
        left = pc.utf8_ltrim(words, self._signs)
        core = pc.utf8_rtrim(left, self._signs)
        size, of_left, of_core = (pc.binary_length(x).to_numpy() for x in (words, left, core))  # signs have one byte each
        texts, before, after = _list(words), (size - of_left).tolist(), (of_left - of_core).tolist()
        heads = [w[:n] if n else "" for w, n in zip(texts, before, strict=True)]
        tails = [w[len(w) - n :] if n else "" for w, n in zip(texts, after, strict=True)]
        lower = pc.utf8_lower(core)
        same = pc.binary_length(lower).to_numpy() == of_core  # other letters that become plain ones are longer before
        lower = lower.dictionary_encode()
        plain = pc.match_substring_regex(lower.dictionary, f"^[{_PLAIN}]*$") if self._signs else pa.array([False] * len(lower.dictionary))
        runs, signs = _list(lower.dictionary.filter(plain)), list({*heads, *tails})
        ids = dict(zip([*runs, *signs], [*self._runs.of(runs), *self._runs.of(signs)], strict=True))
        of = [ids[x] if p else None for x, p in zip(_list(lower.dictionary), _list(plain), strict=True)]
        cores = [of[i] if k else None for i, k in zip(_list(lower.indices), same.tolist(), strict=True)]
        rest = iter(self.tokenizer.encode_batch_fast([w for w, x in zip(texts, cores, strict=True) if x is None], add_special_tokens=False))
        return [ids[a] + x + ids[b] if x is not None else self._pack(next(rest).ids) for a, x, b in zip(heads, cores, tails, strict=True)]

    def forget(self) -> None:
        """Give back what is remembered; for the end of a task."""
        if self.by_words:
            self._runs = _Memo(self._new_runs)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text (UTF-8), two or four bytes an id."""
        if not texts:
            return []
        if not self.by_words:
            return [self._pack(e.ids) for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = words.flatten().dictionary_encode()
        ids = self._words(coded.dictionary)
        each = np.empty(len(ids), object)
        each[:] = ids
        each, ends = each[coded.indices.to_numpy()].tolist(), words.offsets.to_numpy()
        return [b"".join(each[a:b]) for a, b in pairwise((ends - ends[0]).tolist())]

    def parts(self, texts: list[bytes]) -> list[Part]:
        """The parts that runs of texts become."""
        whole = [t.decode() for t in texts]
        edges = [_edges(t) for t in whole]
        if not self.by_words:
            return [self._part(t, e) for t, e in zip(whole, edges, strict=True)]
        pieces = [_pieces(t, e) for t, e in zip(whole, edges, strict=True)]  # ids of a segment are those of its words
        flat = iter(self.encode([p.encode() for some in pieces for p in some]))
        out = []
        for t, some in zip(whole, pieces, strict=True):
            ids = [next(flat) for _ in some]
            n = [len(x) // self.width for x in ids]
            out.append(Part(t, b"".join(ids), n[:EDGE], n[EDGE + 1 :]))
        return out

    def _part(self, text: str, edges) -> Part:
        if edges is None:
            return Part(text, b"", [], [])
        e = self.tokenizer.encode(text, add_special_tokens=False)
        starts = np.array([a if b > a else -1 for a, b in e.offsets], np.int64)
        starts = np.maximum.accumulate(starts) if len(starts) else starts  # an id without characters of its own goes with those before
        at = np.searchsorted(starts, [*edges[0], *edges[1]]).tolist()
        n = np.diff([0, *at, len(starts)]).tolist()
        return Part(text, self._pack(e.ids), n[:EDGE], n[EDGE + 1 :])

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids and of the decoded text."""
        numbers = np.frombuffer(ids, self.typecode)
        decimal = self.decimal[numbers].tobytes().replace(b"\0", b"")[:-1]
        if self.tokens is None:
            text = self.tokenizer.decode(numbers.tolist(), skip_special_tokens=False)
        else:
            text = " ".join([self.tokens[i] for i in numbers.tolist()])
        return len(numbers), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def _list(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _edges(text: str) -> tuple[list[int], list[int]] | None:
    """Ends of the first EDGE segments and starts of the last; None where there are fewer than twice EDGE and one.

    A segment ends where a character is followed by white space.
    """
    first = [m.end() for _, m in zip(range(EDGE), _SYNC.finditer(text), strict=False)]
    start = max(0, len(text) - _NEAR)
    last = [m.end() + start for m in _SYNC.finditer(text[start:])]
    if len(last) < EDGE:
        last = [m.end() for m in _SYNC.finditer(text)]
    last = last[-EDGE:]
    return (first, last) if len(first) == len(last) == EDGE and first[-1] < last[0] else None


def _pieces(text: str, edges) -> list[str]:
    """The first EDGE segments, what lies between, and the last EDGE segments."""
    if edges is None:
        return []
    at = [0, *edges[0], *edges[1], len(text)]
    return [text[a:b] for a, b in zip(at, at[1:], strict=False)]


def join_parts(enc: Encoder, parts: list[Part]) -> bytes:
    """Ids of the text that the parts make.

    Around each join some segments are put together, with parts of few segments between, and
    encoded anew.  The result must begin and end with the ids that the outermost of these segments
    have in their own parts; if not, one more segment is taken on each side, and where EDGE
    segments do not settle it, the whole text is encoded.
    """
    out, left, before, between = [], None, [], ""
    for right in [*parts, None]:
        if right is not None and not right.head_n:
            between += right.text
            continue
        after = _pieces(right.text, _edges(right.text)) if right else []
        if (left is None or right is None) and not between:  # nothing stands before the first part or after the last
            left, before = right or left, after or before
            continue
        for k in range(FIRST_TRY, EDGE + 1):
            ids = enc.encode(["".join([*before[len(before) - k :], between, *after[:k]]).encode()])[0]
            kept, first = _split(left.ids, sum(left.tail_n[:-k]) - sum(left.tail_n), left.tail_n[-k], enc.width) if left else (b"", b"")
            last, rest = _split_head(right.ids, sum(right.head_n[:k]), right.head_n[k - 1], enc.width) if right else (b"", b"")
            if ids.startswith(first) and ids.endswith(last) and len(ids) >= len(first) + len(last):
                break
        else:
            return enc.encode(["".join(p.text for p in parts).encode()])[0]
        out += [kept, ids]
        left, before, between = right._replace(ids=rest) if right else None, after, ""
    return b"".join([*out, left.ids if left else b""])


def _split(ids: bytes, at: int, n: int, width: int) -> tuple[bytes, bytes]:
    """(ids before the last -at, the n that follow)."""
    at = len(ids) + at * width
    return ids[:at], ids[at : at + n * width]


def _split_head(ids: bytes, at: int, n: int, width: int) -> tuple[bytes, bytes]:
    """(the n ids before the at-th, ids from there)."""
    return ids[(at - n) * width : at * width], ids[at * width :]


def encoder(blob: str) -> Encoder:
    """The worker's encoder for a tokenizer file's text."""
    key = hashlib.sha256(blob.encode()).hexdigest()
    if key not in _HELD:
        _HELD[key] = Encoder(blob)
    return _HELD[key]
