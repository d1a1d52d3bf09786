import bisect
import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import alignment as al
from lectern.llm.queries import ALIGNED, tokenizer_path
from tests_llm_cases import LONG, empty, odd, odd_rows, words

pytest.importorskip("public_tokenizers")


class Slow:
    """Whole texts by the libraries themselves, bytes and groups one by one."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(ALIGNED[0]))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(ALIGNED[1]))
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def bytes_a(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def links(self, text):
        """((A tokens, B tokens, groups, links), digest, links by pair)."""
        none = (0, 0, 0, 0), "", Counter()
        if not text:
            return none
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sides = [list(map(f, x)) for f, x in ((self.bytes_a, a), (self.bytes_b, b))]
        if any(b"".join(s) != (" " + text).encode() for s in sides):
            return none
        ends = [[sum(map(len, s[: k + 1])) for k in range(len(s))] if len(s) < 200 else self._sums(s) for s in sides]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([], []) for _ in cuts]
        for side, (ids, at) in enumerate(((a, ends[0]), (b, ends[1]))):
            for i, e in zip(ids, at, strict=True):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        found = Counter((i, j) for x, y in groups for i in x for j in y)
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        return (len(a), len(b), len(cuts), sum(found.values())), hashlib.sha256(said.encode()).hexdigest(), found

    @staticmethod
    def _sums(some):
        out, at = [], 0
        for x in some:
            at += len(x)
            out.append(at)
        return out

    def scores(self, rows):
        each = [self.links(t) for _, t in rows]
        count = Counter(p for *_, found in each for p in found)
        best = defaultdict(int)
        for (i, _), n in count.items():
            best[i] = max(best[i], n)
        out = [(key, *sums, sum(n for p, n in found.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in found.items()), said) for (key, _), (sums, said, found) in zip(rows, each, strict=True)]
        return sorted(out, key=str), count, best


@pytest.fixture(scope="module")
def slow():
    return Slow()


@pytest.fixture(scope="module")
def fast():
    return al.Aligner(Path(tokenizer_path(ALIGNED[0])).read_text(), Path(tokenizer_path(ALIGNED[1])).read_bytes())


PATHS = [tokenizer_path(n) for n in ALIGNED]
ODD = [None, "", " ", "  ", "a ", "a\n", "\n", "\n\n", " a", "  a  b \n\n c", "\ta\t\tb", "a▁b", "a\x00b", "ﬁ \xe9 é", "　x　 y", "<s> </s> <|endoftext|> <0x0A>", "\U0001f642\U0001f642 ​ x", "\r\n", "foo();\r\n bar ;\r x", "x" * 5000, "日本語" * 50, "\x85 a\xa0 b  c", "it's (Don't) \"so-so\", e.g. a.b", "12 345,6-7"]


def scored(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents_equal_whole_texts(spark, slow, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_LINKS", 3000)
    monkeypatch.setattr(al, "PARTITIONS_A_SHARD", 2)
    rng = random.Random(3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, words(rng.randint(1, 200), i).title().replace("a", "\xe9\n", i % 3)) for i in range(80)] + [(None, "no id"), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    links = al.Alignment(df, *PATHS)
    want, count, best = slow.scores(rows)
    assert scored(links.scores()) == want
    assert sorted(tuple(r) for r in links.counts().collect()) == sorted((i, j, n, n == best[i]) for (i, j), n in count.items())
    links.drop()


def test_odd_rows_other_ids_and_empty_tables(spark, slow):
    assert scored(al.align(odd(spark), *PATHS)) == slow.scores([r[:2] for r in odd_rows()])[0]
    assert al.align(empty(spark), *PATHS).count() == 0
    named = spark.createDataFrame([("x", "one two"), (None, "one")], "name string, body string")
    assert scored(al.align(named, *PATHS, id_col="name", text_col="body")) == slow.scores([("x", "one two"), (None, "one")])[0]


def test_what_is_remembered_is_bounded(slow, fast, monkeypatch):
    monkeypatch.setattr(al, "MOST_PARTS", 50)
    texts = [words(40, i) for i in range(12)] + [LONG[:30_000]] + [words(40, i) for i in range(12)]
    for k in range(0, len(texts), 3):
        sums, said, _ = al.links_of(fast, texts[k : k + 3])
        assert [(tuple(s), x) for s, x in zip(sums.tolist(), said, strict=True)] == [slow.links(t)[:2] for t in texts[k : k + 3]]


piece = st.sampled_from(["a", "word", " ", "\n", "\t", "\r", "\xa0", "　", "▁", ",", ".", "'s", "'", "\"", "-", "(", "1", "23", "\xe9", "\xdc", "ł", "日", "\U0001f642", "\x1c", "\x00", "﻿", "Wor"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(piece, max_size=12).map("".join), min_size=1, max_size=6))
def test_parts_equal_whole_texts(slow, fast, texts):
    sums, said, (doc, a, b, n) = al.links_of(fast, texts)
    found = [Counter() for _ in texts]
    for d, i, j, k in zip(doc.tolist(), a.tolist(), b.tolist(), n.tolist(), strict=True):
        found[d][i, j] = k
    assert [(tuple(s), x, f) for s, x, f in zip(sums.tolist(), said, found, strict=True)] == [slow.links(t) for t in texts]


def test_without_parts_and_without_ranks(slow, fast, monkeypatch):
    texts = [t for t in ODD if t] + [words(60, i) for i in range(5)]
    monkeypatch.setattr(fast, "pattern", None)
    monkeypatch.setattr(fast, "ranked", None)
    fast.forget()
    sums, said, _ = al.links_of(fast, texts)
    fast.forget()
    assert [(tuple(s), x) for s, x in zip(sums.tolist(), said, strict=True)] == [slow.links(t)[:2] for t in texts]
