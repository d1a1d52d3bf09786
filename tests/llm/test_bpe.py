import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import bpe, tokens
from tests_llm_cases import LONG, empty, odd, odd_rows, words

P = pytest.importorskip("public_tokenizers")
WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
FILES = (WORD, BYTE)


@pytest.fixture(scope="module")
def toks():
    from tokenizers import Tokenizer

    return {f: Tokenizer.from_file(f) for f in FILES}


@pytest.fixture(scope="module")
def encs():
    return {f: tokens.Encoder(open(f).read()) for f in FILES}


def want(tok, text):
    ids = tok.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("file", FILES)
def test_odd_rows(spark, toks, file):
    got = sorted((tuple(r) for r in bpe.encode(odd(spark), file).collect()), key=str)
    assert got == sorted(((r[0], *want(toks[file], r[1])) for r in odd_rows()), key=str)
    assert bpe.encode(empty(spark), file).count() == 0


@pytest.mark.parametrize("file", FILES)
def test_shared_chunks(spark, toks, file):
    part, solid = words(900, 5), "abcé" * 4000
    rows = [(i, f"{words(40 + i, i)}{part}{words(60, i + 30)}") for i in range(12)] + [(20, part + solid), (21, solid + part), (22, solid), (23, LONG[:9000]), (24, LONG[4000:12000]), (25, "<|endoftext|>" + part), (26, part + " \n\n  \n " + part), (27, " " * 3000 + part + " " * 3000 + "x" + part)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in bpe.encode(df, file).collect()) == sorted((i, *want(toks[file], t)) for i, t in rows)


def test_one_chunk_in_half_of_the_rows(spark, toks):
    part = words(700, 6)
    rows = [(i, part if i % 2 else words(30, i) + part[:2000] + words(30, i + 500)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(r) for r in bpe.encode(df, WORD).collect()) == sorted((i, *want(toks[WORD], t)) for i, t in rows)


def test_chunks_follow_content():
    part = words(3000, 6).encode()
    a, b = bpe.chunks(b"x" * 500 + part), bpe.chunks(words(300, 7).encode() + part)
    assert b"".join(a).endswith(part) and len(set(a) & set(b)) > len(bpe.chunks(part)) // 2
    assert bpe.chunks(b"") == [] and b"".join(bpe.chunks("é".encode() * 3000)).decode()


PIECES = st.one_of(st.sampled_from(["don't ", "it's", " 'tis", "Ünd ", "<|endoftext|>", "a.b,c ", "x_y ", "12 3", "  ", "\n\n", "ﬁ ", "́", "İ ", "É É ", "中文 字"]), st.text(st.sampled_from("aB é'\n　\x1f́İΣ7!<|._\x85\xa0"), max_size=12))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=20).map("".join), max_size=6))
def test_joined_parts_equal_the_whole(toks, encs, cuts):
    text = "".join(cuts)
    for f in FILES:
        parts = encs[f].parts([c.encode() for c in cuts if c])
        assert encs[f].digests(tokens.join_parts(encs[f], parts)) == want(toks[f], text) == encs[f].digests(encs[f].encode([text.encode()])[0])


class Lying(tokens.Encoder):
    """Its parts do not have the ids that the text has there."""

    def parts(self, texts):
        return [p._replace(ids=bytes(len(p.ids))) for p in super().parts(texts)]


def test_where_ends_never_agree_the_whole_text_is_encoded(toks):
    enc = Lying(open(WORD).read())
    a, b = words(30, 1), words(40, 2)
    assert enc.digests(tokens.join_parts(enc, enc.parts([a.encode(), b.encode()]))) == want(toks[WORD], a + b)


def test_words_of_every_kind(toks, encs):
    assert encs[WORD].by_words and not encs[BYTE].by_words
    text = " ".join(w + s for w in ("Ab", "ÀÉß", "don't", "x1", "ªº", "ÿ×", "é") for s in ("", ",", "...", "'s", "<|", "<|endoftext|>", "_", "​", " b", "🙂"))
    for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0   　​᠎﻿\x00":
        text += f" ab{c}cd{c}{c}é"
    assert encs[WORD].digests(encs[WORD].encode([text.encode()])[0]) == want(toks[WORD], text)


def test_memory_of_words_is_bounded(toks, monkeypatch):
    monkeypatch.setattr(tokens, "RUNS", 20)
    enc = tokens.Encoder(open(WORD).read())
    for i in range(30):
        text = words(30, i) + ", " + words(5, 3) + " " + "q" * 300
        assert enc.digests(enc.encode([text.encode()])[0]) == want(toks[WORD], text)
        assert len(enc._runs.young) <= 60 and all(len(w) <= 100 for w in enc._runs.young)
    enc.forget()
    assert not enc._runs.young
