"""Column functions against Python, and segmentation, mining and generation cases."""

import fnmatch

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import text as fx
from lectern.operators import dictionary, generate, mining, search, segments, summary


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t")).alias("r")).first()["r"]


@settings(max_examples=30, deadline=None)
@given(st.text("a\n\r\x0b\x1c\x85 　 b", max_size=12))
def test_lines_and_strip_equal_python(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(fx.lines(F.col("t")).alias("l"), fx.strip("t").alias("s")).first()
    assert row["l"] == text.splitlines() and row["s"] == text.strip()


@pytest.mark.parametrize("glob", ["*", "a*.txt", "?/b", "[ab]/*", "[!a]*", "x[", "a.b", "*/c/*"])
def test_globs_equal_fnmatch(spark, glob):
    names = ["a", "a/b", "ab.txt", "a/c/d.txt", "b/b", "x[", "a.b", "aXb", "b"]
    rows = spark.createDataFrame([(n,) for n in names], "t string").select("t", F.col("t").rlike(fx.glob_pattern(glob)).alias("m")).collect()
    assert {r["t"]: r["m"] for r in rows} == {n: fnmatch.fnmatchcase(n, glob) for n in names}


@settings(max_examples=20, deadline=None)
@given(st.text("abx", max_size=10), st.text("abx", max_size=10))
def test_changed_chars(spark, a, b):
    want = sum(x != y for x, y in zip(a, b, strict=False)) + abs(len(a) - len(b))
    assert spark.createDataFrame([(a, b)], "a string, b string").select(fx.changed_chars(F.col("a"), F.col("b")).alias("n")).first()["n"] == want


def test_final_consonants_and_times(spark):
    assert [one(spark, s, fx.final_consonant) for s in ("금", "수", "물", "a", "")] == [16, 0, 8, 0, 0]
    assert [one(spark, x, fx.srt_time, "double") for x in (0.0, 3661.25, 2.0005)] == ["00:00:00,000", "01:01:01,250", f"00:00:02,{round(2.0005 * 1000) % 1000:03d}"]


def test_bad_markers_fail(spark):
    lines = spark.createDataFrame([("a", 0, "@@ override: 같은 => 같은")], "path string, line_no int, text string")
    with pytest.raises(Exception, match="invalid override marker"):
        dictionary.parse_markers(lines).collect()
    assert dictionary.without_markers(lines).count() == 0


def _pack(text, most):
    """A slow statement of greedy packing."""
    import re

    paragraphs = [p.strip() for p in text.split("\n\n") if p.strip()]
    if not paragraphs:
        return [text] if text else []
    pieces = []
    for p in paragraphs:
        if len(p) <= most:
            pieces.append((p, 2))
        else:
            for s in filter(None, (x.strip() for x in re.split(r"(?<=[.!?])\s+", p))):
                pieces += [(s[i : i + most], 1) for i in range(0, len(s), most)]
    out, held, size = [], [], 0
    for s, gap in pieces:
        if size + len(s) + gap <= most:
            held.append(s)
            size += len(s) + gap
        else:
            if held:
                out.append("\n\n".join(held))
            held, size = [s], len(s)
    return [c.strip() for c in [*out, "\n\n".join(held)] if c.strip()]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["가나다. ", "a", "bb! ", "\n\n", "긴글긴글긴글", " "]), max_size=25).map("".join), st.integers(3, 12))
def test_chunks(spark, text, most):
    assert one(spark, text, lambda c: segments.chunks(c, most)) == _pack(text, most)


def test_alignment_exhausts_after_a_mismatch(spark):
    script = spark.createDataFrame([("p", 1, "가"), ("p", 2, "다른"), ("p", 3, "나")], "path string, line_no int, text string")
    timed = spark.createDataFrame([("p", 1, "0:01", "가"), ("p", 2, "0:02", "나")], "path string, line_no int, timestamp string, text string")
    assert {r["line_no"]: r["timestamp"] for r in search.align(script, timed).collect()} == {1: "0:01", 2: "", 3: ""}


def test_a_repeated_pattern_is_one_hit(spark):
    lines = spark.createDataFrame([("p", 1, "aXaX"), ("p", 2, None)], "path string, line_no int, text string")
    hits = search.literal_hits(lines, spark.createDataFrame([(0, "X"), (1, "")], "ord int, pattern string"))
    assert hits.count() == 1


def test_many_patterns_give_the_same_hits(spark, monkeypatch):
    lines = spark.createDataFrame([("p", i, f"ab{i}c{i * 7 % 13} aab") for i in range(60)] + [("q", 1, None), ("q", 2, "")], "path string, line_no int, text string")
    patterns = spark.createDataFrame([(i, x) for i, x in enumerate(["a", "ab", "aab", "b1", "c", "3 a", "zz", ""])], "ord int, pattern string")
    want = sorted(tuple(r) for r in search.literal_hits(lines, patterns).collect())
    monkeypatch.setattr(search, "FEW_PATTERNS", 2)
    assert sorted(tuple(r) for r in search.literal_hits(lines, patterns).collect()) == want
    monkeypatch.setattr(search, "MOST_PATTERNS", 3)
    assert sorted(tuple(r) for r in search.literal_hits(lines, patterns).collect()) == want and want


def test_many_terms_are_found_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "abcab"), (2, None), (3, "")], "path long, text string")
    few = [tuple(r) for r in search.with_terms(docs, ["ca", "zz", "ab", "ab", ""]).orderBy("path").collect()]
    assert few[0][2] == ["ca", "ab"]
    monkeypatch.setattr(search, "FEW_PATTERNS", 1)
    many = [tuple(r) for r in search.with_terms(docs, ["ca", "zz", "ab", "ab", ""]).orderBy("path").collect()]
    assert [m[2] for m in many] == [["ca", "ab"], [], []]


def test_patterns_longest_first(spark):
    pairs = spark.createDataFrame([(0, "ab", "x"), (1, "cd", "y"), (2, "ab", "z")], "seq long, wrong string, right string")
    manual = spark.createDataFrame([(0, "abcd", "w")], "seq long, wrong string, right string")
    assert [r["pattern"] for r in search.literal_patterns(pairs, manual).orderBy("ord").collect()] == ["abcd", "ab", "cd"]


def test_replacements_by_digits_similarity_and_one_character(spark):
    lines = spark.createDataFrame([("p", 1, "3합이 3합이 가나다라마파가 가나다라마파가 비겹별")], "path string, line_no int, text string")
    terms = spark.createDataFrame([(0, "삼합"), (1, "가나다라마바"), (2, "비겁")], "seq long, term string")
    none = spark.createDataFrame([], "seq long, wrong string, right string")
    got = {r["wrong"]: (r["right"], r["reason"]) for r in mining.suggest_replacements(mining.token_counts(lines), terms, none).collect()}
    assert got == {"3합이": ("삼합이", "digit->korean"), "비겹별": ("비겁별", "single-char-diff+별")}
    got = mining.suggest_replacements(mining.token_counts(spark.createDataFrame([("p", 1, "가나다라마바사가")], "path string, line_no int, text string")), terms, none).collect()
    assert [(r["wrong"], r["right"], r["reason"]) for r in got] == [("가나다라마바사가", "가나다라마바가", "similarity:0.92")]


def test_terms_relate_by_their_ends(spark):
    stems = spark.createDataFrame([("사주팔자",), ("팔자",), ("주팔",), ("관",)], "token string")
    terms = spark.createDataFrame([(0, "사주"), (1, "큰팔자"), (2, "큰 말")], "seq long, term string")
    assert sorted(r["token"] for r in mining.related_to_terms(stems, terms).collect()) == ["사주팔자", "팔자"]


class Breaks:
    def __init__(self, at, error):
        self.at, self.error, self.n = at, error, 0

    def call(self, system, user, most_tokens=None):
        if self.at in user:
            raise RuntimeError(self.error)
        return "note " + user[-3:]


def test_map_reduce_states(spark):
    docs = spark.createDataFrame([("ok", ["abc", "def"], []), ("quota", ["QQQ"], []), ("bad", ["BBB"], [])], "path string, chunks array<string>, glossary array<string>")
    by = lambda client: {r["path"]: r["status"] for r in generate.map_reduce(docs, client, sleep=lambda s: None).collect()}
    assert by(Breaks("QQQ", "HTTP 429")) == {"ok": "done", "quota": "partial", "bad": "done"}
    assert by(Breaks("BBB", "boom"))["bad"] == "failed"
    assert {r["status"] for r in generate.map_reduce(docs, generate.EchoClient(), complete=lambda t: False).collect()} == {"failed"}
    merged = generate.map_reduce(docs, generate.EchoClient(), merge_limit=10).where("path = 'ok'").first()
    assert merged["status"] == "done"


def test_retries():
    seen = []

    def call():
        seen.append(1)
        if len(seen) < 3:
            raise OSError
        return "x"

    assert generate.with_retries(call, sleep=lambda s: None) == "x" and len(seen) == 3
    assert generate.token_boost(5000, 0) == 8192 and generate.token_boost(1000, 1) == 4000


def test_headers(spark):
    rows = spark.createDataFrame([("a/강의.script.txt", "본문 \n"), ("b.txt", "# 제목")], "path string, text string")
    got = [r[0] for r in rows.select(generate.with_header(F.col("text"), F.col("path"), "summary")).collect()]
    assert got == ["# 강의 AI Summary\n\n본문\n", "# 제목\n"]


class Flaky:
    """Fails twice for each request, then answers."""

    def __init__(self):
        self.seen = {}

    def call(self, system, user, most_tokens=None):
        self.seen[user] = self.seen.get(user, 0) + 1
        if self.seen[user] < 3:
            raise ValueError("try again")
        return "ok " * 3


def test_calls_are_tried_again(spark):
    docs = spark.createDataFrame([("p", ["a", "b"], ["t"])], "path string, chunks array<string>, glossary array<string>")
    assert generate.map_reduce(docs, Flaky(), sleep=lambda s: None).first()["status"] == "done"
    assert generate.map_reduce(docs, Flaky(), tries=2, sleep=lambda s: None).first()["status"] == "failed"


def test_prompts_and_partial_results(spark):
    p = generate.prompts_of("merged", guidance="별자리")
    assert "별자리" in p.system() and p.system() != generate.prompts_of("summary").system()
    final = p.final("f", ["n1", "n2"], ["용어"])
    assert all(title in final for title in generate.SECTIONS["merged"]) and "n1\n\n====\n\nn2" in final and "용어" in final
    assert "[BROKEN]\nold" in p.repair("f", ["n"], [], "old") and "2/3" in p.chunk("f", 2, 3, "text", [])
    docs = spark.createDataFrame([("q", ["one", "QQQ"], [])], "path string, chunks array<string>, glossary array<string>")
    got = generate.map_reduce(docs, Breaks("QQQ", "HTTP 429\nmore"), sleep=lambda s: None).first()
    assert got["status"] == "partial" and "`chunk 2/2`" in got["text"] and "`HTTP 429`" in got["text"] and "### 구간 노트 1" in got["text"]


def test_study_texts(spark):
    docs = spark.createDataFrame([("a/오행 기초.txt", "오행은 나무와 불과 흙과 쇠와 물입니다. 음양은 오행의 바탕이 되는 생각입니다."), ("b.txt", "")], "path string, text string")
    got = {r["path"]: r["text"].split("\n") for r in summary.study_texts(summary.sections(docs, ["오행", "음양"])).collect()}
    a, b = got["a/오행 기초.txt"], got["b.txt"]
    assert a[:5] == ["# 오행 기초 요약", "", summary.HEADINGS[0], "", "### 주제 1. 오행, 음양"] and a[5].startswith("- ") and a[-2:] == [summary.FLOW[-1], ""]
    assert [x for x in a if x.startswith("## ")] == list(summary.HEADINGS[:3]) and sum(x.startswith("- 풀이") for x in a) == 5
    assert b[4:7] == [f"### 주제 1. {', '.join(summary.NO_THEMES[0])}", f"- {summary.NO_SENTENCE}", ""] and sum(x.startswith("### 주제") for x in b) == 3
    at = a.index("1. 개념: " + a[a.index(summary.HEADINGS[1]) + 2].removeprefix("1. 개념: "))
    assert a[at + 1].startswith("- 문제(객관식)") and a[at + 2].startswith("- 풀이")


def test_markers_are_taken_out_and_files_of_segments(spark):
    docs = spark.createDataFrame([("a", "x\n @@ override: p => q\ny"), ("b", "x\ny"), ("c", "@@ override: p => q")], "path string, text string")
    assert [r["corrected"] for r in dictionary.clean_texts(docs).orderBy("path").collect()] == ["x\ny\n", "x\ny", ""]
    rows = spark.createDataFrame([("v", 2.0, 3.0, " 둘  째 "), ("v", 0.0, 1.0, "첫째"), ("v", 3.0, 4.0, " "), ("w", 0.0, 1.0, "")], "path string, start double, end double, text string")
    assert {r["path"]: r["text"] for r in segments.txt_files(rows).collect()} == {"v": "첫째\n둘 째\n", "w": "\n"}
    assert segments.srt_files(rows).first()["text"] == "1\n00:00:00,000 --> 00:00:01,000\n첫째\n\n2\n00:00:02,000 --> 00:00:03,000\n둘 째\n"
