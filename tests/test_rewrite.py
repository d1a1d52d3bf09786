"""Order, snapshots, gates and counts of rewriting."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions.text import glob_pattern
from lectern.operators import rewrite as rw
from lectern.operators.rewrite import FamilyRule, RegexRule, Rules, rewrite_text


def test_later_rules_see_what_earlier_ones_made():
    text, stats = rewrite_text("ab", Rules(literals=(("ab", "cd"), ("cd", "ef"))))
    assert text == "ef" and [s[2:] for s in stats] == [("ab", "cd", 1, 0), ("cd", "ef", 1, 0)]


def test_a_rule_sees_the_text_before_it_for_every_match():
    rules = Rules(literals=(("가나", "다라마"),), pair_include={("가나", "다라마"): ("열쇠",)}, domain_keywords=("열쇠",))
    text, stats = rewrite_text("가나 열쇠" + "." * 200 + "가나", rules)
    assert text.startswith("다라마") and text.endswith("가나") and stats[0][4:] == (1, 1)


def test_gate_order():
    pair = ("배수로", "배수")
    rules = Rules(literals=(pair,), raw_priority=frozenset({pair}), domain_keywords=("사주",), pair_exclude={pair: ("배수로",)})
    assert rewrite_text("사주 배수로", rules, is_raw=True)[0] == "사주 배수"
    assert rewrite_text("사주 배수로", rules)[0] == "사주 배수로"  # the match itself is in its window
    assert rewrite_text("배수로", Rules(literals=(pair,), forced=frozenset({pair})))[0] == "배수"


def test_short_hangul_needs_a_boundary_and_the_domain():
    rules = Rules(literals=(("수기", "수긱"), ("1주", "일주")), domain_keywords=("오행",))
    assert rewrite_text("오행 수기 수기가", rules)[0] == "오행 수긱 수기가"
    assert rewrite_text("수기 1주", rules)[0] == "수기 일주"  # digits make no short Hangul word


def test_regex_stages_and_families():
    rules = Rules(
        contextual=(RegexRule("가(나)", r"다\1", "가나", "다나", include=("열쇠",)),),
        families=(FamilyRule("(?<![가-힣])정제[가-힣]*", "정제", "정재", skip_suffixes=("당",), exclude=("약국",)),),
        compounds=(("([목화])[국곡]([토수])", r"\1극\2"),),
        regexes=(RegexRule("묵생([화토])", r"목생\1", "묵생*", "목생*"),),
    )
    text, stats = rewrite_text("열쇠 가나 정제는 정제당 목국토 묵생화", rules)
    assert text == "열쇠 다나 정재는 정제당 목극토 목생화"
    assert {(s[2], s[3]): s[4] for s in stats} == {("가나", "다나"): 1, ("정제*", "정재*"): 1, ("목국토", "목극토"): 1, ("묵생*", "목생*"): 1}
    assert rewrite_text("정제 약국", rules)[0] == "정제 약국"
    assert rewrite_text("묵생화", Rules(regexes=rules.regexes, topic_rules=False))[0] == "묵생화"


def test_overrides_go_by_path_and_length(spark):
    docs = spark.createDataFrame([("a/x.txt", "긴말 말"), ("b/x.txt", "긴말"), ("a/n.txt", None)], "path string, text string")
    over = [(glob_pattern("a/*"), "말", "글"), (glob_pattern("a/*"), "긴말", "새말")]
    out = {r["path"]: r["corrected"] for r in rw.rewrite(docs, Rules(), over).collect()}
    assert out == {"a/x.txt": "새글 글", "b/x.txt": "긴말", "a/n.txt": ""}


def test_metrics_keep_overrides_apart(spark):
    docs = spark.createDataFrame([("a", "xx yy zz")], "path string, text string")
    rules = Rules(literals=(("yy", "yyy"), ("zz", "q")), pair_include={("zz", "q"): ("없음",)})
    row = rw.metrics(rw.rewrite(docs, rules, [(glob_pattern("a"), "xx", "x")])).first()
    assert (row.applied_rules, row.applied_hits, row.skipped_rules, row.skipped_hits, row.override_rules, row.override_hits) == (1, 1, 1, 1, 1, 1)
    assert row.changed_chars == 2  # places that differ, not edits


def test_fold_lines_leaves_subtitle_frames(spark):
    lines = spark.createDataFrame([("a.srt", 1, "1", True), ("a.srt", 2, "1 말", True), ("b.txt", 1, "1", False)], "path string, line_no int, text string, is_srt boolean")
    out = rw.fold_lines(lines, [("1", "하나")])
    assert sorted(r["text"] for r in out.collect()) == ["1", "하나", "하나 말"]
    assert [tuple(r) for r in rw.rule_usage(out, [("1", "하나")]).collect()] == [("1", "하나", 2)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.text("abc", max_size=3)), max_size=5), st.text("abc ", max_size=30))
def test_fold_equals_python(spark, rules, text):
    want, counts = text, []
    for w, r in rules:
        counts.append(want.count(w))
        want = want.replace(w, r)
    row = spark.createDataFrame([(text,)], "t string").select(rw.fold_literals(F.col("t"), rules).alias("f")).first()["f"]
    assert row["text"] == want and row["counts"] == counts


@settings(max_examples=15, deadline=None)
@given(st.text("ab가 ", max_size=40), st.integers(0, 5))
def test_gated_replace_equals_python(spark, text, window):
    import re

    starts = [m.start() for m in re.finditer("ab", text)]
    ok = ["가" in text[max(0, s - window) : s + 2 + window] for s in starts]
    parts = text.split("ab")
    want = parts[0] + "".join(("X" if o else "ab") + p for o, p in zip(ok, parts[1:], strict=True))
    row = spark.createDataFrame([(text,)], "t string").select(rw.gated_replace(F.col("t"), "ab", "X", ("가",), window=window).alias("f")).first()["f"]
    assert (row["text"], row["applied"], row["skipped"]) == (want, sum(ok), len(ok) - sum(ok))


def test_a_failing_document_does_not_stop_others(spark):
    from lectern.operators import batch
    from lectern.operators.rewrite import Rules

    docs = spark.createDataFrame([("a", "the"), ("b", None)], "path string, text string")
    bad = {r["path"]: r for r in batch.correct(docs, Rules(compounds=(("(t", "x"),))).collect()}
    assert all(r["status"] == "failed" and r["message"] and r["corrected"] == (r["text"] or "") for r in bad.values())
    good = {r["path"]: r for r in batch.correct(docs, Rules(compounds=(("(t)h", r"\1"),))).collect()}
    assert good["a"]["corrected"] == "te" and good["a"]["status"] == "done" and good["a"]["message"] is None


def test_unions_can_follow_each_other(spark):
    from lectern.operators.dictionary import union_first

    table = lambda *words: spark.createDataFrame([(i, w) for i, w in enumerate(words)], "seq long, term string")
    got = union_first(union_first(table("a", "b"), table("b", "c"), ["term"]), table("d", "a"), ["term"])
    assert [r["term"] for r in got.orderBy("seq").collect()] == ["a", "b", "c", "d"]
