"""Rules by the thousand equal the plain fold, and their cost does not grow with their number."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import fold
from lectern.operators import rewrite as rw


def plain(text, rules, gate=None):
    stats = []
    for i, (wrong, right) in enumerate(rules):
        if wrong and wrong in text:
            parts, at, applied, skipped, last = [], text.find(wrong), 0, 0, 0
            while at >= 0:
                if gate is None or gate(i, text, at, at + len(wrong)):
                    parts += [text[last:at], right]
                    last = at + len(wrong)
                    applied += 1
                else:
                    skipped += 1
                at = text.find(wrong, at + len(wrong))
            stats.append((i, applied, skipped))
            text = "".join([*parts, text[last:]])
    return text, stats


pairs = st.lists(st.tuples(st.text("abc", min_size=0, max_size=4), st.text("abc", max_size=5)), max_size=9)


@settings(max_examples=600, deadline=None)
@given(pairs, st.text("abc", max_size=30))
def test_fold_equals_the_plain_one(rules, text):
    assert fold.Ordered(rules).fold(text) == plain(text, rules)


@settings(max_examples=300, deadline=None)
@given(pairs, st.text("abc", max_size=30), st.integers(0, 6))
def test_gated_fold_equals_the_plain_one(rules, text, seed):
    gate = lambda i, t, start, end: (i + start + len(t)) % 3 != seed % 3
    assert fold.Ordered(rules).fold(text, gate) == plain(text, rules, gate)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.text("ab", max_size=3)), min_size=1, max_size=6), st.text("ab", max_size=12))
def test_the_graph_has_every_rule_that_an_output_leads_to(rules, text):
    """Whatever input comes up by one rule alone is not beyond the last rule that the graph names."""
    ends = fold.reach(rules)
    for i, (wrong, right) in enumerate(rules):
        after = text.replace(wrong, right)
        for j in range(i + 1, len(rules)):
            if rules[j][0] in after and rules[j][0] not in text:
                assert ends[i] >= j


def test_outputs_that_no_input_touches_lead_nowhere():
    assert fold.reach([("ab", "X"), ("cd", "Y"), ("Yz", "q"), ("e", "")]) == [-1, 2, -1, -1]


def test_rows_in_runs_of_rules(spark, monkeypatch):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 5))) for _ in range(150)}, key=lambda w: (-len(w), w))
    rules = [(w, w[1:] + rng.choice(["", "a", "dd"])) for w in words]
    texts = [None, "", *("".join(rng.choice("abcd ") for _ in range(80)) for _ in range(40))]
    df = spark.createDataFrame([(i, t, i % 5 > 0, "clash") for i, t in enumerate(texts)], "path int, text string, able boolean, ord string").repartition(3)
    table = spark.createDataFrame([(2 * i, *r) for i, r in enumerate(rules)], "ord long, wrong string, right string").repartition(4)
    monkeypatch.setattr(fold, "RULES_A_PASS", 40)
    out = fold.fold_many(df, table, able_col="able")
    got = {r["path"]: (r["text"], [tuple(u) for u in r["uses"]], r["ord"]) for r in out.collect()}
    total = {}
    for i, t in enumerate(texts):
        text, stats = plain(t, rules) if t and i % 5 else (t, [])
        assert got[i] == (text, [(2 * k, n) for k, n, _ in stats], "clash")
        for k, n, _ in stats:
            total[rules[k]] = total.get(rules[k], 0) + n
    assert {(r["wrong"], r["right"]): r["uses"] for r in fold.usage(out, table).collect()} == total
    assert fold.fold_many(df, table.limit(0)).where("size(uses) > 0").count() == 0


def test_many_and_few_rules_fold_lines_alike(spark, monkeypatch):
    rules = [("thth", "th"), ("and", "und"), ("und", "&"), ("e", "é"), ("ée", "x")]
    lines = spark.createDataFrame([("a.srt", 1, "and 1", True), ("a.srt", 2, "00:00:01,000 --> 00:00:02,000", True), ("b", 1, "hand eel ththth", False), ("b", 2, None, False)], "path string, line_no int, text string, is_srt boolean")
    few = rw.fold_lines(lines, rules)
    monkeypatch.setattr(rw, "FEW_RULES", 1)
    many = rw.fold_lines(lines, rules)
    assert many.columns == few.columns
    shown = lambda df: sorted((r["path"], r["line_no"], r["text"] or "", [tuple(u) for u in r["uses"] or []]) for r in df.collect())
    assert shown(many) == shown(few)
    assert sorted(map(tuple, rw.rule_usage(many, rules).collect())) == sorted(map(tuple, rw.rule_usage(few, rules).collect()))


@pytest.mark.parametrize("n", [300, 6000])
def test_work_goes_with_the_rules_that_fire(n):
    """Places that are looked at are counted: they stay when there are twenty times as many rules."""
    rng = random.Random(1)
    rules = [("needle", "thread"), ("thread", "rope")] + [(f"w{rng.randrange(10**9)}x", "y") for _ in range(n)]
    own = fold.Ordered(rules)
    scans = []
    due = own._due
    own._due = lambda *a: scans.append(a[1:]) or due(*a)
    assert own.fold("a needle in hay " * 20)[0] == "a rope in hay " * 20
    assert len(scans) <= 1 + 20


def test_parts_that_come_again_are_looked_up():
    own = fold.Ordered([("needle", "thread"), ("thread", "rope")])
    scans = []
    due = own._due
    own._due = lambda *a: scans.append(a) or due(*a)
    assert own.fold("needle, " * 1000) == ("rope, " * 1000, [(0, 1000, 0), (1, 1000, 0)])
    assert len(scans) <= 4


def test_a_worker_makes_the_rules_of_a_run_ready_once():
    class Told:
        value = fold.Packed(["ab", ""]), fold.Packed(["c", ""]), [7, 9]

    first = fold._ready("run", Told)
    assert fold._ready("run", Told) is first and first[0].fold("xab") == ("xc", [(0, 1, 0)]) and list(Told.value[0]) == ["ab", ""]


@pytest.mark.parametrize("seed", range(60))
def test_pieces_equal_the_whole_fold_while_rules_change(seed):
    rng = random.Random(seed)
    word = lambda least, most: "".join(rng.choice("abc") for _ in range(rng.randint(least, most)))
    wide = lambda: rng.choice([word(1, 2) + " " + word(1, 2), word(1, 2) + " " + word(0, 1) + " " + word(1, 2), word(1, 2) + ", ", " " * (seed % 5 == 0) + word(1, 1), word(1, 1) + "-" + word(1, 2)])
    rules = [(word(1, 4), rng.choice([word(0, 3), wide()])) for _ in range(8)] + [(wide(), word(0, 3)) for _ in range(3)]
    verdicts = [rng.choice([True, True, True, False]) for _ in rules]
    own, order = fold.Ordered(rules), {i: (i,) for i in range(len(rules))}
    pieces = fold.Pieces(own, order, verdicts, {1, 2, 3})
    by_piece = 0
    for _ in range(60):
        if rng.random() < 0.3:
            i = rng.choice([1, 2, 3])
            order.pop(i, None)
            if rng.random() < 0.7:
                order[i] = (rng.randint(-1, len(rules)), -1)
            pieces.changed(i)
            pieces.settled.clear()
        text = rng.choice(["", " ", "-"]).join(word(0, 5) + rng.choice(["", " ", ", ", "x"]) for _ in range(rng.randint(0, 12))) + word(0, 3) * rng.choice([1, 1, 90])
        want = own.fold(text, lambda i, *_: verdicts[i], order)
        got = pieces.fold(text)
        by_piece += got is not None
        assert got in (None, want), (rules, text)
        loud = rng.choice([0, 1, 9])
        if pieces.quiet(text, lambda i: i == loud):
            assert not any(i == loud and applied for i, applied, _ in want[1])
        pieces.settled.clear()  # another rule is loud the next time
    assert by_piece or seed % 5 == 0


def test_a_rule_whose_context_tells_is_left_to_the_whole_fold():
    own, order = fold.Ordered([("aa", "b"), ("bc", "d")]), {0: (0,), 1: (1,)}
    pieces = fold.Pieces(own, order, [True, None], set())
    assert pieces.fold("aa x aa") == ("b x b", [(0, 2, 0)]) and pieces.fold("aac") is None and not pieces.quiet("x aac", lambda i: False)
