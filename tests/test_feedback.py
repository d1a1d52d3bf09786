"""Feedback in the order of files equals a walk from file to file."""

import random
import re

import pytest

from lectern.functions.particles import PARTICLES
from lectern.operators import feedback
from lectern.operators.rewrite import Rules, rewrite_text


def particle(stem, forms):
    last = stem[-1]
    end = (ord(last) - 44032) % 28 if "가" <= last <= "힣" else 0
    return forms[2] if end == 8 else forms[0] if end else forms[1]


def variant(w, r):
    ends = lambda s, f: any(s[k:] == particle(s[:k], f) for k in range(2, len(s)))
    return any(ends(w, f) and ends(r, f) for f in PARTICLES)


def expand(pairs):
    out = []
    for w, r in pairs:
        out.append((w, r, (w, r)))
        if all(re.fullmatch("[가-힣]{2,}", x) for x in (w, r)) and not variant(w, r):
            out += [(w + particle(w, f), r + particle(r, f), (w, r)) for f in PARTICLES]
    return out


def auto(w, r):
    word = re.compile("[가-힣A-Za-z0-9]+( [가-힣A-Za-z0-9]+)?")
    return w != r and all(len(x) <= 20 and word.fullmatch(x) for x in (w, r))


def walk(docs, rules, pairs, manual):
    """One file after the other, with the dictionary as it then is."""
    known, taught, out = list(pairs), [], {}
    for place, text in sorted(docs):
        bases = {}
        for w, r, base in [*expand(known), *((w, r, (w, r)) for w, r in manual)]:
            bases.setdefault((w, r), base)
        own = Rules(**{**rules.__dict__, "literals": tuple(sorted(bases, key=lambda p: -len(p[0]))), "bases": bases})
        new, stats = rewrite_text(text or "", own)
        out[place] = new, [s[:1] + s[2:] for s in stats]
        for stage, _, w, r, applied, _ in stats:
            base = bases.get((w, r))
            if stage == "pair" and applied and base not in known and auto(*base):
                known.append(base)
                taught.append((*base, place))
    return out, taught


STEMS = ["갑목", "정재", "오행", "식신", "물길", "나무", "사주"]


@pytest.mark.parametrize("seed", range(6))
def test_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    wrong = lambda w: w[:-1] + rng.choice("갈간감말")
    pairs = [(wrong(w), w) for w in STEMS[:2]]
    manual = [(wrong(w), w) for w in STEMS[1:]] + [("ab", "cd"), ("cd은", "ef"), ("a b c", "x"), ("정재은", "정관"), pairs[0], ("오행은", "음양은")]
    manual += [(STEMS[3], STEMS[4]), (STEMS[4] + "은", "강물은"), ("강물", "바다")]  # rules that make each other's input
    words = [w for p in [*pairs, *manual] for w in p] + [w + particle(w, f) for w, _ in manual if w for f in PARTICLES[:4]] + ["그리고", "x"]
    docs = [(i * 3, None if i == 4 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))) for i in range(30)]
    given = Rules(pair_exclude={manual[0]: ("그리고",)}, stable=(("  ", " "),))
    df = spark.createDataFrame([(i, f"p{i}", t) for i, t in docs], "doc_id long, path string, text string").repartition(5)
    two = lambda rows: spark.createDataFrame([(i, w, r) for i, (w, r) in enumerate(rows)], "seq long, wrong string, right string")
    done, taught = feedback.sequential(df, given, two(pairs), two(manual))
    want, lessons = walk(docs, given, pairs, manual)
    assert [tuple(r)[1:] for r in taught.orderBy("seq").collect()] == lessons and lessons
    got = {r["place"]: (r["corrected"], [(s["stage"], s["wrong"], s["right"], s["applied"], s["skipped"]) for s in r["stats"]]) for r in done.collect()}
    assert got == want


def test_without_lessons(spark):
    df = spark.createDataFrame([(1, "p", "ab")], "doc_id long, path string, text string")
    none = spark.createDataFrame([], "seq long, wrong string, right string")
    done, taught = feedback.sequential(df, Rules(), none, none)
    assert taught.count() == 0 and done.first()["corrected"] == "ab"
    assert feedback.sequential(df.limit(0), Rules(), none, none)[0].count() == 0


def test_a_chain_of_lessons_takes_as_many_rounds_as_ranges(spark, monkeypatch):
    """What each file teaches makes the input of what the next one teaches: a round for each file, before."""
    n = 12
    names = [f"하파{chr(0xAC00 + 28 * (i + 50))}타카" for i in range(n + 1)]
    manual = [(names[i] + "는", names[i + 1]) for i in range(n)]
    docs = [(0, manual[0][0]), *((i, manual[i - 1][0] + "은") for i in range(1, n))]
    two = lambda rows: spark.createDataFrame([(i, w, r) for i, (w, r) in enumerate(rows)], "seq long, wrong string, right string")
    walks, once = [], feedback._walk
    monkeypatch.setattr(feedback, "_walk", lambda *a: walks.append(a) or once(*a))
    df = spark.createDataFrame([(i, f"p{i}", t) for i, t in docs], "doc_id long, path string, text string").repartition(3)
    _, taught = feedback.sequential(df, Rules(), spark.createDataFrame([], "seq long, wrong string, right string"), two(manual))
    assert [tuple(r)[1:] for r in taught.orderBy("seq").collect()] == walk(docs, Rules(), [], manual)[1] == [(*p, i) for i, p in enumerate(manual)]
    assert len(walks) <= 4 + 2


def test_pieces_that_come_again_are_not_scanned_again(monkeypatch):
    """A walk scanned every text whole, however often its words had come before."""
    import pyarrow as pa

    from lectern.operators.fold import Ordered

    manual = [(w[:-1] + "갈하하", w) for w in STEMS]
    forms = {p: [p] for p in manual}
    texts = [" ".join(random.Random(i % 7).choices([w for p in manual for w in p] + ["그리고", "x"], k=40)) for i in range(300)]
    want = {tuple(r[:2]): r[2] for r in walk(list(enumerate(texts)), Rules(), [], manual)[1]}
    scanned, once = [], Ordered._due
    monkeypatch.setattr(Ordered, "_due", lambda self, text, *a: scanned.append(text) or once(self, text, *a))
    told = type("Told", (), {"value": (feedback.Lessons([], manual, forms), [])})
    batch = pa.RecordBatch.from_pydict({"number": list(range(300)), "place": list(range(300)), "path": ["p"] * 300, "text": texts})
    for keep in (False, True):
        (out,) = feedback._walk(told, Rules(), keep, f"scans {keep}")([batch])
        assert keep or {(r["wrong"], r["right"]): r["place"] for r in out.to_pylist() if r["wrong"]} == want
    assert sum(map(len, scanned)) < sum(map(len, texts)) / 4
