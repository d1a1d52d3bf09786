import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import decontaminate as dc
from tests_llm_cases import LONG, empty, odd, odd_rows, words

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, size=10):
    wins = {(k, i): {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} for k, (i, t) in enumerate(items) if (w := split(t))}
    out = []
    for key, text in rows:
        w = split(text)
        hit, found = set(), set()
        for (_, i), ws in wins.items():
            for x in ws:
                for k in range(len(w) - len(x) + 1):
                    if tuple(w[k : k + len(x)]) == x:
                        hit.update(range(k, k + len(x)))
                        found.update([str(i)] * (i is not None))
        ids = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), ids, bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in dc.digest(df).collect()), key=str)


def test_planted_and_odd_rows(spark):
    items = [(1, words(30, 7)), (2, words(6, 8)), (3, "one"), (4, None), (5, " ?! "), (6, LONG[1000:1100]), (7, words(30, 7)), (None, "two"), (10, "ÜBER été")]
    rows = [(r[0], r[1]) for r in odd_rows() if r[1] != LONG]
    part = " ".join(words(30, 7).split()[8:20])
    rows += [(50, f"start. {part}, end"), (51, f"{words(5, 9)}! {words(6, 8).upper()}"), (52, f"{part} {part}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert got(dc.find_overlaps(docs, bench)) == brute(rows, items)
    row = dc.digest(dc.find_overlaps(odd(spark), bench)).where("doc_id = 4").first()
    assert row["n_words"] == 60_000 and row["contaminated"]
    clean = dc.clean_rows(odd(spark), bench)
    assert clean.columns == odd(spark).columns
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 5, 6, 7, 10, 11, None}
    assert got(dc.find_overlaps(docs, bench.limit(0))) == brute(rows, [])
    assert dc.find_overlaps(empty(spark), bench).count() == 0


def test_many_tables(spark, monkeypatch):
    monkeypatch.setattr(dc, "WINDOWS_PER_TABLE", 7)
    items = [(i, words(20, i + 20)) for i in range(4)]
    rows = [(i, f"{words(9, i)} {words(20, i + 20)}") for i in range(4)] + [(9, words(20, 20) + " " + words(20, 23))]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(dc.find_overlaps(docs, bench)) == brute(rows, items)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ab ba aab é b7 c".split()), max_size=60), st.lists(st.lists(st.sampled_from("ab ba aab é b7 c".split()), min_size=1, max_size=12), min_size=1, max_size=4))
def test_search_equals_brute_force(text, items):
    pairs = {}
    for i, item in enumerate(items):
        for w in dc.windows_of([x.encode() for x in item]):
            pairs.setdefault(w, []).append(str(i))
    t = " ".join(text)
    (n, hit, found), _ = dc.Matcher(pairs).mark([t.encode(), random.choice(items)[0].encode()])
    want = brute([(0, t)], [(i, " ".join(x)) for i, x in enumerate(items)])[0]
    assert (n, len(hit), len(found)) == want[1:4]
