import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.operators import summary

TEXTS = {1: "Beta alpha beta tion. Gamma tion nation beta\n가나다 가나다 이런 xx x", 2: "", 3: None, 4: "one two two three tion " * 30}
TERMS = ["tion", "pass"]


def said(text):
    return Counter(re.findall("[가-힣]{2,}", text or "") + re.findall("[a-z]{2,}", (text or "").lower()))


def wanted(texts, limit):
    domain = [(t, n) for x in texts for t in TERMS if (n := (x or "").count(t))]
    free = sum((said(x) for x in texts), Counter())
    rows = [(0, -n, t) for t, n in domain] + [(1, -n, w) for w, n in free.items() if w not in summary.STOPWORDS and w not in dict(domain)]
    return [(i, w, other == 0, -n) for i, (other, n, w) in enumerate(sorted(rows)[:limit], 1)]


def moved(df):
    return re.findall(r"Exchange \w+\([^)]*", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("repeated", [False, True])
def test_keywords_and_scores_are_counted_by_path(spark, repeated):
    rows = [*TEXTS.items(), *([(1, "alpha alpha gamma pass 가나다"), (2, "beta")] if repeated else [])]
    docs = spark.createDataFrame(rows, "path long, text string")
    keys, scores = summary.keywords(docs, TERMS, 3), summary.biased_scores(docs, TERMS)
    for path in TEXTS:
        own = [t for p, t in rows if p == path]
        assert sorted(tuple(r)[1:] for r in keys.where(f"path = {path}").collect()) == wanted(own, 3)
        want = Counter()
        for x in own:
            want.update({t: n + 1000 for t in TERMS if (n := (x or "").count(t))})
            want.update(w for w in re.findall("[가-힣A-Za-z]{2,}", x or "") if w not in summary.STOPWORDS and not re.fullmatch("[A-Za-z]+", w))
        assert {r["keyword"]: r["score"] for r in scores.where(f"path = {path}").collect()} == want


def test_words_of_documents_do_not_move(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "path long, text string")
    keys = summary.keywords(docs, TERMS)
    assert not moved(keys) and not moved(summary.biased_scores(docs, TERMS))
    scored = summary.scored_sentences(docs, keys)
    themed = summary.theme_sentences(scored, summary.themes(keys))
    named = docs.withColumn("path", F.col("path").cast("string"))
    for df in (scored, themed, summary.concepts(named, summary.keywords(named, TERMS))):
        assert not any(re.search(r", (keyword|sentence)#", x) for x in moved(df)), moved(df)


def test_sections_read_texts_once(spark):
    docs = spark.createDataFrame([(f"{k}.txt", t) for k, t in TEXTS.items()], "path string, text string")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = summary.sections(docs.mapInArrow(counted, "path string, text string"), TERMS).collect()
    assert seen.value <= 6 * len(TEXTS)  # for equal paths, for the table, and for the paths of the lines
    twice = spark.createDataFrame([(f"{k}.txt", t) for k, t in [*TEXTS.items(), (1, TEXTS[1])]], "path string, text string")
    themes = lambda d: {r["line"] for r in summary.sections(d, ["pass"]).where("part = 1 and path = '1.txt'").collect()}
    assert len(got) and themes(twice) == themes(docs)


ODD = [
    *TEXTS.items(),
    (5, "Tion one. Two? \x85three three!\x1c　 four 가나다.가나 다라 。 라마 라마\r\n\r\n pass pass. \x0b x"),
    (6, "İİ Kelvin KELVIN ab。 ab cd! " + "long " * 50 + ". medium sentence without keys here. 𝔘 𝔘x"),
    (7, " . ! ?\n.\n a b c"),
    (None, "alpha beta. gamma delta gamma delta gamma delta. beta"),
]


@pytest.mark.parametrize("repeated", [False, True])
def test_what_is_made_within_a_document_equals_the_joins(spark, repeated):
    docs = spark.createDataFrame([*ODD, *([(1, "alpha alpha gamma pass 가나다. beta beta")] if repeated else [])], "path long, text string")
    rows = lambda df: sorted(map(repr, map(tuple, df.collect())))
    keys = summary._keyword_rows(docs, TERMS, 6)
    assert rows(summary.keywords(docs, TERMS, 6)) == rows(keys)
    assert rows(summary._ranked(summary._keyed(docs.where("path > 1"), TERMS, 6))) == rows(keys.where("path > 1"))
    scored = summary.scored_sentences(docs, keys)
    assert rows(summary.document_sentences(docs, TERMS, 2, 6)) == rows(scored.where("rank <= 2")) and scored.count()
    assert rows(summary.document_themes(docs, TERMS, 2, 6)) == rows(summary.theme_sentences(scored, summary.themes(keys), 2))


@pytest.mark.parametrize("name", ["sentence_scores", "theme_sentences"])
def test_texts_do_not_move(spark, name):
    from lectern.plans import catalogue

    assert not moved(catalogue.queries()[name](spark, "/root/testdata/sf0.001"))
