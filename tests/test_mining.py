"""Counts by document move texts once."""

from lectern.operators import mining


def test_top_tokens_deal_texts_once(spark):
    docs = spark.createDataFrame([(1, "b a a c"), (1, "b b"), (2, None), (3, "x")], "path long, text string")
    top = mining.top_tokens(docs, 2)
    assert sorted(tuple(r) for r in top.collect()) == [(1, "a", 2, 2), (1, "b", 3, 1), (3, "x", 1, 1)]
    plan = top._jdf.queryExecution().sparkPlan().toString() + top._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Initial Plan") :] if "Initial Plan" in plan else top._jdf.queryExecution().executedPlan().toString()
    assert final.count("Exchange ") == 1


def test_stems_are_tested_after_they_are_counted(spark):
    lines = spark.createDataFrame([("p", 1, "가나는 가나 다")], "path string, line_no int, text string")
    stems = mining.stem_counts(mining.token_counts(lines))
    plan = stems.select("token", "count")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    lowest = max(i for i, x in enumerate(plan) if "Aggregate" in x)
    assert not any("Filter" in x and "regexp_extract(" in x for x in plan[lowest:])
    assert {(r["token"], r["count"]) for r in stems.collect()} == {("가나", 2)}


def test_ties_of_suggested_terms_go_by_first_appearance(spark):
    lines = spark.createDataFrame([("b", 1, "사주라 사주라"), ("a", 2, "사주바 사주마 사주마 사주바"), ("c", 1, "사주차 사주차 사주차 무관")], "path string, line_no int, text string")
    terms = spark.createDataFrame([(0, "사주")], "seq long, term string")
    stems = mining.stem_counts(mining.token_counts(lines))
    got = [[r["term"] for r in mining.suggest_terms(stems, terms, most=k).collect()] for k in (1, 2, 9)]
    assert got == [["사주차"], ["사주차", "사주바"], ["사주차", "사주바", "사주마", "사주라"]]
