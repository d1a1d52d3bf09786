import pytest

from lectern.operators import search

HIT = "match_kind string, pattern string, path string, line_no int, timestamp string, text string"


@pytest.mark.parametrize("few", [0, 10_000])
def test_hits_of_a_report_are_found_once(spark, monkeypatch, few):
    monkeypatch.setattr(search, "FEW_GROUPS", few, raising=False)
    rows = [("literal", "a", f"p{i % 7:02}", i, "", f"a {i}") for i in range(200)] + [("literal", f"b{i}", "q", i, "0:01", "b") for i in range(3)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    report = [r["line"] for r in search.report_markdown(spark.createDataFrame(rows, HIT).mapInArrow(counted, HIT), 9).collect()]
    assert seen.value == len(rows)
    assert report[:6] == ["# Suspicious Transcript Candidates", "", "- files_scanned: 9", "- unique_groups: 4", "- total_hits: 203", ""]
    assert report[6:12] == ["## a", "", "- kind: literal", "- hits: 200", "- files: 7", ""]
    assert sum(x.startswith("- p") for x in report) == 200 and report.count("- q:1 [0:01] b") == 1
