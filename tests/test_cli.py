"""Commands end to end on a small folder."""

import json

import pytest

from lectern import cli
from lectern.operators import batch


@pytest.fixture
def folder(tmp_path):
    raw, d = tmp_path / "data" / "x" / "raw" / "강의", tmp_path / "dict"
    raw.mkdir(parents=True)
    d.mkdir()
    (raw / "a.txt").write_text("00:01\n갑묵은 정제를 본다\n\n\n00:05\n오행의 정제\n", encoding="utf-8")
    (raw / "b.txt").write_text("아무 말", encoding="utf-8")
    (d / "replace.csv").write_text("wrong,right\n갑묵,갑목\n정제,정재\n", encoding="utf-8")
    (d / "terms.csv").write_text("term\n갑목\n오행\n", encoding="utf-8")
    (d / "file_overrides.jsonl").write_text('{"path":"강의/b*","wrong":"아무","right":"어떤"}\n', encoding="utf-8")
    (tmp_path / "rules.json").write_text(json.dumps({"domain_keywords": ["오행"], "stable": [["본다", "봅니다"]]}), encoding="utf-8")
    return tmp_path


def test_correct(spark, folder):
    out = f"{folder}/out"
    cli.main(["correct", "--source", f"{folder}/data/x/raw", "--dict-dir", f"{folder}/dict", "--output", out, "--rules", f"{folder}/rules.json"], spark)
    got = {r["path"]: r for r in spark.read.parquet(f"{out}/corrected").collect()}
    assert got["강의/a.txt"]["corrected"] == "00:01\n갑목은 정재를 봅니다\n\n\n00:05\n오행의 정재\n"
    assert got["강의/a.txt"]["script"] == "갑목은 정재를 봅니다\n\n오행의 정재\n" and got["강의/b.txt"]["corrected"] == "어떤 말"
    report = [r["line"] for r in spark.read.parquet(f"{out}/report").where("path like '%a.txt'").orderBy("n").collect()]
    assert "term_hits_after_correction: 2" in report and "갑묵은 -> 갑목은 (x1)" in report
    assert spark.read.parquet(f"{out}/audit").where("stage = 'override'").count() == 1
    assert batch.changed(spark.read.parquet(f"{out}/corrected")).count() == 2


def test_candidates_review_refine_summary(spark, folder):
    s = folder / "script"
    s.mkdir()
    (s / "a.script.txt").write_text("첫 줄 갑묵\n@@ override: 틀린 => 바른\n", encoding="utf-8")
    c = folder / "corr"
    c.mkdir()
    (c / "a.corrected.txt").write_text("00:07\n첫 줄 갑묵\n", encoding="utf-8")
    common = ["--dict-dir", f"{folder}/dict", "--output"]
    cli.main(["candidates", "--source", str(s), "--corrected", str(c), "--regex", "첫", *common, f"{folder}/o1"], spark)
    assert {(r["pattern"], r["timestamp"]) for r in spark.read.json(f"{folder}/o1/hits").collect()} == {("갑묵", "00:07"), ("첫", "00:07")}
    assert any("- a.script.txt:1 [00:07] 첫 줄 갑묵" == r["value"] for r in spark.read.text(f"{folder}/o1/report").collect())
    cli.main(["review", "--source", str(s), *common, f"{folder}/o2"], spark)
    assert {(r["path"], r["right"]) for r in spark.read.json(f"{folder}/o2/file_overrides").collect()} == {("강의/b*", "어떤"), ("a.txt", "바른")}
    cli.main(["refine", "--source", f"{folder}/data", "--min-term-freq", "1", *common, f"{folder}/o3"], spark)
    assert spark.read.parquet(f"{folder}/o3/lines").where("contains(text, '갑목은')").count() == 1
    cli.main(["summary", "--source", f"{folder}/data", "--agent-name", "me", "--run-timestamp", "20240101-000000", *common, f"{folder}/o4"], spark)
    assert spark.read.parquet(f"{folder}/o4/me__20240101-000000").where("line like '### 주제 1.%'").count() == 2


def test_missing_corrected_file_fails(spark):
    scripts = spark.createDataFrame([("a.script.txt", "x")], "path string, text string")
    with pytest.raises(Exception, match="no corrected file"):
        batch.pair_with_corrected(scripts, spark.createDataFrame([], "path string, text string")).collect()


def test_manifest_and_sources(spark):
    rows = spark.createDataFrame([("c/강의.script.txt", i, f"k{i}") for i in range(1, 6)], "path string, n int, concept string")
    got = json.loads(batch.manifest(rows, "과정").first()["json"])
    assert got["title"] == "강의" and got["theme_focuses"] == ["k1, k2", "k3, k4", "k5"] and got["draft_md"] == "c/강의.script.md"
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([("/d/data/x/RAW", "a.txt"), ("/d/data/x/raw/y", "a.txt"), ("/d/data/x/raw", "/abs")], "root string, path string")
    assert [r[0] for r in docs.select(batch.is_raw_source(F.col("root"), F.col("path"))).collect()] == [True, False, False]
