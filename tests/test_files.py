"""Readers and writers on small files, and the stream."""

from datetime import datetime

import pytest

from lectern.functions.text import glob_pattern
from lectern.operators.rewrite import Rules
from lectern.sources import files
from lectern.streaming import incremental


def test_pairs_keep_order_and_repeats(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('﻿Wrong , "right"\n 갑묵 ,갑목\n같은,같은\n,빈\n"a,b",c\n갑묵,갑목\n', encoding="utf-8")
    got = [(r["wrong"], r["right"]) for r in files.replace_pairs(spark, str(p)).orderBy("seq").collect()]
    assert got == [("갑묵", "갑목"), ("a,b", "c"), ("갑묵", "갑목")]
    assert files.replace_pairs(spark, str(p), dedupe=True).count() == 2
    assert files.replace_pairs(spark, str(tmp_path / "none.csv")).count() == 0


def test_terms_of_several_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("term\n나\n가\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("term\n가\n긴말\n", encoding="utf-8")
    paths = [str(tmp_path / x) for x in ("a.csv", "b.csv", "a.csv")]
    assert [r["term"] for r in files.terms(spark, *paths).orderBy("seq").collect()] == ["나", "가", "긴말"]
    assert files.terms(spark, *paths, least=2).count() == 1


def test_stopwords_and_overrides(spark, tmp_path):
    (tmp_path / "s.txt").write_text("하나 # 주석\n# 전부\n\n둘\n", encoding="utf-8")
    assert sorted(r["word"] for r in files.stopwords(spark, str(tmp_path / "s.txt")).collect()) == ["둘", "하나"]
    (tmp_path / "o.jsonl").write_text('# c\n{"path":"a\\\\*.txt","wrong":"x","right":"y"}\n{"path":"a","wrong":"x","right":"x"}\n', encoding="utf-8")
    rows = files.file_overrides(spark, str(tmp_path / "o.jsonl")).collect()
    assert [(r["path"], r["wrong"], r["note"], r["glob_re"]) for r in rows] == [("a/*.txt", "x", "", glob_pattern("a/*.txt"))]
    (tmp_path / "bad.jsonl").write_text("{}\n{oops\n", encoding="utf-8")
    with pytest.raises(Exception, match="invalid JSON at line 2"):
        files.file_overrides(spark, str(tmp_path / "bad.jsonl")).collect()


def test_transcripts_fall_back(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "A.TXT").write_bytes("﻿한글".encode())
    (tmp_path / "b.srt").write_bytes("한글".encode("cp949"))
    (tmp_path / "c.txt").write_bytes(b"\xff\xff\x81")
    (tmp_path / "x.md").write_bytes(b"no")
    got = {r["path"]: (r["text"], r["encoding"]) for r in files.transcripts(spark, str(tmp_path)).collect()}
    assert set(got) == {"d/A.TXT", "b.srt", "c.txt"}
    assert got["d/A.TXT"] == ("한글", "utf-8-sig") and got["b.srt"] == ("한글", "cp949") and got["c.txt"][1] == "replace"
    assert files.transcripts(spark, str(tmp_path), with_srt=False).count() == 2


def test_text_files_and_csv_writer(spark, tmp_path):
    (tmp_path / "in" / "k 1").mkdir(parents=True)
    (tmp_path / "in" / "k 1" / "가.txt").write_text("a\nb", encoding="utf-8")
    assert [tuple(r) for r in files.text_files(spark, str(tmp_path / "in")).collect()] == [("k 1/가.txt", "a\nb")]
    rows = spark.createDataFrame([(1, 'q"x', "y"), (0, "a", "b")], "seq long, wrong string, right string")
    files.write_csv(rows, str(tmp_path / "out"), ["wrong", "right"])
    part = next((tmp_path / "out").glob("part-*"))
    assert part.read_text(encoding="utf-8") == '﻿wrong,right\na,b\n"q""x",y\n'


def test_cells_with_quotes_and_newlines_come_back(spark, tmp_path):
    given = [('a"b', "c,d"), ("두\n줄", 'x""'), ("e", "f")]
    rows = spark.createDataFrame([(i, w, r) for i, (w, r) in enumerate(given)], "seq long, wrong string, right string")
    files.write_csv(rows, str(tmp_path / "out"), ["wrong", "right"])
    part = str(next((tmp_path / "out").glob("part-*")))
    assert [(r["wrong"], r["right"]) for r in files.replace_pairs(spark, part).orderBy("seq").collect()] == given
    (tmp_path / "q.csv").write_text('right, "wrong"\n"y, z",x\n\n r , w \nonly\n', encoding="utf-8")
    assert [(r["wrong"], r["right"]) for r in files.replace_pairs(spark, str(tmp_path / "q.csv")).orderBy("seq").collect()] == [("x", "y, z"), ("w", "r")]
    (tmp_path / "none.csv").write_text("", encoding="utf-8")
    assert files.replace_pairs(spark, str(tmp_path / "none.csv")).count() == 0


def test_a_file_for_each_text(spark, tmp_path):
    rows = spark.createDataFrame([("강의/a.corrected.txt", "가\n"), ("b.txt", None), (None, "x")], "path string, text string")
    out = tmp_path / "files"
    assert {r["path"]: r["bytes"] for r in files.write_files(rows, str(out)).collect()} == {"강의/a.corrected.txt": 4, "b.txt": 0}
    assert (out / "강의" / "a.corrected.txt").read_text(encoding="utf-8") == "가\n" and (out / "b.txt").read_bytes() == b""
    files.write_files(rows, f"file://{out}", mark=True).count()
    assert (out / "강의" / "a.corrected.txt").read_bytes() == "\ufeff가\n".encode() and not list(out.rglob("*.part"))
    with pytest.raises(Exception, match="leaves its folder"):
        files.write_files(spark.createDataFrame([("../x", "y")], "path string, text string"), str(out)).count()
    files.write_summaries(spark.createDataFrame([("k/c.script.txt", "# c")], "path string, text string"), str(out)).count()
    assert (out / "md" / "k" / "c.script.md").read_text(encoding="utf-8-sig") == (out / "txt" / "k" / "c.script.txt").read_text(encoding="utf-8-sig") == "# c"


def test_reports_of_runs(spark, tmp_path):
    rows = spark.createDataFrame([("b", 0, "source: b"), ("a", 1, "x: 1"), ("a", 0, "source: a")], "path string, n int, line string")
    for day, revision in ((1, "r1"), (2, "r2"), (2, "r2")):
        files.append_report(rows, str(tmp_path), revision, datetime(2024, 1, day))
    runs = sorted(tmp_path.iterdir())
    assert [p.name for p in runs] == ["20240101-000000", "20240102-000000"]
    whole = "".join(p.read_text(encoding="utf-8") for p in sorted(runs[1].glob("part-*")))
    assert whole == "[r2 - 2024-01-02 00:00:00]\n\nsource: a\nx: 1\n\nsource: b\n\n"


def test_run_folder():
    assert files.run_folder("me", "20240101-000000") == "me__20240101-000000"
    assert files.run_folder("me__20240101-000000", "x") == "me__20240101-000000"
    for agent, stamp in (("", "20240101-000000"), ("me", "2024")):
        with pytest.raises(ValueError):
            files.run_folder(agent, stamp)


def test_stream_rewrites_what_is_new(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    for k, rows in enumerate(([("a", "ab")], [("b", "ab ab")])):
        spark.createDataFrame(rows, "path string, text string").write.mode("append").parquet(src)
        q = incremental.rewrite_stream(incremental.new_documents(spark, src), Rules(literals=(("ab", "X"),)), out, str(tmp_path / "cp"))
        q.awaitTermination()
        assert spark.read.parquet(f"{out}/texts").count() == k + 1
    assert {r["corrected"] for r in spark.read.parquet(f"{out}/texts").collect()} == {"X", "X X"}
    assert spark.read.parquet(f"{out}/audit").groupBy().sum("applied").first()[0] == 3
