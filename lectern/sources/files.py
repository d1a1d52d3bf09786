"""Readers and writers of dictionaries and transcripts, all through Spark's own file access."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from datetime import datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import glob_pattern, lines, mirror, strip
from lectern.operators.dictionary import clean_pairs, clean_terms

STAMP = re.compile(r"\d{8}-\d{6}")


def text_files(spark: SparkSession, root: str, pattern: str = "*.txt") -> DataFrame:
    """(path, text) of whole files below root, path relative to it."""
    rows = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return rows.select(relative_path(F.col("_metadata.file_path"), root).alias("path"), F.col("value").alias("text"))


def relative_path(path: Column, root: str) -> Column:
    base = re.sub(r"^[a-z]+:/*", "/", root).rstrip("/")
    clean = F.url_decode(F.regexp_replace(F.replace(path, F.lit("+"), F.lit("%2B")), "^[a-z]+:/*", "/"))
    return F.when(clean.startswith(base + "/"), F.substring(clean, F.lit(len(base) + 2), F.length(clean))).otherwise(clean)


def transcripts(spark: SparkSession, root: str, with_srt: bool = True) -> DataFrame:
    """(path, text, encoding) of .txt and .srt files in any case, decoded with fallbacks.

    Tried in order: UTF-8 with a mark, UTF-8, cp949; else UTF-8 with replacements.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kinds = r"(?i)\.(txt|srt)$" if with_srt else r"(?i)\.txt$"

    def decode(batches):
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                for encoding in ("utf-8-sig", "cp949"):
                    try:
                        out.append((data.decode(encoding), encoding))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append((data.decode("utf-8", "replace"), "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())], ["path", "text", "encoding"])

    return rows.where(F.col("path").rlike(kinds)).select(relative_path(F.col("path"), root).alias("path"), "content").mapInArrow(decode, "path string, text string, encoding string")


def _lines(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """(seq, value) of a small text file in order, without a byte-order mark; None where it is missing."""
    try:
        rows = spark.read.format("text").option("wholetext", True).load(path)
        return rows.select(F.posexplode(lines(F.regexp_replace("value", "^\ufeff", ""))).alias("seq", "value")).select(F.col("seq").cast("long").alias("seq"), "value")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def clean_cell(c: Column) -> Column:
    """Stripped, without a mark and without one pair of quotes."""
    c = strip(F.regexp_replace(strip(c), "^\ufeff+|\ufeff+$", ""))
    return strip(F.regexp_replace(c, r"""^(["'])([\s\S]*)\1$""", "$2"))


def csv_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """(seq, *names) of a CSV file with a header in any case or order; empty where the file is missing or empty."""
    none = spark.createDataFrame([], "seq long, " + ", ".join(f"{n} string" for n in names))
    try:
        rows = spark.read.csv(path, quote='"', escape='"', multiLine=True)  # so a cell may hold doubled quotes and newlines
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return none
    rows = rows.withColumn("seq", F.monotonically_increasing_id())  # a file that may hold newlines in cells is read by one task
    head = rows.where("seq = 0").first()
    if head is None:
        return none
    columns = [re.sub(r"""^["'\s\ufeff]+|["'\s\ufeff]+$""", "", head[c] or "").lower() for c in rows.columns if c != "seq"]
    return rows.where("seq > 0").select("seq", *((clean_cell(F.coalesce(F.col(rows.columns[columns.index(n)]), F.lit(""))) if n in columns else F.lit("")).alias(n) for n in names))


def replace_pairs(spark: SparkSession, path: str, dedupe: bool = False) -> DataFrame:
    return clean_pairs(csv_table(spark, path, ["wrong", "right"]), dedupe)


def terms(spark: SparkSession, *paths: str, least: int = 1) -> DataFrame:
    """(seq, term) of several files in order, each term once; a missing file has none."""
    found = None
    for k, path in enumerate(dict.fromkeys(paths)):
        part = csv_table(spark, path, ["term"]).withColumn("seq", F.col("seq") + (k << 40))
        found = part if found is None else found.unionByName(part)
    return clean_terms(found).where(F.length("term") >= least)


def stopwords(spark: SparkSession, path: str) -> DataFrame:
    """(word): one a line, # begins a comment."""
    rows = _lines(spark, path, "")
    if rows is None:
        return spark.createDataFrame([], "word string")
    return rows.select(strip(F.split_part("value", F.lit("#"), F.lit(1))).alias("word")).where("word <> ''").distinct()


def all_stopwords(spark: SparkSession, paths: list[str], fixed: Iterable[str] = ()) -> DataFrame:
    """(word): those of all files that exist, and fixed ones; each once."""
    out = spark.createDataFrame([(w,) for w in fixed], "word string")
    for path in paths:
        out = out.unionByName(stopwords(spark, path))
    return out.distinct()


def file_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(seq, path, wrong, right, note, glob_re) of JSON lines; bad JSON raises an error with its line."""
    rows = _lines(spark, path, "")
    if rows is None:
        return spark.createDataFrame([], "seq long, path string, wrong string, right string, note string, glob_re string")
    given = rows.select("seq", strip("value").alias("value")).where("value <> '' and not startswith(value, '#')")
    parsed = given.select("seq", "value", F.from_json("value", "path string, wrong string, right string, note string, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    wrong = F.concat(F.lit("invalid JSON at line "), (F.col("seq") + 1).cast("string"))
    field = lambda n: strip(F.coalesce(F.col(f"r.{n}"), F.lit("")))
    glob = F.when(F.col("r._bad").isNotNull(), F.raise_error(wrong).cast("string")).otherwise(F.replace(field("path"), F.lit("\\"), F.lit("/")))
    out = parsed.select("seq", glob.alias("path"), field("wrong").alias("wrong"), field("right").alias("right"), field("note").alias("note")).where("path <> '' and wrong <> '' and right <> '' and wrong <> right")
    globs = {r["path"]: glob_pattern(r["path"]) for r in out.select("path").distinct().collect()}
    pattern = F.create_map(*(F.lit(x) for kv in globs.items() for x in kv)) if globs else F.lit(None).cast("map<string,string>")
    return out.withColumn("glob_re", pattern[F.col("path")])


def write_csv(rows: DataFrame, path: str, names: list[str], mark: bool = True) -> None:
    """A rule table as one CSV file with a byte-order mark, in the order of seq."""
    quoted = lambda c: F.when(F.col(c).rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col(c))
    body = rows.select("seq", F.concat_ws(",", *(quoted(c) for c in names)).alias("value"))
    head = rows.sparkSession.createDataFrame([(("\ufeff" if mark else "") + ",".join(names),)], "value string")
    whole = head.select(F.lit(0).alias("side"), F.lit(None).cast(rows.schema["seq"].dataType).alias("seq"), "value").unionByName(body.withColumn("side", F.lit(1)))
    whole.coalesce(1).sortWithinPartitions("side", "seq").select("value").write.mode("overwrite").text(path)


def write_stopwords(words: DataFrame, path: str) -> None:
    words.where("trim(word) <> ''").distinct().coalesce(1).sortWithinPartitions("word").select("word").write.mode("overwrite").text(path)


def write_overrides(rows: DataFrame, path: str) -> None:
    out = F.to_json(F.struct("path", "wrong", "right", F.when(F.col("note") != "", F.col("note")).alias("note")))
    rows.coalesce(1).sortWithinPartitions("seq").select(out.alias("value")).write.mode("overwrite").text(path)


def write_texts(rows: DataFrame, path: str) -> None:
    """(path, text) keyed by output path, as Parquet; inputs are never written over."""
    rows.select("path", "text").write.mode("overwrite").parquet(path)


def write_files(rows: DataFrame, root: str, mark: bool = False) -> DataFrame:
    """(path, bytes) of (path, text), each text written as the UTF-8 file root/path, by the tasks that hold them.

    root is a folder that all executors share, by any address that pyarrow's file systems know.
    A file is written under a name of its own and then moved, so a task that runs again, or twice
    at once, leaves whole files only.  mark adds a byte-order mark; a null text gives an empty file.
    Nothing is written before the result is read, as with count().  Paths must stay below root.
    """

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (pafs.LocalFileSystem(), root)
        for batch in batches:
            sizes = []
            for path, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path.startswith("/") or ".." in path.split("/"):
                    raise ValueError(f"the path leaves its folder: {path}")
                data = (text or "").encode("utf-8-sig" if mark else "utf-8")
                to = f"{base.rstrip('/')}/{path}"
                part = f"{to}.{uuid.uuid4().hex}.part"
                fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(part) as out:
                    out.write(data)
                fs.move(part, to)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return rows.where("path is not null").select(F.col("path").cast("string"), F.col("text").cast("string")).mapInArrow(write, "path string, bytes long")


def write_summaries(rows: DataFrame, root: str, formats: tuple[str, ...] = ("md", "txt")) -> DataFrame:
    """(path, bytes) of summaries (path, text), written with a mark as root/<format>/<path>.<format>."""
    each = F.array(*(F.concat(F.lit(f"{f}/"), mirror(F.col("path"), f".{f}")) for f in formats))
    return write_files(rows.select(F.explode(each).alias("path"), "text"), root, mark=True)


def append_report(report: DataFrame, path: str, revision: str, stamp: datetime) -> None:
    """A run's report (path, n, line) as text below path, in a folder of its own; earlier runs stay as they are.

    The run begins with its revision and time; the blocks of documents follow by path, parted by
    blank lines.  A run written again takes the place of the same run.
    """
    body = report.groupBy("path").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]), "\n").alias("value"))
    head = report.sparkSession.createDataFrame([(f"[{revision} - {stamp.strftime('%Y-%m-%d %H:%M:%S')}]\n",)], "value string").select(F.lit(0).alias("side"), F.lit("").alias("path"), "value")
    whole = head.unionByName(body.select(F.lit(1).alias("side"), "path", F.concat("value", F.lit("\n")).alias("value")))
    whole.orderBy("side", "path").select("value").write.mode("overwrite").text(f"{path}/{stamp.strftime('%Y%m%d-%H%M%S')}")


def append_audit(rows: DataFrame, path: str, revision: str, stamp: datetime) -> None:
    """A run's audit rows, with the revision and time of the run, beside those of earlier runs.

    Each run has a folder of its own below path, which a run written again replaces; it counts once it is whole.
    """
    whole = rows.withColumn("revision", F.lit(revision)).withColumn("run_at", F.lit(stamp.strftime("%Y-%m-%d %H:%M:%S")))
    whole.write.mode("overwrite").parquet(f"{path}/run={stamp.strftime('%Y%m%d-%H%M%S')}")


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """Audit rows of all runs that were written whole, with the run's stamp as run."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [s.getPath().toString() for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run=*")) or []]
    done = [p for p in there if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS"))]
    if not done:
        raise FileNotFoundError(f"no whole run below {path}")
    return spark.read.option("basePath", path).schema("path string, stage string, ord long, wrong string, right string, applied long, skipped long, revision string, run_at string, run string").parquet(*done)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares (spark.checkpoint.dir); a local session may do without that."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        root = tempfile.mkdtemp(prefix="lectern-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_folder(agent: str, stamp: str) -> str:
    """Name of a run's folder: the agent and a YYYYMMDD-HHMMSS stamp, which is not added twice."""
    agent = agent.strip()
    if not agent:
        raise ValueError("the agent's name is empty")
    if re.search(r"__\d{8}-\d{6}$", agent):
        return agent
    if not STAMP.fullmatch(stamp):
        raise ValueError("a stamp has the form YYYYMMDD-HHMMSS")
    return f"{agent}__{stamp}"
