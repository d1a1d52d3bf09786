"""Greedy alignment in order of script lines with timed entries, for files of any length.

Each script line takes the next entry with its text after the entry that the line before took; after a
line without one, no line has any.  A walk would do that line by line.  Here every line starts from
a place that the walk cannot fall short of, and places are raised until none changes:

* a line that is the r-th of its text in the script stands at the r-th entry of its text or later, and the same
  holds from every earlier line of the text on: what that one was raised by, this one is raised by, too;
* a line stands after the furthest entry of all lines before it.

Places only grow and never pass those of the walk, so where they stay they are the walk's.  Both rules are
running maxima, which go over blocks of lines (running.py), so a long file is no one task's; it takes as many
rounds as lines with repeated texts wait for each other.  Each round is a table in the shared folder.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import running as blocks
from lectern.operators.running import running
from lectern.sources.files import work_folder

#: Stands for an entry that is not there.
NONE = 1 << 60


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """rows (path, key, line_no) with the number of each among those of its text."""
    return running(rows, ["path", "key"], "line_no", F.lit(1), name, inclusive=True)


def _raised(state: DataFrame, entries: DataFrame) -> DataFrame:
    """state (path, line_no, key, r, o) after one round; was is the o before."""
    there = entries.select("path", "key", F.col("k").alias("o"), F.col("line_no").alias("at"))
    placed = state.join(there, ["path", "key", "o"], "left").withColumn("at", F.coalesce("at", F.lit(NONE)))
    after = running(placed, ["path"], "line_no", F.col("at"), "furthest", how="max")
    after = after.withColumn("furthest", F.coalesce("furthest", F.lit(-1).cast("long")))
    late = after.where(F.col("at") <= F.col("furthest"))
    # the entries of a line's text up to the furthest place: entries and questions in one order
    asked = late.select("path", "key", F.col("furthest").alias("place"), F.lit(1).alias("question"), F.col("line_no"))
    told = entries.select("path", "key", F.col("line_no").cast("long").alias("place"), F.lit(0).alias("question"), "line_no")
    beyond = asked.where(F.col("place") >= NONE).select("path", "line_no", F.lit(NONE).alias("passed"))
    counted = running(told.unionByName(asked.where(F.col("place") < NONE)), ["path", "key"], "place", 1 - F.col("question"), "passed", ties=("question", "line_no"))
    passed = counted.where("question = 1").select("path", "line_no", "passed").unionByName(beyond)
    fresh = after.join(passed, ["path", "line_no"], "left").withColumn("p", F.greatest("o", F.coalesce("passed", F.lit(0)) + 1)).withColumnRenamed("o", "was")
    lifted = running(fresh, ["path", "key"], "line_no", F.col("p") - F.col("r"), "lift", how="max", inclusive=True)
    return lifted.select("path", "line_no", "key", "r", (F.col("r") + F.col("lift")).alias("o"), "was")


def _walk(batches):
    """Rows (path, script, line_no, key, timestamp) in order, those of entries before those of script lines: the script's times."""
    path, places, at, over = None, {}, -1, False
    for batch in batches:
        kept, times = [], []
        for i, (p, is_script, line, key, timestamp) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            if p != path:
                path, places, at, over = p, {}, -1, False
            if not is_script:
                lines, said = places.setdefault(key, ([], []))
                lines.append(line)
                said.append(timestamp)
                continue
            lines, said = places.get(key, ((), ()))
            k = len(lines) if over else bisect_right(lines, at)
            over = k == len(lines)
            kept.append(i)
            times.append("" if over else said[k] or "")
            at = at if over else lines[k]
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(2).take(rows), pa.array(times, pa.string())], ["path", "line_no", "timestamp"])


def greedy(script: DataFrame, corrected: DataFrame) -> DataFrame:
    """(path, line_no, timestamp) of script lines (path, line_no, text); corrected has (path, line_no, timestamp, text).

    A line without an entry has ''.  Lines of one path have different numbers; rows without a path are left out.
    """
    spark = script.sparkSession
    key = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("key")
    folder = work_folder(spark, "align")
    number = F.col("line_no").cast("long").alias("line_no")
    told = corrected.select("path", F.lit(False).alias("script"), number, key, F.col("timestamp").cast("string").alias("timestamp"))
    told.unionByName(script.select("path", F.lit(True).alias("script"), number, key, F.lit(None).cast("string").alias("timestamp"))).dropna(subset=["path", "line_no"]).write.parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    many = lines.where("NOT script").groupBy("path").count().where(F.col("count") > blocks.BLOCK).select("path")
    some = not many.isEmpty()
    short = lines.join(many, "path", "left_anti") if some else lines
    kind = lines.schema["path"].dataType.simpleString()
    walked = short.repartition("path").sortWithinPartitions("path", "script", "line_no").select("path", "script", "line_no", "key", "timestamp").mapInArrow(_walk, f"path {kind}, line_no long, timestamp string")
    walked = walked.withColumn("line_no", F.col("line_no").cast("int"))
    if not some:
        return walked
    long = lines.join(many, "path", "left_semi")
    return walked.unionByName(_by_rounds(long.where("script"), long.where("NOT script"), folder))


def _by_rounds(script: DataFrame, corrected: DataFrame, kept: str) -> DataFrame:
    spark = script.sparkSession

    def cut(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{kept}/{name}")
        return spark.read.parquet(f"{kept}/{name}")

    entries = cut(_numbered(corrected.select("path", "line_no", "key", "timestamp"), "k"), "entries")
    state = cut(_numbered(script.select("path", "line_no", "key"), "r").withColumn("o", F.col("r")), "round-0")
    rounds = 0
    while True:
        rounds += 1
        state = cut(_raised(state, entries), f"round-{rounds}")
        if state.where("o <> was").isEmpty():
            break
        state = state.drop("was")
    taken = entries.select("path", "key", F.col("k").alias("o"), "timestamp")
    return state.join(taken, ["path", "key", "o"], "left").select("path", F.col("line_no").cast("int").alias("line_no"), F.coalesce("timestamp", F.lit("")).alias("timestamp"))
