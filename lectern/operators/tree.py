"""Generation over documents as a tree of calls, level by level: chunks, merges of notes, final texts, repairs.

Each level is a table in a folder of the run, with a row for each call, keyed by path and group.  Its rows
are dealt over all tasks, so a document of many chunks is not one task's, and what a lost executor
had in hand is asked again for one level only.  A level that is written whole is not asked again when
the run is repeated: it is read.  A level that is not is written anew.

As in a walk through one document, the first call that fails decides what becomes of the document: a
used-up quota leaves a partial result of the notes before it, any other error a failed one.  Other
calls of the same level may have been made by then.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.generate import GROUP, is_quota, prompts_of, token_boost, with_retries
from lectern.operators.prompts import Prompts, partial

#: Calls that one task makes at least, one after the other, and the most tasks of a level.
CALLS_A_TASK, MOST_TASKS = 64, 10_000
#: Tasks of a level for each core: more end no sooner, and each costs a start, a file, and its reading by every later level.
TASKS_A_CORE = 8
#: What stands between the notes of a group.
GAP = "\n\n====\n\n"
_CALLS = "path string, idx int, of int, text string, failed string, quota boolean, whole boolean"


def _whole(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def _level(path: str, rows: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
    """The table of a level: read where it is whole, else made."""
    if not _whole(spark, path):
        rows().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def tasks_for(calls: int, cores: int) -> int:
    return min(MOST_TASKS, TASKS_A_CORE * max(1, cores), calls // CALLS_A_TASK + 1)


def _dealt(rows: DataFrame, calls: int) -> DataFrame:
    """Rows over as many tasks as their calls are worth, however few bytes they have."""
    return rows.repartition(tasks_for(calls, rows.sparkSession.sparkContext.defaultParallelism), "path", "idx")


def _asked(rows: DataFrame, request: Callable[..., tuple], client, system: str, tries: int, sleep, complete=None) -> DataFrame:
    """A call for each row of (path, idx, of, parts array<string>, terms array<string>): its text and whether it is complete, or how it failed."""

    def call(batches):
        for batch in batches:
            out = []
            for path, idx, of, parts, terms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    text = with_retries(lambda r=request(path, idx, of, parts, terms or []): client.call(system, *r), tries, sleep)
                    out.append((path, idx, of, text, None, None, bool(complete(text)) if complete else None))
                except Exception as e:
                    out.append((path, idx, of, None, str(e), is_quota(e), None))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["path", "idx", "of", "text", "failed", "quota", "whole"])

    return rows.select("path", "idx", "of", "parts", "terms").mapInArrow(call, _CALLS)


def _ordered(order: str, text: str) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text])


def grouped(notes: DataFrame, size: int) -> DataFrame:
    """(path, idx, of, parts): groups of consecutive notes (path, idx, of, text); the last may be smaller."""
    rows = notes.withColumn("place", F.col("idx"))
    rows = rows.groupBy("path", F.floor(F.col("place") / size).cast("int").alias("idx")).agg(F.max("of").alias("of"), _ordered("place", "text").alias("parts"))
    return rows.withColumn("of", F.ceil(F.col("of") / size).cast("int"))


def generate(docs: DataFrame, client, folder: str, prompts: Prompts | None = None, merge_limit: int = 40_000, complete: Callable[[str], bool] = bool, repairs: int = 3, base_tokens: int = 5_000, tries: int = 5, group: int = GROUP, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(path, status, stage, text) of documents (path, chunks array<string>, glossary array<string>).

    Every chunk becomes a note.  While a document's notes are too long together, they are merged in groups;
    the last call makes the result, repaired with more tokens while it is incomplete.  folder is one
    that all executors share; a run that names it again goes on where it ended.  Paths are distinct.
    Null chunks and glossaries are empty lists; a document without chunks makes its result of none.
    """
    spark, given = docs.sparkSession, prompts or prompts_of()
    system = given.system()
    ask = lambda rows, request, check=None: _asked(rows, request, client, system, tries, sleep, check)
    empty = F.array().cast("array<string>")
    names = _level(f"{folder}/documents", lambda: docs.select(F.col("path").cast("string").alias("path"), F.coalesce("chunks", empty).alias("chunks"), F.coalesce("glossary", empty).alias("terms")), spark)
    terms = names.select("path", "terms")

    count = names.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("chunks")), F.lit(0)).alias("chunks")).first()
    chunks = names.select("path", "terms", F.size("chunks").alias("of"), F.posexplode("chunks").alias("idx", "part")).withColumn("parts", F.array("part"))
    notes = _level(f"{folder}/level=0", lambda: ask(_dealt(chunks, count["chunks"]), lambda path, idx, of, parts, terms: (given.chunk(path, idx + 1, of, parts[0], terms),)), spark)
    levels, bad = [notes], [_failures(notes, 0, "chunk")]
    body = notes
    while True:
        k = len(levels)
        fine = body.join(_stopped(bad), "path", "left_anti")
        sizes = fine.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
        long = sizes.where((F.col("n") > 1) & (F.col("chars") > merge_limit))
        calls = long.agg(F.sum(F.ceil(F.col("n") / group))).first()[0]
        if not calls:
            break
        rows = lambda fine=fine, long=long, calls=calls: _dealt(grouped(fine.join(long, "path", "left_semi"), group).join(terms, "path"), calls)
        merged = _level(f"{folder}/level={k}", lambda rows=rows: ask(rows(), lambda path, idx, of, parts, terms: (given.merge(path, idx + 1, of, parts, terms),)), spark)
        levels.append(merged)
        bad.append(_failures(merged, k, "merge"))
        body = body.join(merged.select("path").distinct(), "path", "left_anti").unionByName(merged)
    fine = body.join(_stopped(bad), "path", "left_anti")
    bodies = names.select("path", "terms").join(_stopped(bad), "path", "left_anti").join(fine.groupBy("path").agg(_ordered("idx", "text").alias("parts")), "path", "left")
    bodies = bodies.select("path", F.lit(0).alias("idx"), F.lit(1).alias("of"), F.coalesce("parts", empty).alias("parts"), "terms")
    final = _level(f"{folder}/final", lambda: ask(_dealt(bodies, count["docs"]), lambda path, idx, of, parts, terms: (given.final(path, parts, terms),), complete), spark)
    last, made = final, [(final, "final")]
    for attempt in range(repairs):
        stage = f"repair {attempt + 1}/{repairs}"
        broken = last.where("NOT whole").select("path", F.col("text").alias("old"))
        calls = broken.count()
        if not calls:
            break
        rows = bodies.join(broken, "path").withColumn("parts", F.concat(F.array("old"), "parts"))
        boost = token_boost(base_tokens, attempt)
        again = _level(f"{folder}/{stage.split('/')[0].replace(' ', '-')}", lambda rows=rows, boost=boost, calls=calls: ask(_dealt(rows, calls), lambda path, idx, of, parts, terms: (given.repair(path, parts[1:], terms, parts[0]), boost), complete), spark)
        made.append((again, stage))
        last = last.join(again.select("path"), "path", "left_anti").unionByName(again)
    stages = made[0][0].select("path", F.lit("final").alias("stage"), "text", "failed", "quota", "whole", F.lit(0).alias("n"))
    for n, (table, stage) in enumerate(made[1:], 1):
        stages = stages.unionByName(table.select("path", F.lit(stage).alias("stage"), "text", "failed", "quota", "whole", F.lit(n).alias("n")))
    ends = stages.groupBy("path").agg(F.max_by(F.struct("stage", "text", "failed", "quota", "whole"), "n").alias("x"), F.max_by("text", F.when(F.col("text").isNotNull(), F.col("n"))).alias("draft")).select("path", "x.*", "draft")
    done = ends.where("failed IS NULL")
    whole = F.col("whole")
    ok = done.select("path", F.when(whole, "done").otherwise("failed").alias("status"), "stage", F.when(whole, F.col("text")).otherwise("output is incomplete after repairs").alias("text"))
    early = bad[0]
    for b in bad[1:]:
        early = early.unionByName(b)
    early = early.withColumn("draft", F.lit(""))
    late = ends.where("failed IS NOT NULL").select("path", F.lit(len(levels)).alias("level"), "stage", "failed", "quota", F.lit(None).cast("int").alias("idx"), F.coalesce("draft", F.lit("")).alias("draft"))
    return ok.unionByName(_ended(early.unionByName(late.select(*early.columns)), levels))


def _failures(notes: DataFrame, level: int, kind: str) -> DataFrame:
    """(path, level, stage, failed, quota, idx): the first failed call of each path at a level."""
    rows = notes.where("failed IS NOT NULL").groupBy("path").agg(F.min_by(F.struct("idx", "of", "failed", "quota"), "idx").alias("x"))
    stage = F.concat(F.lit(f"{kind} "), (F.col("x.idx") + 1).cast("string"), F.lit("/"), F.col("x.of").cast("string"))
    return rows.select("path", F.lit(level).alias("level"), stage.alias("stage"), "x.failed", "x.quota", "x.idx")


def _stopped(bad: list[DataFrame]) -> DataFrame:
    out = bad[0].select("path")
    for b in bad[1:]:
        out = out.unionByName(b.select("path"))
    return out


def _ended(stopped: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Failed and partial rows; a partial result has the notes that there were before the call that failed."""
    before = None
    for k, table in enumerate(levels):
        some = table.where("text IS NOT NULL").select("path", F.lit(k).alias("of_level"), F.col("idx").alias("place"), "text")
        before = some if before is None else before.unionByName(some)
    quota = stopped.where("quota")
    had = before.join(quota.select("path", "level", F.col("idx").alias("at")), "path")
    had = had.where((F.col("of_level") < F.col("level")) | ((F.col("of_level") == F.col("level")) & (F.col("place") < F.col("at"))))
    notes = had.where("of_level = 0").groupBy("path").agg(_ordered("place", "text").alias("notes"))
    top = had.where("of_level > 0").groupBy("path").agg(F.max("of_level").alias("of_level"))
    merged = had.join(top, ["path", "of_level"]).groupBy("path").agg(_ordered("place", "text").alias("merged"))
    rows = quota.join(notes, "path", "left").join(merged, "path", "left")
    said = F.udf(lambda stage, error, text, merged, notes: partial(stage, error, text, merged or [], notes or []), "string", useArrow=True)
    left = rows.select("path", F.lit("partial").alias("status"), "stage", said("stage", "failed", "draft", "merged", "notes").alias("text"))
    return left.unionByName(stopped.where("NOT quota").select("path", F.lit("failed").alias("status"), "stage", F.col("failed").alias("text")))
