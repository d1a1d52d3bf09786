"""Incremental runs: new files are rewritten as they come, with one snapshot of the rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.operators.rewrite import Rules, audit, rewrite


def new_documents(spark: SparkSession, path: str, schema: str = "path string, text string") -> DataFrame:
    """Documents that arrive below path as Parquet files."""
    return spark.readStream.schema(schema).parquet(path)


def rewrite_stream(docs: DataFrame, rules: Rules, out: str, checkpoint: str) -> StreamingQuery:
    """Rewrite what has arrived since the last run, then stop.

    Texts and audit rows of a batch go to folders named by the batch, so a batch that runs
    again replaces its own output.
    """

    def one(batch: DataFrame, number: int) -> None:
        done = rewrite(batch, rules)
        done.write.mode("overwrite").parquet(f"{out}/texts/batch={number}")
        kept = batch.sparkSession.read.parquet(f"{out}/texts/batch={number}")
        audit(kept).write.mode("overwrite").parquet(f"{out}/audit/batch={number}")

    return docs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def uncorrected(raw: DataFrame, corrected: DataFrame) -> DataFrame:
    """Raw documents (path) whose corrected text (path .corrected.txt) is missing."""
    wanted = raw.withColumn("__out", F.regexp_replace("path", r"\.txt$", ".corrected.txt"))
    return wanted.join(corrected.select(F.col("path").alias("__out")).distinct(), "__out", "left_anti").drop("__out")
