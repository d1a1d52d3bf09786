"""A training-data pipeline: quality, near-duplicates, decontamination, secrets, tokens.

Defined results: every stage judges rows, also those without an id; null and empty texts are
rejected by the quality stage; rows with one id and one text are one document from the second stage on;
extra columns, whatever their names, are kept up to the last stage; an empty table gives an empty result.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as Parquet and reread
as the next stage's docs.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, decontaminate, jaccard_join, quality, secrets
from lectern.llm.common import cut
from lectern.llm.queries import tokenizer_path
from lectern.session import ship

#: Near-duplicates: words of a shingle, and the similarity per hundred.
SHINGLE_WORDS, SIMILAR = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject, decided row by row; an id may be null or repeated."""
    ship(spark)
    return quality.passed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, one row: that with the smallest id, a null id last.

    A document is an id with a text, so texts under one id that are no near-duplicates all stay, as do
    texts without an id.  Of rows with one id and one text, that with the smallest hash of the row stays.
    """
    ship(spark)
    own = F.xxhash64(F.col("doc_id").cast("string"), "text").alias("__own")
    rows = docs.select(own, F.xxhash64(*docs.columns, F.lit(1)).alias("__hash"), F.struct(*docs.columns).alias("__row"))
    groups = jaccard_join.group(rows.select("__own", F.col("__row.text").alias("text")), size=SHINGLE_WORDS, per=SIMILAR, id_col="__own")
    narrow = rows.select("__own", "__hash", F.col("__row.doc_id").alias("id")).groupBy("__own").agg(F.min("__hash").alias("__hash"), F.min("id").alias("id"))
    named = narrow.join(groups.select(F.col("doc_id").alias("__own"), "component_id").distinct(), "__own")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "__own", "__hash")).alias("first")
    kept = cut(named.groupBy("component_id").agg(first).select("first.__own", "first.__hash"), "pipeline-kept")
    some = rows.join(kept, ["__own", "__hash"], "left_semi")
    repeated = cut(rows.groupBy("__own", "__hash").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "pipeline-repeated")
    alone = some.join(repeated, ["__own", "__hash"], "left_anti")
    one = some.join(repeated, ["__own", "__hash"], "left_semi").dropDuplicates(["__own", "__hash"])
    return alone.unionByName(one).select("__row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    ship(spark)
    model = secrets.train(secrets.labelled_samples(docs))
    redacted = secrets.redact(secrets.scan(docs, model))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted.select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of each document's token ids and decoded text."""
    ship(spark)
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL cannot express the language model, the Markov models or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder before the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs, f"pipeline-{k}")
    return docs
