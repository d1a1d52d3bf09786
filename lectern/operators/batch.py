"""Whole runs over many documents: which to take, what changed, and what is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import is_finalised, lines, strip
from lectern.operators import rewrite as rw
from lectern.operators import segments
from lectern.operators.rewrite import Rules


def is_raw_source(root: Column, path: Column) -> Column:
    """Whether a root is a raw folder (data/<any>/raw, in any case) and the path lies below it."""
    return F.lower(F.regexp_replace(root, r"[\\/]+$", "")).rlike(r"(^|[\\/])data[\\/][^\\/]+[\\/]raw$") & ~path.rlike(r"^(/|[A-Za-z]:|\.\.[\\/])")


def first_existing(spark: SparkSession, *roots: str) -> str:
    """The first root that exists, else the first one."""
    jvm = spark._jvm
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return root
    return roots[0]


def open_sources(docs: DataFrame, allow_finalised: bool = False) -> DataFrame:
    """Documents that may be rewritten; those in folders of finished work only if allowed."""
    return docs if allow_finalised else docs.where(~is_finalised(F.col("path")))


def first_files(docs: DataFrame, most: int) -> DataFrame:
    """The first files by path."""
    return docs.orderBy("path").limit(most)


def correct(docs: DataFrame, rules: Rules, overrides: list[tuple[str, str, str]] = (), raw_col: str | None = None) -> DataFrame:
    """(path, text, corrected, stats, status, message, script): one distributed pass; a failed document does not stop others."""
    done = rw.rewrite(docs, rules, overrides, raw_col=raw_col, keep_going=True)
    return done.withColumn("script", segments.script_text(F.col("corrected")))


def changed(corrected: DataFrame) -> DataFrame:
    """Only documents whose text changed."""
    return corrected.where("NOT (coalesce(text, '') <=> corrected)")


def pair_with_corrected(scripts: DataFrame, corrected: DataFrame) -> DataFrame:
    """(path, text, corrected_path, corrected): each script with its corrected text.

    A script without one raises an error when the result is read.
    """
    wanted = scripts.select("path", "text", F.regexp_replace("path", r"\.script\.txt$", ".corrected.txt").alias("corrected_path"))
    both = wanted.join(corrected.select(F.col("path").alias("corrected_path"), F.col("text").alias("corrected"), F.lit(True).alias("found")), "corrected_path", "left")
    missing = F.raise_error(F.concat(F.lit("no corrected file for "), "path")).cast("string")
    return both.select("path", "text", "corrected_path", F.when(F.col("found").isNull(), missing).otherwise(F.col("corrected")).alias("corrected"))


def report(corrected: DataFrame, terms: list[str]) -> DataFrame:
    """(path, n, line): the report of each document's change, in order."""
    m = rw.metrics(corrected)
    words = F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")
    more = corrected.select("path", "stats", F.size(F.filter(words, lambda t: F.contains("corrected", t))).alias("term_hits"), F.size(F.filter(lines(F.col("script")), lambda x: strip(x) != "")).alias("script_lines"))
    names = {
        "source": "path", "file_override_rules": "override_rules", "file_override_hits": "override_hits", "applied_rules": "applied_rules", "changed_chars": "changed_chars",
        "term_hits_after_correction": "term_hits", "script_lines_after_cleanup": "script_lines", "context_skipped_rules": "skipped_rules", "context_skipped_hits": "skipped_hits",
    }
    head = F.array(*(F.concat(F.lit(f"{k}: "), F.col(v).cast("string")) for k, v in names.items()))
    shown = lambda keep, n: F.transform(F.filter("stats", keep), lambda s: F.concat(s["wrong"], F.lit(" -> "), s["right"], F.lit(" (x"), s[n].cast("string"), F.lit(")")))
    part = lambda title, rows: F.when(F.size(rows) > 0, F.concat(F.array(F.lit(""), F.lit(f"[{title}]")), rows)).otherwise(F.array().cast("array<string>"))
    body = F.concat(
        head,
        part("file overrides applied", shown(lambda s: s["stage"] == "override", "applied")),
        part("applied replacements", shown(lambda s: (s["stage"] != "override") & (s["applied"] > 0), "applied")),
        part("skipped by context", shown(lambda s: s["skipped"] > 0, "skipped")),
    )
    return m.join(more, "path").select("path", F.posexplode(body).alias("n", "line"))


def manifest(concepts: DataFrame, course: str) -> DataFrame:
    """(path, json): a row for each draft, with its title, concepts and themes of two concepts.

    concepts has (path, n, concept).
    """
    rows = concepts.groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "concept"))), lambda x: x["concept"]).alias("concepts"))
    themes = F.transform(F.sequence(F.lit(0), F.floor((F.least(F.size("concepts"), F.lit(8)) - 1) / 2).cast("int")), lambda i: F.array_join(F.slice("concepts", i * 2 + 1, 2), ", "))
    title = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"(\.script)?\.[^.]+$", "")
    draft = F.regexp_replace("path", r"\.[^./]+$", ".md")
    return rows.select("path", F.to_json(F.struct(F.col("path").alias("source_script"), draft.alias("draft_md"), F.lit(course).alias("course"), title.alias("title"), "concepts", themes.alias("theme_focuses"), F.lit("draft-then-direct-rewrite").alias("workflow"))).alias("json"))

