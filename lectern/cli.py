"""Command line: correct, candidates, review, refine and summary over whole folders.

    python -m lectern.cli correct --source ROOT --dict-dir DIR --output OUT [--topic T] [--rules FILE.json]

Inputs are never changed; every command writes below its output folder.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import batch, dictionary, mining, rewrite, search, segments, summary
from lectern.operators.rewrite import FamilyRule, RegexRule, Rules
from lectern.session import ship
from lectern.sources import files


def topic_rules(path: str | None, pairs: DataFrame, manual: list[tuple[str, str]] = ()) -> Rules:
    """Rules from dictionary pairs and a JSON file with a topic's tables.

    Keys of the file: forced, raw_priority and manual (lists of pairs), domain_keywords,
    pair_include and pair_exclude (lists of [wrong, right, words]), contextual and regexes
    (fields of RegexRule), families (fields of FamilyRule), compounds, stable, stable_regexes.
    """
    given = json.loads(Path(path).read_text(encoding="utf-8")) if path else {}
    two = lambda name: tuple(tuple(x) for x in given.get(name, ()))
    spark = pairs.sparkSession
    extra = spark.createDataFrame([(i, w, r) for i, (w, r) in enumerate((*manual, *two("manual")))], "seq long, wrong string, right string")
    rows = dictionary.assemble_rules(pairs, extra).orderBy("ord").collect()
    fields = lambda cls, name: tuple(cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in x.items()}) for x in given.get(name, ()))
    gates = lambda name: {(w, r): tuple(words) for w, r, words in given.get(name, ())}
    return Rules(
        literals=tuple((r["wrong"], r["right"]) for r in rows),
        bases={(r["wrong"], r["right"]): (r["base_wrong"], r["base_right"]) for r in rows},
        forced=frozenset(two("forced")),
        raw_priority=frozenset(two("raw_priority")),
        domain_keywords=tuple(given.get("domain_keywords", ())),
        pair_include=gates("pair_include"),
        pair_exclude=gates("pair_exclude"),
        contextual=fields(RegexRule, "contextual"),
        families=fields(FamilyRule, "families"),
        compounds=two("compounds"),
        regexes=fields(RegexRule, "regexes"),
        stable=two("stable"),
        stable_regexes=two("stable_regexes"),
        topic_rules=bool(given),
    )


def run_correct(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = batch.open_sources(files.text_files(spark, a.source), a.allow_finalised).withColumn("raw", batch.is_raw_source(F.lit(a.source), F.col("path")))
    pairs = dictionary.renumber(files.replace_pairs(spark, f"{a.dict_dir}/replace.csv"), ["seq"])
    overrides = [(r["glob_re"], r["wrong"], r["right"]) for r in files.file_overrides(spark, f"{a.dict_dir}/file_overrides.jsonl").orderBy("seq").collect()]
    terms = [r["term"] for r in files.terms(spark, f"{a.dict_dir}/terms.csv").orderBy("seq").collect()]
    batch.correct(docs, topic_rules(a.rules, pairs), overrides, "raw").write.mode("overwrite").parquet(f"{a.output}/corrected")
    done = spark.read.parquet(f"{a.output}/corrected")
    files.write_texts(done.select(F.regexp_replace("path", r"\.txt$", ".script.txt").alias("path"), F.col("script").alias("text")), f"{a.output}/script")
    batch.report(done, terms).write.mode("overwrite").parquet(f"{a.output}/report")
    now = datetime.now()
    files.append_audit(rewrite.audit(done), f"{a.output}/audit", a.revision, now)
    files.append_report(spark.read.parquet(f"{a.output}/report"), f"{a.output}/reports", a.revision, now)
    if a.text_files:
        named = lambda kind, text: done.where("status = 'done'").select(F.regexp_replace("path", r"\.txt$", f".{kind}.txt").alias("path"), F.col(text).alias("text"))
        files.write_files(named("corrected", "corrected").unionByName(named("script", "script")), f"{a.output}/files").count()


def run_candidates(spark: SparkSession, a: argparse.Namespace) -> None:
    scripts = files.text_files(spark, a.source, "*.script.txt")
    rows = segments.numbered_lines(scripts)
    pairs = files.replace_pairs(spark, f"{a.dict_dir}/replace.csv")
    none = spark.createDataFrame([], "seq long, wrong string, right string")
    hits = search.literal_hits(rows, search.literal_patterns(pairs, none)).unionByName(search.regex_hits(rows, a.regex))
    hits = hits.unionByName(search.override_hits(rows, files.file_overrides(spark, f"{a.dict_dir}/file_overrides.jsonl"))).distinct()
    if a.corrected:
        both = batch.pair_with_corrected(scripts, files.text_files(spark, a.corrected, "*.corrected.txt"))
        timed = segments.timed_entries(segments.numbered_lines(both.select("path", F.col("corrected").alias("text"))))
        hits = search.with_times(hits, search.align(rows, timed))
    else:
        hits = hits.withColumn("timestamp", F.lit(""))
    hits.write.mode("overwrite").json(f"{a.output}/hits")
    report = search.report_markdown(spark.read.json(f"{a.output}/hits", hits.schema), scripts.count())
    report.coalesce(1).write.mode("overwrite").text(f"{a.output}/report")


def run_review(spark: SparkSession, a: argparse.Namespace) -> None:
    scripts = files.text_files(spark, a.source, "*.script.txt")
    rows = scripts.select(F.replace("path", F.lit(".script.txt"), F.lit(".txt")).alias("path"), "text")
    marks = dictionary.parse_markers(segments.numbered_lines(rows))
    old = files.file_overrides(spark, f"{a.dict_dir}/file_overrides.jsonl").drop("glob_re")
    files.write_overrides(dictionary.upsert_overrides(old, marks, a.note), f"{a.output}/file_overrides")
    if a.clean_markers:
        files.write_files(batch.changed(dictionary.clean_texts(scripts)).select("path", F.col("corrected").alias("text")), f"{a.output}/scripts").count()


def run_refine(spark: SparkSession, a: argparse.Namespace) -> None:
    pairs = dictionary.renumber(files.replace_pairs(spark, f"{a.dict_dir}/replace.csv", dedupe=True), ["seq"])
    terms = dictionary.renumber(dictionary.term_seed(files.terms(spark, f"{a.dict_dir}/terms.csv"), pairs), ["seq"])
    rows = segments.text_lines(segments.transcript_lines(files.transcripts(spark, a.source, not a.no_srt)))
    known = [(r["wrong"], r["right"]) for r in pairs.orderBy("seq").collect()]
    once = rewrite.fold_lines(rows, known).drop("uses")
    found = mining.suggest_replacements(mining.token_counts(once), terms, pairs, a.min_wrong_freq, a.similarity_cutoff, a.max_new_replaces)
    found.write.mode("overwrite").parquet(f"{a.output}/replacements")
    new = [(r["wrong"], r["right"]) for r in spark.read.parquet(f"{a.output}/replacements").collect()]  # at most max_new_replaces
    twice = rewrite.fold_lines(once, new).drop("uses")
    mining.suggest_terms(mining.stem_counts(mining.token_counts(twice)), terms, a.min_term_freq, a.max_new_terms).write.mode("overwrite").parquet(f"{a.output}/terms")
    if not a.dry_run:
        twice.write.mode("overwrite").parquet(f"{a.output}/lines")


def run_summary(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = files.text_files(spark, a.source)
    terms = [r["term"] for r in files.terms(spark, f"{a.dict_dir}/terms.csv", least=2).collect()]
    folder = files.run_folder(a.agent_name, a.run_timestamp or datetime.now().strftime("%Y%m%d-%H%M%S"))
    summary.sections(docs, terms, a.max_theme_bullets).write.mode("overwrite").parquet(f"{a.output}/{folder}")
    if a.text_files:
        files.write_summaries(summary.study_texts(spark.read.parquet(f"{a.output}/{folder}")), f"{a.output}/{folder}-files").count()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lectern", description=__doc__.split("\n")[0])
    commands = p.add_subparsers(dest="command", required=True)
    for name, run in (("correct", run_correct), ("candidates", run_candidates), ("review", run_review), ("refine", run_refine), ("summary", run_summary)):
        c = commands.add_parser(name)
        c.set_defaults(run=run)
        for option in ("--source", "--dict-dir", "--output"):
            c.add_argument(option, required=True)
        if name == "correct":
            c.add_argument("--rules")
            c.add_argument("--revision", default="working-tree")
            c.add_argument("--allow-finalised", action="store_true")
        if name in ("correct", "summary"):
            c.add_argument("--text-files", action="store_true", help="also write a file for each text")
        if name == "candidates":
            c.add_argument("--corrected")
            c.add_argument("--regex", action="append", default=[])
        if name == "review":
            c.add_argument("--note", default="Imported from script review marker")
            c.add_argument("--clean-markers", action="store_true", help="write the scripts that have markers without them")
        if name == "refine":
            c.add_argument("--no-srt", action="store_true")
            c.add_argument("--dry-run", action="store_true")
            for option, default in (("--min-term-freq", 2), ("--min-wrong-freq", 1), ("--max-new-terms", 30), ("--max-new-replaces", 30)):
                c.add_argument(option, type=int, default=default)
            c.add_argument("--similarity-cutoff", type=float, default=0.78)
        if name == "summary":
            c.add_argument("--agent-name", default="local")
            c.add_argument("--run-timestamp", default="")
            c.add_argument("--max-theme-bullets", type=int, default=4)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lectern").getOrCreate()
    ship(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
