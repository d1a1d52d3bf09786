"""Residual search: lines that still hold known-wrong patterns, with the time they were said."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.align import greedy
from lectern.sources.files import work_folder

#: Up to so many patterns are compared with every line; an automaton holds up to MOST_PATTERNS at once.
FEW_PATTERNS, MOST_PATTERNS = 64, 200_000
#: Groups of hits that every task of a report holds at most, and the share of hits from which one of more groups is held.
FEW_GROUPS, HOT_SHARE = 10_000, 64


def literal_patterns(pairs: DataFrame, manual: DataFrame) -> DataFrame:
    """(ord, pattern): wrong sides of pairs, then of manual pairs, each once, longest first."""
    both = pairs.select(F.lit(0).alias("part"), "seq", F.col("wrong").alias("pattern")).union(manual.select(F.lit(1), "seq", "wrong")).where("pattern <> ''")
    kept = both.groupBy("pattern").agg(F.min(F.struct("part", "seq")).alias("place"))
    return kept.select((F.row_number().over(Window.orderBy(F.length("pattern").desc(), "place")) - 1).alias("ord"), "pattern")


def _automaton(patterns):
    import ahocorasick

    found = ahocorasick.Automaton()
    for p in patterns:
        found.add_word(p, p)
    found.make_automaton()
    return found


def _match(told):
    def rows(batches):
        automaton = _automaton(told.value)
        for batch in batches:
            at, patterns = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = sorted({p for _, p in automaton.iter(text)}) if text else []
                at += [i] * len(own)
                patterns += own
            keep = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(keep) for c in batch.columns), pa.array(patterns, pa.string())], [*batch.schema.names, "pattern"])

    return rows


def literal_hits(lines: DataFrame, patterns: DataFrame) -> DataFrame:
    """(path, line_no, text, pattern): one hit a line and pattern, however often it occurs.

    A few patterns are compared with every line inside the JVM.  Beyond FEW_PATTERNS each line
    passes once through an automaton of all patterns, so time does not grow with their number;
    a table beyond MOST_PATTERNS goes in parts, each of a proven size.
    """
    rows = patterns.select("pattern").where("pattern <> ''").distinct()
    count = rows.count()
    lines = lines.select("path", "line_no", "text")
    if count <= FEW_PATTERNS:
        part = F.broadcast(rows)
        found = lines.join(part, F.contains(lines["text"], part["pattern"]))
    else:
        found, parts = None, count // MOST_PATTERNS + 1
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema) + ", pattern string"
        for k in range(parts):
            own = [r["pattern"] for r in rows.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == k).toLocalIterator()]
            one = lines.mapInArrow(_match(lines.sparkSession.sparkContext.broadcast(own)), schema)
            found = one if found is None else found.unionByName(one)
    return found.select("path", "line_no", "text", "pattern", F.lit("literal").alias("match_kind"))


def with_terms(docs: DataFrame, terms: list[str], text_col: str = "text", name: str = "found") -> DataFrame:
    """docs with an array of the terms that a text contains, in the order given.

    As with literal_hits(), many terms are found in one pass; more than MOST_PATTERNS are refused.
    """
    terms = list(dict.fromkeys(t for t in terms if t))
    if len(terms) > MOST_PATTERNS:
        raise ValueError(f"over {MOST_PATTERNS} terms: take them in parts")
    if len(terms) <= FEW_PATTERNS:
        table = F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")
        return docs.withColumn(name, F.filter(table, lambda t: F.contains(F.col(text_col), t)))
    told, at = docs.sparkSession.sparkContext.broadcast(terms), docs.columns.index(text_col)

    def rows(batches):
        automaton, place = _automaton(told.value), {t: i for i, t in enumerate(told.value)}
        for batch in batches:
            found = [sorted({p for _, p in automaton.iter(t)}, key=place.__getitem__) if t else [] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.string()))], [*batch.schema.names, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(rows, f"{schema}, `{name}` array<string>")


def regex_hits(lines: DataFrame, patterns: list[str]) -> DataFrame:
    """The same for regular expressions, which users give by hand."""
    tests = F.array(*(F.when(F.col("text").rlike(p), F.lit(p)) for p in patterns)) if patterns else F.array().cast("array<string>")
    return lines.select("path", "line_no", "text", F.explode(F.array_compact(tests)).alias("pattern"), F.lit("regex").alias("match_kind"))


def override_hits(lines: DataFrame, overrides: DataFrame) -> DataFrame:
    """Hits of overrides (glob_re, wrong) in the lines of files that their path pattern names."""
    paths = lines.select("path").distinct()
    given = overrides.select("glob_re", F.col("wrong").alias("pattern")).distinct()
    parts = given.count() // MOST_PATTERNS + 1
    named = None
    for k in range(parts):
        some = F.broadcast(given.where(F.pmod(F.xxhash64("glob_re", "pattern"), F.lit(parts)) == k))  # about MOST_PATTERNS rows
        found = paths.join(some, F.expr("rlike(replace(path, '.script.txt', '.txt'), glob_re)")).select("path", "pattern")
        named = found if named is None else named.unionByName(found)
    named = named.distinct()
    rows = lines.join(named, "path").where(F.contains("text", F.col("pattern")))
    return rows.select("path", "line_no", "text", "pattern", F.lit("literal").alias("match_kind"))


def group_hits(hits: DataFrame) -> DataFrame:
    """(match_kind, pattern, n_hits, n_files), most files first, then most hits."""
    rows = hits.groupBy("match_kind", "pattern").agg(F.count("*").alias("n_hits"), F.countDistinct("path").alias("n_files"))
    return rows.orderBy(F.desc("n_files"), F.desc("n_hits"), "match_kind", "pattern")


def totals(hits: DataFrame, files: DataFrame) -> DataFrame:
    """One row: files scanned (hit or not), groups and hits."""
    scanned = files.agg(F.countDistinct("path").alias("files_scanned"))
    return scanned.crossJoin(hits.agg(F.count("*").alias("total_hits"), F.countDistinct("match_kind", "pattern").alias("unique_groups")))


def align(script: DataFrame, corrected: DataFrame) -> DataFrame:
    """(path, line_no, timestamp) of script lines (path, line_no, text), by a greedy merge in order.

    corrected has (path, line_no, timestamp, text).  Either table is computed once.
    """
    return greedy(script, corrected)


def with_times(hits: DataFrame, times: DataFrame) -> DataFrame:
    """Hits with their line's time, '' where there is none."""
    return hits.join(times, ["path", "line_no"], "left").withColumn("timestamp", F.coalesce("timestamp", F.lit("")))


def _with_groups(hits: DataFrame, groups: DataFrame, count: int, total: int) -> DataFrame:
    """Hits with their group's n and files; no group's hits are dealt to one task.

    Up to FEW_GROUPS groups are held by every task; of more, those that have a share of hits of over 1/64.
    """
    by = ["match_kind", "pattern"]
    if count <= FEW_GROUPS:
        return hits.join(F.broadcast(groups), by)
    large = F.col("n") * HOT_SHARE > total  # fewer than HOT_SHARE groups
    rest = hits.join(F.broadcast(groups.where(large).select(*by)), by, "left_anti").join(groups.where(~large), by)
    return hits.join(F.broadcast(groups.where(large)), by).unionByName(rest)


def report_markdown(hits: DataFrame, files_scanned: int) -> DataFrame:
    """(ord, line): the lines of a report in order; hits have (match_kind, pattern, path, line_no, timestamp, text).

    Lines are sorted by their place, so no group of hits is gathered in one row.  Hits are found
    once, for a table that all lines are made of.
    """
    spark = hits.sparkSession
    table = work_folder(spark, "report")
    hits.select("match_kind", "pattern", "path", "line_no", "timestamp", "text").write.parquet(f"{table}/hits")
    hits = spark.read.parquet(f"{table}/hits")
    hits.groupBy("match_kind", "pattern").agg(F.count("*").alias("n"), F.countDistinct("path").alias("files")).write.parquet(f"{table}/groups")
    groups = spark.read.parquet(f"{table}/groups")
    key = F.struct((-F.col("files")).alias("a"), (-F.col("n")).alias("b"), F.col("match_kind").alias("c"), F.col("pattern").alias("d"))
    count, total = groups.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    head = ["# Suspicious Transcript Candidates", "", f"- files_scanned: {files_scanned}", f"- unique_groups: {count}", f"- total_hits: {total}", "", *([] if count else ["No suspicious candidates found."])]
    first = spark.createDataFrame(list(enumerate(head)), "i int, line string").select(F.lit(None).cast("struct<a:bigint,b:bigint,c:string,d:string>").alias("g"), F.lit("").alias("path"), "i", "line")
    top = F.array(F.concat(F.lit("## "), "pattern"), F.lit(""), F.concat(F.lit("- kind: "), "match_kind"), F.concat(F.lit("- hits: "), F.col("n").cast("string")), F.concat(F.lit("- files: "), F.col("files").cast("string")), F.lit(""))
    titles = groups.select(key.alias("g"), F.lit("").alias("path"), F.posexplode(top).alias("i", "line")).withColumn("i", F.col("i") - 10)
    shown = F.concat(F.lit("- "), "path", F.lit(":"), F.col("line_no").cast("string"), F.lit(" ["), F.when(F.col("timestamp") == "", "--:--").otherwise(F.col("timestamp")), F.lit("] "), "text")
    rows = _with_groups(hits, groups, count, total).select(key.alias("g"), "path", F.col("line_no").cast("int").alias("i"), shown.alias("line"))
    gaps = groups.select(key.alias("g"), F.lit("\U0010ffff").alias("path"), F.lit(0).alias("i"), F.lit("").alias("line"))
    return first.unionByName(titles).unionByName(rows).unionByName(gaps).orderBy(F.asc_nulls_first("g"), "path", "i").select("line")
