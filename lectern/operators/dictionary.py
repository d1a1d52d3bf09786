"""Dictionary algebra: ordered rule tables with an explicit seq column.

Pairs are (seq, wrong, right), terms (seq, term), overrides (seq, path, wrong, right, note).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.particles import expand_pairs
from lectern.functions.text import has_hangul, is_auto_pair, let, lines, strip

# Grammatical tails in the order in which one is peeled, and endings that reject a term.
TAILS = (
    "으로는", "로는", "이라면", "라면", "다면은", "다면", "에는", "에서", "으로", "하다", "했다", "하는", "하게", "하며", "하면",
    "하죠", "해요", "입니다", "이다", "라고", "하고", "이며", "에게", "부터", "까지", "처럼", "다", "께서", "께",
    "의", "를", "을", "은", "는", "이", "가", "에", "도", "만", "와", "과",
)
REJECT = ("다면", "한다", "했다", "해요", "하고", "가면", "해질", "하는", "한")
MARKER = r"^\s*@@\s*override\s*:\s*(.+?)\s*=>\s*(.+?)\s*$"


def first_by(rows: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__n = 1").drop("__n")


def union_first(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered union of two tables without repeated keys; seq counts the rows from 0, those of the first table before."""
    both = first.withColumn("__side", F.lit(0)).unionByName(second.withColumn("__side", F.lit(1)))
    kept = both.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__side", "seq"))).where("__n = 1")
    return renumber(kept, ["__side", "seq"]).drop("__side", "__n")


def renumber(rows: DataFrame, order: list) -> DataFrame:
    """seq counted from 0 in the given order; for rule tables, which one task can sort."""
    return rows.withColumn("seq", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def difference(updated: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of updated with a key that baseline lacks; repeated rows stay."""
    return updated.join(baseline.select(*keys).distinct(), keys, "left_anti")


def clean_pairs(pairs: DataFrame, dedupe: bool = False) -> DataFrame:
    """Stripped pairs whose sides are there and differ."""
    rows = pairs.select("seq", strip(F.coalesce("wrong", F.lit(""))).alias("wrong"), strip(F.coalesce("right", F.lit(""))).alias("right")).where("wrong <> '' and right <> '' and wrong <> right")
    return first_by(rows, ["wrong", "right"]) if dedupe else rows


def clean_terms(terms: DataFrame) -> DataFrame:
    return first_by(terms.select("seq", strip(F.coalesce("term", F.lit(""))).alias("term")).where("term <> ''"), ["term"])


def assemble_rules(pairs: DataFrame, manual: DataFrame) -> DataFrame:
    """Rules in the order of application: expanded pairs, then manual ones, longest wrong first.

    (ord, wrong, right, base_wrong, base_right); a pair met twice keeps its first place, and
    rules of equal length keep their order.
    """
    expanded = expand_pairs(pairs).withColumn("part", F.lit(0))
    extra = manual.select(F.col("seq").alias("ord"), "wrong", "right", F.col("wrong").alias("base_wrong"), F.col("right").alias("base_right"), F.lit(1).alias("part"))
    both = expanded.unionByName(extra).withColumn("place", F.struct("part", "ord"))
    kept = first_by(both, ["wrong", "right"], "place")
    rank = F.row_number().over(Window.orderBy(F.length("wrong").desc(), "place")) - 1
    return kept.select(rank.cast("long").alias("ord"), "wrong", "right", "base_wrong", "base_right")


def parse_markers(rows: DataFrame) -> DataFrame:
    """Lines (path, line_no, text) that hold override markers: (path, line_no, wrong, right).

    A marker without two different sides raises an error when the result is read.
    """
    got = rows.where(F.col("text").rlike(MARKER)).select("path", "line_no", strip(F.regexp_extract("text", MARKER, 1)).alias("wrong"), strip(F.regexp_extract("text", MARKER, 2)).alias("right"), "text")
    bad = (F.col("wrong") == "") | (F.col("right") == "") | (F.col("wrong") == F.col("right"))
    checked = F.when(bad, F.raise_error(F.concat(F.lit("invalid override marker: "), F.col("text"))).cast("string")).otherwise(F.col("wrong"))
    return got.select("path", "line_no", checked.alias("wrong"), "right")


def without_markers(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col("text").rlike(MARKER))


def clean_texts(docs: DataFrame) -> DataFrame:
    """(path, text, corrected): texts without the lines that hold markers; a text without markers stays as it is."""
    all_lines = lines(F.col("text"))
    kept = F.filter(all_lines, lambda x: ~x.rlike(MARKER))
    joined = F.when(F.size(kept) > 0, F.concat(F.array_join(kept, "\n"), F.lit("\n"))).otherwise("")
    return docs.select("path", "text", F.when(F.size(kept) < F.size(all_lines), joined).otherwise(F.col("text")).alias("corrected"))


def upsert_overrides(existing: DataFrame, markers: DataFrame, note: str) -> DataFrame:
    """Last right wins for each (path, wrong), at the place where the pair first stood.

    existing (seq, path, wrong, right, note), markers (path, line_no, wrong, right); adds action:
    added, updated, unchanged or kept.
    """
    old = existing.select("path", "wrong", "right", "note", F.struct(F.lit(0), "seq").alias("place"))
    new = markers.select("path", "wrong", "right", F.lit(note).alias("note"), F.struct(F.lit(1), F.col("line_no").cast("long").alias("seq")).alias("place"))
    both = old.withColumn("is_new", F.lit(0)).unionByName(new.withColumn("is_new", F.lit(1)))
    last = lambda c: F.max_by(c, "place").alias(c)
    merged = both.groupBy("path", "wrong").agg(F.min("place").alias("seq"), last("right"), last("note"), F.min("is_new").alias("fresh"), F.max("is_new").alias("touched"), F.min_by(F.struct("right", "note"), "place").alias("was"))
    same = (F.col("was.right") == F.col("right")) & (F.col("was.note") == F.col("note"))
    action = F.when(F.col("fresh") == 1, "added").when(F.col("touched") == 0, "kept").when(same, "unchanged").otherwise("updated")
    return merged.select("seq", "path", "wrong", "right", "note", action.alias("action"))


def normalise_term(term: Column, stopwords: Column) -> Column:
    """A term fit for a dictionary, with one tail peeled, or the empty string."""
    def peeled(c: Column) -> Column:
        out = F.when(F.lit(False), c)
        for tail in TAILS:
            out = out.when(c.endswith(tail) & (F.length(c) - len(tail) >= 2), F.substring(c, F.lit(1), F.length(c) - len(tail)))
        return out.otherwise(c)

    def fit(c: Column) -> Column:
        rejected = F.array_contains(stopwords, c) | F.contains(c, F.lit(" ")) | ~has_hangul(c)
        fits = lambda p: ~p.rlike(f"({'|'.join(REJECT)})$") & ~F.array_contains(stopwords, p) & F.length(p).between(2, 20) & has_hangul(p)
        return F.when(rejected, "").otherwise(let(peeled(c), lambda p: F.when(fits(p), p).otherwise("")))

    return let(strip(term), fit)


def grow_pairs(existing: DataFrame, applied: DataFrame) -> DataFrame:
    """Pairs that application adds: applied has (ord, base_wrong, base_right); result (seq, wrong, right)."""
    fresh = applied.select(F.col("ord").alias("seq"), F.col("base_wrong").alias("wrong"), F.col("base_right").alias("right")).where(is_auto_pair(F.col("wrong"), F.col("right")))
    return difference(first_by(fresh, ["wrong", "right"]), existing, ["wrong", "right"])


def grow_terms(existing: DataFrame, applied: DataFrame, stopwords: list[str]) -> DataFrame:
    """Terms that application adds: applied has (ord, right); result (seq, term)."""
    words = F.array(*map(F.lit, stopwords)).cast("array<string>")
    fresh = applied.select(F.col("ord").alias("seq"), normalise_term(F.col("right"), words).alias("term")).where("term <> ''")
    return difference(first_by(fresh, ["term"]), existing, ["term"])


def term_seed(terms: DataFrame, pairs: DataFrame) -> DataFrame:
    """Terms and the one-word right sides of pairs, in order, each once."""
    rights = pairs.where(~F.contains("right", F.lit(" "))).select("seq", F.col("right").alias("term"))
    return union_first(terms.select("seq", "term"), rights, ["term"])
