"""Segmentation: lines, script-only text, subtitles, sentences and packed chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import is_srt_text, is_timestamp_line, lines, sentences, squeeze, srt_time, strip, timestamp_of


def numbered_lines(docs: DataFrame, path_col: str = "path", text_col: str = "text", blank: bool = False) -> DataFrame:
    """(path, line_no, text): stripped lines numbered from 1, blank ones dropped after numbering."""
    rows = docs.select(F.col(path_col).alias("path"), F.posexplode(lines(F.col(text_col))).alias("at", "raw"))
    out = rows.select("path", (F.col("at") + 1).alias("line_no"), strip("raw").alias("text"))
    return out if blank else out.where("text <> ''")


def transcript_lines(docs: DataFrame) -> DataFrame:
    """(path, line_no, text, is_srt) of files (path, text), lines as they are; an empty file has one empty line."""
    own = lines(F.coalesce("text", F.lit("")))
    rows = docs.select("path", F.posexplode(F.when(F.size(own) > 0, own).otherwise(F.array(F.lit("")))).alias("at", "text"))
    return rows.select("path", (F.col("at") + 1).alias("line_no"), "text", F.lower("path").endswith(".srt").alias("is_srt"))


def text_lines(transcript: DataFrame) -> DataFrame:
    """Lines that hold text: all of plain files, and those of subtitles that are not frame."""
    return transcript.where(~F.col("is_srt") | is_srt_text(F.col("text")))


def timed_entries(lines_: DataFrame) -> DataFrame:
    """(path, line_no, timestamp, text): text lines with the last time label before them, or ''."""
    before = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = lines_.withColumn("label", timestamp_of(F.col("text")))
    rows = rows.withColumn("timestamp", F.coalesce(F.last_value("label", ignoreNulls=True).over(before), F.lit("")))
    return rows.where("label IS NULL AND text <> ''").select("path", "line_no", "timestamp", "text")


def script_text(text: Column) -> Column:
    """Text without timestamp lines; blank runs shrink to one line, none at either end.

    One fold over the lines of a document, in the JVM.
    """
    kept = F.filter(F.transform(lines(text), strip), lambda x: ~is_timestamp_line(x))
    step = lambda a, x: F.when((x == "") & ((F.size(a) == 0) | (F.element_at(F.concat(F.array(F.lit("")), a), -1) == "")), a).otherwise(F.array_append(a, x))
    packed = F.aggregate(kept, F.array().cast("array<string>"), step)
    joined = F.regexp_replace(F.array_join(packed, "\n"), "\n+$", "")
    return F.when(joined == "", "").otherwise(F.concat(joined, F.lit("\n")))


#: Signs that end a sentence.
ENDS = ".!?。！？"


def sentence_list(text: Column, ends: str = ENDS, least: int = 1) -> Column:
    """Sentences of stripped lines, of `least` characters or more, in their order."""
    return F.flatten(F.transform(F.filter(F.transform(lines(text), strip), lambda x: x != ""), lambda x: sentences(x, ends, least)))


def sentence_rows(docs: DataFrame, path_col: str = "path", text_col: str = "text", ends: str = ENDS, least: int = 1) -> DataFrame:
    """(path, pos, sentence): the sentences of each text, numbered from 0."""
    return docs.select(F.col(path_col).alias("path"), F.posexplode(sentence_list(F.col(text_col), ends, least)).alias("pos", "sentence"))


def srt(segments: DataFrame) -> DataFrame:
    """(path, idx, block) of (path, start, end, text): numbered subtitle blocks of segments with text."""
    rows = segments.withColumn("text", F.regexp_replace(strip("text"), r"\s+", " ")).where("text <> ''")
    idx = F.row_number().over(Window.partitionBy("path").orderBy("start", "end", "text"))
    block = F.concat(idx.cast("string"), F.lit("\n"), srt_time(F.col("start")), F.lit(" --> "), srt_time(F.col("end")), F.lit("\n"), F.col("text"), F.lit("\n"))
    return rows.select("path", idx.alias("idx"), block.alias("block"))


def srt_files(segments: DataFrame) -> DataFrame:
    """(path, text): the subtitle file of each path of (path, start, end, text)."""
    rows = srt(segments).groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("idx", "block"))), lambda x: x["block"]).alias("b"))
    return rows.select("path", F.array_join("b", "\n").alias("text"))


def txt_files(segments: DataFrame) -> DataFrame:
    """(path, text): the texts of each path's segments in order of time, one a line, without empty ones."""
    rows = segments.select("path", "start", "end", squeeze(F.coalesce("text", F.lit(""))).alias("text")).groupBy("path")
    rows = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("start", "end", "text"))), lambda x: x["text"]).alias("t"))
    return rows.select("path", F.concat(F.array_join(F.filter("t", lambda x: x != ""), "\n"), F.lit("\n")).alias("text"))


def _pieces(text: Column, most: int) -> Column:
    """What is packed: (piece, cost of its separator), paragraphs whole if they fit, else sentences, else cuts."""
    cuts = lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.length(s) - 1) / most).cast("int")), lambda i: F.substring(s, i * most + 1, F.lit(most)))
    priced = lambda xs, n: F.transform(xs, lambda x: F.struct(x.alias("s"), F.lit(n).alias("gap")))
    paragraphs = F.filter(F.transform(F.split(text, "\n\n", -1), strip), lambda p: p != "")
    small = lambda p: priced(F.array(p), 2)
    large = lambda p: priced(F.flatten(F.transform(sentences(p), cuts)), 1)
    return F.flatten(F.transform(paragraphs, lambda p: F.when(F.length(p) <= most, small(p)).otherwise(large(p))))


def chunks(text: Column, most: int) -> Column:
    """Text packed greedily into chunks of about `most` characters, joined by blank lines.

    A piece costs its length and its separator unless it opens a chunk after another; text
    without paragraphs is one chunk, empty text none.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), empty.alias("open"), F.lit(0).alias("n"))

    def step(a: Column, x: Column) -> Column:
        size = F.length(x["s"])
        fits = a["n"] + size + x["gap"] <= most
        closed = F.when(F.size(a["open"]) > 0, F.array_append(a["done"], F.array_join(a["open"], "\n\n"))).otherwise(a["done"])
        more = F.struct(a["done"].alias("done"), F.array_append(a["open"], x["s"]).alias("open"), (a["n"] + size + x["gap"]).alias("n"))
        fresh = F.struct(closed.alias("done"), F.array(x["s"]).alias("open"), size.alias("n"))
        return F.when(fits, more).otherwise(fresh)

    last = lambda a: F.when(F.size(a["open"]) > 0, F.array_append(a["done"], F.array_join(a["open"], "\n\n"))).otherwise(a["done"])
    packed = F.filter(F.transform(F.aggregate(_pieces(text, most), start, step, last), strip), lambda c: c != "")
    return F.when(strip(text) == "", F.when(text == "", empty).otherwise(F.array(text))).otherwise(packed)
