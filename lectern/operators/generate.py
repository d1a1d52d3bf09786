"""Generative map-reduce over documents with an injected client, and the checks around it.

A client is any picklable object with call(system, user, most_tokens) -> str.  Spark may run a
task again, so a client should keep answers by request; none here opens a connection, and keys
never stand in rows or plans.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import display_stem, lines, mirror, strip
from lectern.operators.prompts import Prompts, partial
from lectern.operators.search import MOST_PATTERNS, with_terms

# Sections, their number and keywords by style; signals of an exhausted quota.
SECTIONS = {
    "summary": ("## 핵심 주제별 정리", "## 핵심 개념 맵", "## 시험 포인트", "## 실전 주의사항"),
    "study-pack": ("## 핵심 주제별 정리", "## 예상 시험문제", "## 꼭 공부해야 할 내용"),
    "merged": ("## 핵심 주제별 정리", "## 핵심 개념 맵", "## 예상 시험문제", "## 시험 포인트와 실전 주의사항", "## 꼭 공부해야 할 내용"),
}
KEYWORDS = {"summary": ("주제", "개념", "시험", "주의"), "study-pack": ("주제", "시험", "공부"), "merged": ("주제", "개념", "시험", "공부")}
TITLES = {"summary": "AI Summary", "study-pack": "Study Pack", "merged": "통합 학습 패키지"}
QUOTA = ("http 429", "resource_exhausted", "quota exceeded", "rate limit")
PROVIDERS = {"openai": ("https://api.openai.com/v1", "OPENAI_API_KEY"), "gemini": ("https://generativelanguage.googleapis.com/v1beta", "GEMINI_API_KEY")}

LEAST_OUTPUT, GROUP, MOST_TOKENS = 240, 6, 8192


def is_incomplete(text: Column, style: str) -> Column:
    """Whether an output lacks sections, is too short, or breaks off in a heading or list mark."""
    s = strip(text)
    rows = lines(s)
    count = lambda start: F.size(F.filter(rows, lambda x: x.startswith(start)))
    sections, keys = SECTIONS[style], KEYWORDS[style]
    named = F.greatest(*(F.contains(s, F.lit(x)) for x in sections))
    keyed = F.least(*(F.contains(s, F.lit(x)) for x in keys))
    last = strip(F.element_at(F.concat(F.array(F.lit("")), rows), -1))
    thin = (count("## ") < len(sections)) & (count("#") < len(sections) + 2)
    return (s == "") | thin | (~named & ~keyed) | (F.length(s) < LEAST_OUTPUT) | last.rlike(r"^(###? |(-|[1-5]\.)$)")


def is_quota_error(message: Column) -> Column:
    return F.lower(message).rlike("|".join(QUOTA))


def with_header(text: Column, path: Column, style: str) -> Column:
    body = F.regexp_replace(text, r"\s+$", "")
    return F.when(text.rlike(r"^\s*# "), F.concat(body, F.lit("\n"))).otherwise(F.concat(F.lit("# "), display_stem(path), F.lit(f" {TITLES[style]}\n\n"), body, F.lit("\n")))


def openai_text(payload: Column) -> Column:
    """Text of an answer: output_text, else the parts of output, else the first choice."""
    schema = "output_text string, output array<struct<content:array<struct<type:string,text:string>>>>, choices array<struct<message:struct<content:string>>>"
    p = F.from_json(payload, schema)
    parts = F.flatten(F.transform(F.coalesce(p["output"], F.array().cast("array<struct<content:array<struct<type:string,text:string>>>>")), lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    said = F.filter(F.transform(F.filter(parts, lambda x: x["type"].isin("output_text", "text")), lambda x: strip(F.coalesce(x["text"], F.lit("")))), lambda x: x != "")
    direct = strip(F.coalesce(p["output_text"], F.lit("")))
    chosen = strip(F.coalesce(F.get(p["choices"], F.lit(0))["message"]["content"], F.lit("")))
    return F.when(direct != "", direct).when(F.size(said) > 0, F.array_join(said, "\n\n")).otherwise(F.coalesce(chosen, F.lit("")))


def gemini_text(payload: Column) -> Column:
    """Texts of all parts of all candidates."""
    kind = "array<struct<content:struct<parts:array<struct<text:string>>>>>"
    p = F.from_json(payload, f"candidates {kind}")
    parts = F.flatten(F.transform(F.coalesce(p["candidates"], F.array().cast(kind)), lambda c: F.coalesce(c["content"]["parts"], F.array().cast("array<struct<text:string>>"))))
    return F.array_join(F.filter(F.transform(parts, lambda x: strip(F.coalesce(x["text"], F.lit("")))), lambda x: x != ""), "\n\n")


def note_groups(notes: DataFrame, key: str = "path", order: str = "idx", text: str = "note", size: int = GROUP) -> DataFrame:
    """(key, group, text): each `size` notes in order, joined; a round of merging."""
    rows = notes.withColumn("group", F.floor(F.col(order) / size).cast("int")).groupBy(key, "group")
    return rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n\n====\n\n").alias(text))


def pending(sources: DataFrame, outputs: DataFrame, suffixes: tuple[str, ...] = (".md",), overwrite: bool = False) -> DataFrame:
    """Sources (path) of which an output is missing; outputs (path) may mirror them with any suffix."""
    if overwrite:
        return sources
    wanted = sources.select("path", F.explode(F.array(*(mirror(F.col("path"), s) for s in suffixes))).alias("out"))
    missing = wanted.join(outputs.select(F.col("path").alias("out")).distinct(), "out", "left_anti")
    return sources.join(missing.select("path").distinct(), "path", "left_semi")


def run_totals(status: DataFrame) -> DataFrame:
    """One row: total, done, partial, skipped, failed, and exit_code 2 if any failed."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return status.agg(F.count("*").alias("total"), count("done"), count("partial"), count("skipped"), count("failed")).withColumn("exit_code", F.when(F.col("failed") > 0, 2).otherwise(0))


def glossary(docs: DataFrame, terms: DataFrame, limit: int = 80, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, rank, term): the first `limit` terms, in dictionary order, that the text contains."""
    ordered = [r["term"] for r in terms.groupBy("term").agg(F.min("seq").alias("seq")).orderBy("seq").limit(MOST_PATTERNS + 1).collect()]
    rows = with_terms(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")), ordered)
    return rows.select("path", F.posexplode(F.slice("found", 1, limit)).alias("i", "term")).select("path", (F.col("i") + 1).alias("rank"), "term")


class QuotaError(RuntimeError):
    """The provider's quota is used up."""


def is_quota(error: Exception) -> bool:
    return isinstance(error, QuotaError) or any(q in str(error).lower() for q in QUOTA)


def with_retries(call: Callable[[], str], tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> str:
    """Call until it works; waits 1.8 to the attempt, at most 20 seconds."""
    for attempt in range(1, tries + 1):
        try:
            return call()
        except QuotaError:
            raise
        except Exception as e:
            if attempt == tries or is_quota(e):
                raise
            sleep(min(20.0, 1.8**attempt))
    return ""


@dataclass
class EchoClient:
    """A deterministic client for tests: a digest of the request and its first characters."""

    keep: int = 40

    def call(self, system: str, user: str, most_tokens: int | None = None) -> str:
        return f"[{hashlib.sha256(user.encode()).hexdigest()[:8]}] {user[: self.keep]}"


def token_boost(base: int, attempt: int) -> int:
    return min(MOST_TOKENS, base * 2 ** (attempt + 1))


def prompts_of(style: str = "summary", topic: str = "general", guidance: str | None = None) -> Prompts:
    """Requests for a style with its sections."""
    return Prompts(style, topic, SECTIONS[style], guidance)


def map_reduce(chunked: DataFrame, client, prompts: Prompts | None = None, merge_limit: int = 40_000, complete: Callable[[str], bool] = bool, repairs: int = 3, base_tokens: int = 5_000, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """(path, status, stage, text) of documents (path, chunks array<string>, glossary array<string>).

    Each chunk becomes a note, notes merge in groups of GROUP while they are too long, and the
    last call makes the result, repaired with more tokens while it is incomplete.  A used-up
    quota leaves a partial result, any other error a failed row after `tries` calls; neither stops
    other documents.
    """
    given = prompts or prompts_of()
    system = given.system()

    def ask(*request):
        return with_retries(lambda: client.call(system, *request), tries, sleep)

    def one(path, parts, terms):
        stage, notes, merged, text = "init", [], [], ""
        try:
            for i, part in enumerate(parts, 1):
                stage = f"chunk {i}/{len(parts)}"
                notes.append(ask(given.chunk(path, i, len(parts), part, terms)))
            body = notes
            while len(body) > 1 and sum(map(len, body)) > merge_limit:
                groups = [body[i : i + GROUP] for i in range(0, len(body), GROUP)]
                merged = []
                for i, g in enumerate(groups, 1):
                    stage = f"merge {i}/{len(groups)}"
                    merged.append(ask(given.merge(path, i, len(groups), g, terms)))
                body = merged
            stage = "final"
            text = ask(given.final(path, body, terms))
            for attempt in range(repairs):
                if complete(text):
                    break
                stage = f"repair {attempt + 1}/{repairs}"
                text = ask(given.repair(path, body, terms, text), token_boost(base_tokens, attempt))
            if not complete(text):
                return path, "failed", stage, "output is incomplete after repairs"
            return path, "done", stage, text
        except Exception as e:
            if is_quota(e):
                return path, "partial", stage, partial(stage, str(e), text, merged, notes)
            return path, "failed", stage, str(e)

    def rows(batches):
        for batch in batches:
            done = [one(p or "", c or [], g or []) for p, c, g in zip(*(col.to_pylist() for col in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in range(4)], ["path", "status", "stage", "text"])

    return chunked.select(F.col("path").cast("string"), "chunks", "glossary").mapInArrow(rows, "path string, status string, stage string, text string")
