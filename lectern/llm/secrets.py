"""Secret scans with DataFrame functions only: fixed patterns, and character Markov models.

Two first-order Markov models over ASCII token characters, one of random strings and one of
ordinary identifiers, are trained from labelled samples.  A token that no base span touches is
added where the log-likelihood ratio of the two models is high, in all and per character.

Defined results: null reads as empty text, which has no spans; repeated rows each get a row;
repeated rows are one sample;
ties in start go by kind, in the order of KINDS; an empty table gives an empty result and
models that rest on generated samples alone.  Other columns of the input play no part.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and lengths of the base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

#: A token that the models judge: a whole run of at least this many characters.
TOKEN = r"(?<![\p{L}\p{N}_+/-])[A-Za-z0-9_+/-]{16,}(?![\p{L}\p{N}_+/-])"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_+/-"
SIDE = len(ALPHABET) + 1
#: Natural-log ratios that a token must exceed, in all and per character.
LEAST_RATIO, LEAST_PER_CHAR = 20.0, 1.5
#: Bound of the labelled sample: about so many documents give words and found secrets.
SAMPLE_DOCS = 2_000
#: Generated random strings of each form.
GENERATED = 2_000
SMOOTHING = 0.5
MASK = "[SECRET]"

_SPAN = "array<struct<s:int,k:int,e:int>>"
_BLOCK = 256


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(steps: Column) -> Column:
    """Running sums of an int array in linear time: blocks first, then within blocks."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int"))
    part = lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))
    run = lambda start, xs: F.aggregate(xs, F.array(start), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
    totals = F.transform(blocks, lambda b: F.aggregate(part(b), F.lit(0), lambda a, x: a + x))
    return let(run(F.lit(0), totals), lambda at: F.flatten(F.transform(blocks, lambda b: let(run(F.get(at, b), part(b)), lambda r: F.slice(r, 2, F.size(r) - 1)))))


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of the pattern's leftmost matches, in code points; keep: of the arrays of groups, by index."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if keep else found
    base = F.struct(F.transform(found, F.length).alias("n"), F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(group, F.length).alias("g"))

    def spans(v: Column) -> Column:
        steps = F.zip_with(F.slice(v["gap"], 1, F.size(v["n"])), v["n"], lambda a, b: a + b)
        rows = let(steps, lambda st: F.zip_with(_sums(st), F.arrays_zip(v["n"], v["g"]), lambda e, x: F.struct((e - x["n"]).alias("s"), F.lit(kind).alias("k"), e.alias("e"), x["g"].alias("g"))))
        kept = F.filter(rows, lambda x: x["g"] >= keep) if keep else rows
        return F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))

    return let(base, lambda v: F.when(F.size(v["n"]) > 0, spans(v)).otherwise(F.array().cast(_SPAN)))


def _base_spans(text: Column) -> Column:
    none = F.array().cast(_SPAN)
    assign = F.when(text.rlike(ASSIGN), _matches(text, ASSIGN, 0, ASSIGN_VALUE)).otherwise(none)
    access = F.when(text.contains("AKIA"), _matches(text, ACCESS, 1)).otherwise(none)
    hexes = F.when(text.rlike(HEX), _matches(text, HEX, 2)).otherwise(none)
    return F.array_sort(F.concat(assign, access, hexes))


def _pairs(strings: DataFrame) -> DataFrame:
    """Counts of (label, code of a character and of the one before it)."""
    code = lambda i: F.instr(F.lit(ALPHABET), F.substring(F.col("x"), i, F.lit(1)))
    at = strings.where("length(x) > 0").select("label", "x", F.explode(F.sequence(F.lit(1), F.length("x"))).alias("i"))
    before = F.when(F.col("i") == 1, 0).otherwise(code(F.col("i") - 1))
    return at.select("label", (before * SIDE + code(F.col("i"))).alias("pair")).groupBy("label", "pair").count()


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label, x): 1 for random strings, 0 for ordinary identifiers; bounded by SAMPLE_DOCS and GENERATED."""
    spark = docs.sparkSession
    rows = max(1, docs.count())
    row = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = docs.select(row.alias("h"), text.alias("t")).where(F.pmod("h", F.lit(1_000_000)) < max(1, int(1e6 * min(1.0, SAMPLE_DOCS / rows)))).dropDuplicates(["h"])
    values = some.select(F.explode(F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))).alias("x")).where(F.length("x") >= ASSIGN_VALUE)
    ids = spark.range(GENERATED).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    made = [
        F.substring("h", 1, 32),
        F.substring(F.base64(F.unhex("h")), 1, 40),
        F.upper(F.substring(F.regexp_replace(F.base64(F.unhex("h")), "[^A-Za-z0-9]", ""), 1, 20)),
    ]
    random = values.select("x")
    for x in made:
        random = random.union(ids.select(x.alias("x")))
    words = F.regexp_extract_all("t", F.lit(r"(?<![\p{L}\p{N}])[A-Za-z]{2,}(?![\p{L}\p{N}])"), F.lit(0))
    w = F.col("w")
    forms = F.array(w[0], F.concat_ws("_", w[0], w[1], w[2]), F.concat_ws("-", w[0], w[1], w[2]), F.concat_ws("/", w[0], w[1], w[2]), F.concat(w[0], F.initcap(w[1]), F.initcap(w[2])), F.upper(F.concat_ws("_", w[0], w[1])), F.concat_ws("_", w[0], F.lit("2024"), w[1]), F.upper(w[0]), F.concat(F.initcap(w[0]), F.initcap(w[1])), F.lower(F.concat(w[0], w[1], w[2])))
    grams = some.select(words.alias("a")).where("size(a) >= 3").select(F.explode(F.transform(F.sequence(F.lit(1), F.size("a") - 2, F.lit(3)), lambda i: F.slice("a", i, 3))).alias("w"))
    day = F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") * 37 % 9000).cast("int"))
    stamps = spark.range(GENERATED).select(F.explode(F.array(F.date_format(day, "yyyy-MM-dd_HH-mm-ss"), F.date_format(day, "yyyy/MM/dd"), F.date_format(day, "yyyy-MM-dd"), F.repeat(F.lit("-"), F.lit(20)), F.repeat(F.lit("_"), F.lit(20)))).alias("x"))
    plain = grams.select(F.explode(forms).alias("x")).union(stamps)
    return random.select(F.lit(1).alias("label"), "x").union(plain.select(F.lit(0).alias("label"), "x"))


def train(samples: DataFrame) -> list[float]:
    """Log ratio by SIDE * code before + code; code 0 stands before the first character."""
    counts = {(r["label"], r["pair"]): r["count"] for r in _pairs(samples).collect()}
    ratio = [0.0] * (SIDE * SIDE)
    for a in range(SIDE):
        totals = [sum(counts.get((label, a * SIDE + b), 0) for b in range(1, SIDE)) + SMOOTHING * (SIDE - 1) for label in (0, 1)]
        for b in range(1, SIDE):
            plain, random = ((counts.get((label, a * SIDE + b), 0) + SMOOTHING) / totals[label] for label in (0, 1))
            ratio[a * SIDE + b] = round(math.log(random / plain), 6)
    return ratio


def log_ratio(token: Column, model: list[float]) -> Column:
    weights = F.from_json(F.lit(json.dumps(model)), "array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    one = lambda a, c: F.struct((a["sum"] + F.coalesce(F.get(weights, a["before"] * SIDE + c), F.lit(0.0))).alias("sum"), c.alias("before"))
    return F.aggregate(codes, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("before")), one, lambda a: a["sum"])


def _markov_spans(text: Column, base: Column, model: list[float]) -> Column:
    found = _matches(text, TOKEN, 3)

    def high(x: Column) -> Column:
        size = x["e"] - x["s"]
        ratio = log_ratio(F.substring(text, x["s"] + 1, size), model)
        return ~F.exists(base, lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])) & let(ratio, lambda r: (r > LEAST_RATIO) & (r > LEAST_PER_CHAR * size))

    return F.when(text.rlike(TOKEN), F.filter(found, high)).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, model: list[float], text_col: str = "text") -> DataFrame:
    """All columns of docs, with __base and __all: arrays of (s, k, e) sorted by start and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__base", _base_spans(text))
    return out.withColumn("__all", F.array_sort(F.concat("__base", _markov_spans(text, F.col("__base"), model))))


def _shown(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    count = lambda k: F.size(F.filter("__base", lambda x: x["k"] == k)).cast("long")
    return scanned.select(F.col(id_col).alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_shown("__base").cast("binary"), 256).alias("base_sha256"), _shown("__all").alias("spans"))


def redact(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of docs with every span of the text replaced by MASK; overlapping spans become one."""
    text = F.col(text_col)
    merged = F.aggregate(
        "__all",
        F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at")),
        lambda a, x: F.when(x["e"] <= a["at"], a).otherwise(F.struct(F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(F.substring(text, a["at"] + 1, x["s"] - a["at"]), F.lit(MASK)))).alias("out"), x["e"].alias("at"))),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))),
    )
    return scanned.withColumn(text_col, F.when(F.size("__all") > 0, merged).otherwise(text)).drop("__base", "__all")
