"""Registered queries on data that Spark derives from the fixture tables, each with the SQL that must give the same rows.

The tables hold no Hangul, so letters are put into syllables where an operator works on Korean: the
words of a table become stems, particles, terms and rules of a dictionary of the same size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fx
from lectern.functions.particles import PARTICLES, expand_pairs
from lectern.operators import dictionary, feedback, fold, generate, mining, rewrite, search, segments, similar, summary, tree

Query = Callable[[SparkSession, str], DataFrame]

#: Letters of the tables, and a syllable for each.
LETTERS, SYLLABLES = "abcdefghijklmnopqrstuvwxyz", "가는다라을바사이정차카물파은금재목의도에수토화별요와"
#: Times between which two lines of a transcript stand, as a line of their own and blank ones.
BETWEEN = "\n00:05 화자 1\n \n\n"
TIMECODE = "00:00:01,000 --> 00:00:02,000"
_WS = "E' \\t\\n\\r'"


def ko(text) -> Column:
    return F.translate(F.lower(text), LETTERS, SYLLABLES)


def in_syllables(word: str) -> str:
    return word.lower().translate(str.maketrans(LETTERS, SYLLABLES))


TERMS = tuple(map(in_syllables, ("the", "and", "tion", "ung", "password", "idiot")))
STOP = tuple(map(in_syllables, ("the", "and")))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")


def _korean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).withColumn("text", ko("text"))


def words(spark: SparkSession, sf_dir: str, name: str, form=ko) -> DataFrame:
    """(seq, term): the distinct words of 2 to 12 characters of a table's texts, in their order."""
    rows = _table(spark, sf_dir, name).select(F.explode(fx.tokens(form("text"))).alias("term")).where(F.length("term").between(2, 12)).distinct()
    return dictionary.renumber(rows, ["term"]).select("seq", "term")


def reversed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seq, wrong, right): words of the benchmark and what they are backwards."""
    return words(spark, sf_dir, "benchmark").select("seq", F.col("term").alias("wrong"), F.reverse("term").alias("right")).where("wrong <> right")


def nation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "nation")
    return rows.select(F.col("n_nationkey").cast("long").alias("seq"), ko(F.concat("n_name", F.lit(" de"))).alias("wrong"), ko("n_name").alias("right"))


def market_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), _nation().alias("right"))
    return _table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("seq"), F.col("c_mktsegment").alias("wrong"), "right")


def supply_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), _nation().alias("right"))
    rows = _table(spark, sf_dir, "supplier").join(nation, "s_nationkey")
    return rows.select(F.col("s_suppkey").alias("seq"), F.when(F.col("s_acctbal") < 5000, "BUILDING").otherwise("FURNITURE").alias("wrong"), "right")


def _nation() -> Column:
    return F.when(F.col("n_nationkey") < 5, F.col("n_name")).otherwise(F.replace("n_name", F.lit("_"), F.lit(" ")))


def _no_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "seq long, wrong string, right string")


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(map(_q, xs)) + "]"


def _ko(text: str) -> str:
    return f"translate(lower({text}), '{LETTERS}', '{SYLLABLES}')"


_NATION = "CASE WHEN n_nationkey < 5 THEN n_name ELSE replace(n_name, '_', ' ') END"
_MARKET = f"(SELECT c_custkey AS seq, c_mktsegment AS wrong, {_NATION} AS \"right\" FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_SUPPLY = f"(SELECT s_suppkey AS seq, CASE WHEN s_acctbal < 5000 THEN 'BUILDING' ELSE 'FURNITURE' END AS wrong, {_NATION} AS \"right\" FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
_TOKENS = "'[가-힣A-Za-z0-9]+'"


def _words(table: str, form=_ko) -> str:
    return f"(SELECT term, row_number() OVER (ORDER BY term) - 1 AS seq FROM (SELECT DISTINCT unnest(regexp_extract_all({form('text')}, {_TOKENS})) AS term FROM {table}) WHERE length(term) BETWEEN 2 AND 12)"


_PAIRS = f"(SELECT seq, term AS wrong, reverse(term) AS \"right\" FROM {_words('benchmark')} WHERE term <> reverse(term))"
_LINES = f"(SELECT doc_id AS path, i AS line_no, trim(l[i], {_WS}) AS text FROM (SELECT doc_id, string_split(text, E'\\n') AS l FROM documents), LATERAL (SELECT unnest(generate_series(1, len(l))) AS i) WHERE trim(l[i], {_WS}) <> '')"
_TIME = "'([0-9]{1,2}:)?[0-9]{1,2}:[0-9]{2}( *화자 *[0-9]+)?'"

# Rewriting -------------------------------------------------------------------------------------


def digits_to_sino(spark, sf_dir):
    rows = _table(spark, sf_dir, "orders").select(F.concat(F.lit("제"), F.col("o_orderkey").cast("string"), F.lit("장 "), F.col("o_custkey").cast("string"), F.lit("번")).alias("t"))
    return rows.select("t", fx.digits_to_sino(F.col("t")).alias("spoken"))


def _turned_rules(spark, sf_dir):
    term = F.col("term")
    rules = words(spark, sf_dir, "conversations", F.lower).select(F.col("term").alias("wrong"), F.concat(F.substring(term, F.lit(2), F.length(term)), F.substring(term, 1, 1)).alias("right"))
    return dictionary.renumber(rules, [F.length("wrong").desc(), "wrong"]).withColumnRenamed("seq", "ord")


def fold_thousands(spark, sf_dir):
    """Documents under an ordered rule for every word of the conversations, each of which can make others' input."""
    return fold.fold_many(_docs(spark, sf_dir), _turned_rules(spark, sf_dir)).select("path", F.md5("text").alias("text_md5"))


def fold_thousands_usage(spark, sf_dir):
    """How often each of these rules was used; sums over documents, by rule."""
    rules = _turned_rules(spark, sf_dir)
    return fold.usage(fold.fold_many(_docs(spark, sf_dir), rules), rules)


def feedback_order(spark, sf_dir):
    """Documents in the order of their ids: benchmark words backwards are manual pairs, which each file teaches the next."""
    manual = reversed_pairs(spark, sf_dir)
    done, _ = feedback.sequential(_korean(spark, sf_dir), rewrite.Rules(), nation_pairs(spark, sf_dir), manual, order_col="path")
    applied = lambda name: F.aggregate("stats", F.lit(0).cast("long"), lambda n, s: n + s[name]).alias(name)
    return done.select(F.col("place").alias("path"), F.md5("corrected").alias("text_md5"), applied("applied"), applied("skipped"))


def feedback_lessons(spark, sf_dir):
    """The pairs that enter the dictionary, in order, each with the document that taught it."""
    return feedback.sequential(_korean(spark, sf_dir), rewrite.Rules(), nation_pairs(spark, sf_dir), reversed_pairs(spark, sf_dir), order_col="path")[1]


def _sino(n: str) -> str:
    digits = ["", *fx.SINO_DIGITS[1:]]
    part = lambda p, unit: f"CASE {n} // {p} % 10 WHEN 0 THEN '' WHEN 1 THEN '{unit}' ELSE concat({_list(digits)}[1 + CAST({n} // {p} % 10 AS INT)], '{unit}') END"
    return f"CASE WHEN {n} > 9999 THEN CAST({n} AS VARCHAR) WHEN {n} = 0 THEN '{fx.SINO_DIGITS[0]}' ELSE concat({part(1000, '천')}, {part(100, '백')}, {part(10, '십')}, {_list(digits)}[1 + CAST({n} % 10 AS INT)]) END"


SQL: dict[str, str] = {
    "digits_to_sino": f"SELECT concat('제', o_orderkey, '장 ', o_custkey, '번') AS t, concat('제', {_sino('o_orderkey')}, '장 ', {_sino('o_custkey')}, '번') AS spoken FROM orders",
    "fold_thousands": f"""WITH r AS (SELECT list(concat(term, E'\\u0001', substring(term, 2), left(term, 1)) ORDER BY length(term) DESC, term) AS rules FROM {_words('conversations', lambda t: f'lower({t})')})
SELECT doc_id AS path, md5(list_reduce(list_prepend(text, rules), lambda t, r: replace(t, split_part(r, E'\\u0001', 1), split_part(r, E'\\u0001', 2)))) AS text_md5 FROM documents, r""",
}

# Segments --------------------------------------------------------------------------------------


def script_lines(spark, sf_dir):
    timed = F.replace("text", F.lit("\n"), F.lit(BETWEEN))
    return _docs(spark, sf_dir).select("path", F.md5(segments.script_text(timed)).alias("script_md5"))


def _timed(spark, sf_dir):
    """Lines of documents, of which those of every fifth length become time labels."""
    label = F.concat((F.length("text") % 60).cast("string"), F.lit(":"), F.lpad((F.col("line_no") % 60).cast("string"), 2, "0"))
    return segments.numbered_lines(_docs(spark, sf_dir)).withColumn("text", F.when(F.length("text") % 5 == 0, label).otherwise(F.col("text")))


def timestamp_ffill(spark, sf_dir):
    return segments.timed_entries(_timed(spark, sf_dir)).select("path", "line_no", "timestamp", F.md5("text").alias("text_md5"))


def aligned_lines(spark, sf_dir):
    """Documents whose lines lost every seventh one, and of which long lines were rewritten, against their timed lines."""
    timed = segments.timed_entries(_timed(spark, sf_dir))
    script = timed.where("line_no % 7 <> 3").select("path", "line_no", F.when(F.length("text") > 400, F.replace("text", F.lit("and"), F.lit("und"))).otherwise(F.col("text")).alias("text"))
    return search.align(script, timed)


def srt_text_lines(spark, sf_dir):
    """English documents as plain files, others as subtitle files with a block for each line."""
    block = lambda x, i: F.concat((i + 1).cast("string"), F.lit(f"\n{TIMECODE}\n"), x, F.lit("\n"))
    subtitles = F.array_join(F.transform(F.split("text", "\n", -1), block), "\n")
    plain = F.col("lang") == "en"
    path = F.concat(F.col("doc_id").cast("string"), F.when(plain, ".txt").otherwise(".srt"))
    files = _table(spark, sf_dir, "documents").select(path.alias("path"), F.when(plain, F.col("text")).otherwise(subtitles).alias("text"))
    return segments.text_lines(segments.transcript_lines(files)).select("path", "line_no", F.md5("text").alias("text_md5"), "is_srt")


def srt_blocks(spark, sf_dir):
    rows = segments.numbered_lines(_docs(spark, sf_dir), blank=True)
    said = rows.select("path", ((F.col("line_no") - 1) * 2.5).alias("start"), (F.col("line_no") * 2.5 - 0.25).alias("end"), "text")
    return segments.srt(said).select("path", "idx", F.md5("block").alias("block_md5"))


_RETIMED = f"(SELECT path, line_no, CASE WHEN length(text) % 5 = 0 THEN concat(length(text) % 60, ':', lpad(CAST(line_no % 60 AS VARCHAR), 2, '0')) ELSE text END AS text FROM {_LINES})"
_FILLED = f"""r AS (SELECT path, line_no, text, CASE WHEN regexp_full_match(text, {_TIME}) THEN regexp_extract(text, '^(([0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}})', 1) END AS label FROM {_RETIMED}),
f AS (SELECT *, coalesce(last_value(label IGNORE NULLS) OVER (PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS timestamp FROM r),
timed AS (SELECT path, line_no, timestamp, text FROM f WHERE label IS NULL)"""


def _srt_time(ms: str) -> str:
    pad = lambda x, n: f"lpad(CAST({x} AS VARCHAR), {n}, '0')"
    return f"concat({pad(f'({ms}) // 3600000', 2)}, ':', {pad(f'({ms}) // 60000 % 60', 2)}, ':', {pad(f'({ms}) // 1000 % 60', 2)}, ',', {pad(f'({ms}) % 1000', 3)})"


SQL |= {
    "script_lines": f"""WITH l AS (SELECT doc_id AS path, list_filter(list_transform(string_split(text, E'\\n'), lambda x: trim(x, {_WS})), lambda x: x <> '' AND NOT regexp_full_match(x, {_TIME})) AS l FROM documents)
SELECT path, md5(CASE WHEN len(l) = 0 THEN '' ELSE concat(array_to_string(l, E'\\n\\n'), E'\\n') END) AS script_md5 FROM l""",
    "timestamp_ffill": f"WITH {_FILLED} SELECT path, line_no, timestamp, md5(text) AS text_md5 FROM timed",
    "aligned_lines": f"""WITH RECURSIVE {_FILLED},
script AS (SELECT path, line_no, CASE WHEN length(text) > 400 THEN replace(text, 'and', 'und') ELSE text END AS text, row_number() OVER (PARTITION BY path ORDER BY line_no) AS n FROM timed WHERE line_no % 7 <> 3),
walk AS (
  SELECT path, CAST(0 AS BIGINT) AS n, 0 AS at, CAST(NULL AS BIGINT) AS line_no, '' AS timestamp FROM (SELECT DISTINCT path FROM script)
  UNION ALL
  SELECT w.path, s.n, coalesce((SELECT min(t.line_no) FROM timed t WHERE t.path = w.path AND t.line_no > w.at AND t.text = s.text), 1000000000) AS at, s.line_no,
    coalesce((SELECT arg_min(t.timestamp, t.line_no) FROM timed t WHERE t.path = w.path AND t.line_no > w.at AND t.text = s.text), '') AS timestamp
  FROM walk w JOIN script s ON s.path = w.path AND s.n = w.n + 1)
SELECT path, CAST(line_no AS INT) AS line_no, timestamp FROM walk WHERE n > 0""",
    "srt_text_lines": f"""WITH l AS (SELECT doc_id, lang, string_split(text, E'\\n') AS l FROM documents),
x AS (SELECT doc_id, lang, l, i FROM l, LATERAL (SELECT unnest(generate_series(1, len(l))) AS i))
SELECT concat(doc_id, '.srt') AS path, 4 * i - 1 AS line_no, md5(l[i]) AS text_md5, true AS is_srt FROM x WHERE lang <> 'en' AND trim(l[i], {_WS}) <> '' AND NOT regexp_full_match(trim(l[i], {_WS}), '[0-9]+|[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}},[0-9]{{3}}\\s+-->\\s+[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}},[0-9]{{3}}')
UNION ALL SELECT concat(doc_id, '.txt'), i, md5(l[i]), false FROM x WHERE lang = 'en' AND (i < len(l) OR l[i] <> '' OR len(l) = 1)""",
    "srt_blocks": f"""SELECT path, idx, md5(concat(idx, E'\\n', {_srt_time('(line_no - 1) * 2500')}, ' --> ', {_srt_time('line_no * 2500 - 250')}, E'\\n', text, E'\\n')) AS block_md5
FROM (SELECT path, line_no, regexp_replace(text, '\\s+', ' ', 'g') AS text, row_number() OVER (PARTITION BY path ORDER BY line_no) AS idx FROM {_LINES})""",
}

# Mining and summaries --------------------------------------------------------------------------


def fuzzy_suggest(spark, sf_dir):
    """Suggestions for the words of all documents, with the words of the benchmark as the dictionary."""
    counts = mining.token_counts(segments.numbered_lines(_korean(spark, sf_dir)))
    found = mining.suggest_replacements(counts, words(spark, sf_dir, "benchmark"), _no_pairs(spark))
    return found.select("wrong", "right", "count", "reason", F.round("score", 6).alias("score"))


def similar_words(spark, sf_dir):
    """Every word of the documents and the word of the benchmark that is most similar to it."""
    stems = words(spark, sf_dir, "documents").select("term")
    return similar.closest(stems, words(spark, sf_dir, "benchmark").select("term"), 0.85)


def one_char_suggest(spark, sf_dir):
    stems = words(spark, sf_dir, "benchmark").select(F.col("term").alias("stem"))
    return mining.one_char_matches(stems, words(spark, sf_dir, "conversations"))


def affix_terms(spark, sf_dir):
    stems = mining.stem_counts(mining.token_counts(segments.numbered_lines(_korean(spark, sf_dir))))
    return mining.suggest_terms(stems, words(spark, sf_dir, "benchmark"))


def _named(spark, sf_dir):
    name = F.concat("source", F.lit("/"), "lang", F.lit("-"), F.col("doc_id").cast("string"), F.lit(" lesson.txt"))
    return _table(spark, sf_dir, "documents").select(name.alias("path"), "text")


def concept_ring(spark, sf_dir):
    docs = _named(spark, sf_dir)
    return summary.concepts(docs, summary.keywords(docs, ["tion", "password"], 8))


def biased_scores(spark, sf_dir):
    return summary.biased_scores(_korean(spark, sf_dir), list(TERMS))


def study_sections(spark, sf_dir):
    """How many lines of each part of the study texts of all documents, and a digest of each part."""
    rows = summary.sections(_named(spark, sf_dir), ["tion", "password"])
    return rows.groupBy("path", "part").agg(F.count("*").alias("lines"), F.sum(F.xxhash64("n", "line").cast("decimal(38,0)")).cast("string").alias("digest"))


_SUFFIX = "|".join(mining._by_length())
_OWN_KEYS = f"""WITH docs AS (SELECT concat(source, '/', lang, '-', doc_id, ' lesson.txt') AS path, lang, text FROM documents),
dom AS (SELECT path, t AS keyword, (length(text) - length(replace(text, t, ''))) // length(t) AS count FROM docs, (SELECT unnest(['tion', 'password']) AS t) WHERE contains(text, t)),
w AS (SELECT path, unnest(list_concat(regexp_extract_all(text, '[가-힣]{{2,}}'), regexp_extract_all(lower(text), '[a-z]{{2,}}'))) AS keyword FROM docs),
f AS (SELECT path, keyword, count(*) AS count FROM w ANTI JOIN dom USING (path, keyword) GROUP BY ALL),
b AS (SELECT path, keyword, count, true AS is_domain FROM dom UNION ALL SELECT path, keyword, count, false FROM f),
keys AS (SELECT path, row_number() OVER (PARTITION BY path ORDER BY is_domain DESC, count DESC, keyword) AS rank, keyword, is_domain FROM b QUALIFY rank <= 8)"""

SQL |= {
    "one_char_suggest": f"""WITH s AS (SELECT term AS stem FROM {_words('benchmark')}), t AS {_words('conversations')}
SELECT stem, arg_min(term, (CASE WHEN left(stem, 1) = left(term, 1) THEN 0 ELSE 1 END) * 1000000000 + seq) AS match FROM s JOIN t ON length(stem) = length(term) AND stem <> term
WHERE len(list_filter(generate_series(1, length(stem)), lambda i: substring(stem, i, 1) <> substring(term, i, 1))) = 1 GROUP BY stem""",
    "affix_terms": f"""WITH l AS (SELECT path, line_no, regexp_extract_all({_ko('text')}, {_TOKENS}) AS k FROM {_LINES}),
t AS (SELECT path, line_no, i, regexp_replace(k[i], '^(.{{2,}}?)({_SUFFIX})$', '\\1') AS stem FROM l, LATERAL (SELECT unnest(generate_series(1, len(k))) AS i)),
s AS (SELECT stem, count(*) AS count, min(row(path, line_no, i)) AS first FROM t WHERE length(stem) >= 2 GROUP BY stem),
d AS {_words('benchmark')},
c AS (SELECT * FROM s WHERE count >= 2 AND length(stem) BETWEEN 2 AND 12 AND stem NOT IN (SELECT unnest({_list(mining.STOPWORDS)})) AND regexp_matches(stem, '[가-힣]') AND NOT regexp_matches(stem, '({'|'.join((*mining.ENDINGS, *mining.TERM_ENDINGS))})$') AND stem NOT IN (SELECT term FROM d))
SELECT stem AS term, count FROM c WHERE EXISTS (SELECT 1 FROM d WHERE starts_with(stem, term) OR suffix(stem, term) OR starts_with(term, stem) OR suffix(term, stem)) ORDER BY count DESC, first LIMIT 30""",
    "concept_ring": _OWN_KEYS
    + """,
c AS (SELECT path, lang AS concept, 0 AS tier, 0 AS spot FROM docs WHERE length(lang) >= 2 UNION ALL SELECT path, 'lesson', 0, 1 FROM docs
  UNION ALL SELECT path, keyword, 1, rank FROM keys WHERE is_domain UNION ALL SELECT path, keyword, 2, rank FROM keys),
o AS (SELECT path, concept, min(tier * 1000 + spot) AS place FROM c GROUP BY ALL),
k AS (SELECT path, list(concept ORDER BY place)[1:5] AS found FROM o GROUP BY path),
a AS (SELECT path, list_transform(generate_series(1, 5), lambda i: coalesce(found[i], concat('핵심개념', i))) AS every FROM docs LEFT JOIN k USING (path))
SELECT path, CAST(i AS INT) AS n, every[i] AS concept, every[i % 5 + 1] AS peer FROM a, (SELECT unnest(generate_series(1, 5)) AS i)""",
    "biased_scores": f"""WITH d AS (SELECT doc_id AS path, {_ko('text')} AS text FROM documents),
s AS (SELECT path, t AS keyword, (length(text) - length(replace(text, t, ''))) // length(t) + 1000 AS score FROM d, (SELECT unnest({_list(TERMS)}) AS t) WHERE contains(text, t)
  UNION ALL SELECT path, keyword, 1 FROM (SELECT path, unnest(regexp_extract_all(text, '[가-힣A-Za-z]{{2,}}')) AS keyword FROM d) WHERE keyword NOT IN (SELECT unnest({_list(summary.STOPWORDS)})) AND NOT regexp_full_match(keyword, '[A-Za-z]+'))
SELECT path, keyword, CAST(sum(score) AS BIGINT) AS score FROM s GROUP BY ALL""",
}

# Dictionaries ----------------------------------------------------------------------------------


def dict_union(spark, sf_dir):
    return dictionary.union_first(market_pairs(spark, sf_dir), supply_pairs(spark, sf_dir), ["wrong", "right"])


def dict_diff(spark, sf_dir):
    return dictionary.difference(market_pairs(spark, sf_dir), supply_pairs(spark, sf_dir), ["wrong", "right"])


def dict_growth(spark, sf_dir):
    applied = market_pairs(spark, sf_dir).select(F.col("seq").alias("ord"), F.col("wrong").alias("base_wrong"), F.col("right").alias("base_right"))
    return dictionary.grow_pairs(supply_pairs(spark, sf_dir), applied)


def override_upsert(spark, sf_dir):
    """Orders above a price are markers for the file of their priority; the first order of each priority is an override already."""
    orders = _table(spark, sf_dir, "orders")
    year = F.year("o_orderdate").cast("string")
    mark = F.when(F.col("o_totalprice") > 100_000, F.concat(F.lit(" @@ override: "), "o_orderstatus", F.lit(" => "), year)).otherwise(F.col("o_orderpriority"))
    lines = orders.select(F.col("o_orderpriority").alias("path"), F.col("o_orderkey").cast("int").alias("line_no"), mark.alias("text"))
    old = orders.groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("seq")).select("seq", F.col("o_orderpriority").alias("path"), F.lit("F").alias("wrong"), F.lit("1992").alias("right"), F.lit("old").alias("note"))
    more = old.select("seq", "path", F.lit("X").alias("wrong"), "right", "note")
    return dictionary.upsert_overrides(old.unionByName(more), dictionary.parse_markers(lines), "new").select("path", "wrong", "right", "note", "action")


def particle_expand(spark, sf_dir):
    return expand_pairs(reversed_pairs(spark, sf_dir)).select("wrong", "right", "base_wrong", "base_right")


def rule_order(spark, sf_dir):
    return dictionary.assemble_rules(reversed_pairs(spark, sf_dir), nation_pairs(spark, sf_dir))


def term_normalise(spark, sf_dir):
    rows = _docs(spark, sf_dir).select(F.explode(fx.tokens(ko("text"))).alias("t")).distinct()
    return rows.select("t", dictionary.normalise_term(F.col("t"), F.array(*map(F.lit, STOP))).alias("term"))


def finalised_paths(spark, sf_dir):
    folder = F.when(F.col("lang") == "en", fx.FINAL_FOLDERS[0]).when(F.col("lang") == "fr", f"x{fx.FINAL_FOLDERS[1]}").when(F.col("lang") == "de", fx.FINAL_FOLDERS[2]).otherwise(F.col("lang"))
    rows = _table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    return rows.select("path", fx.is_finalised(F.col("path")).alias("final"))


_SPECS = "(SELECT * FROM (VALUES " + ", ".join(f"({i}, {_q(a)}, {_q(b)}, {_q(c)})" for i, (a, b, c) in enumerate(PARTICLES, 1)) + ") AS t(k, closed, open, rieul))"
_FORM = "CASE WHEN NOT regexp_matches(right({0}, 1), '[가-힣]') THEN open WHEN (unicode(right({0}, 1)) - 44032) % 28 = 8 THEN rieul WHEN (unicode(right({0}, 1)) - 44032) % 28 > 0 THEN closed ELSE open END"
_EXPANDED = f"""p AS (SELECT seq, wrong AS w, "right" AS r FROM {_PAIRS}),
ends AS (SELECT seq, k, len(list_filter(generate_series(2, length(w) - 1), lambda i: substring(w, i + 1) = {_FORM.format('substring(w, 1, i)')})) > 0 AND len(list_filter(generate_series(2, length(r) - 1), lambda i: substring(r, i + 1) = {_FORM.format('substring(r, 1, i)')})) > 0 AS both_end FROM p, {_SPECS}),
variant AS (SELECT seq FROM ends GROUP BY seq HAVING bool_or(both_end)),
x AS (SELECT seq, 0 AS k, w AS wrong, r AS "right", w AS bw, r AS br FROM p
  UNION ALL SELECT seq, k, concat(w, {_FORM.format('w')}), concat(r, {_FORM.format('r')}), w, r FROM p, {_SPECS} WHERE regexp_full_match(w, '[가-힣]{{2,}}') AND regexp_full_match(r, '[가-힣]{{2,}}') AND seq NOT IN (SELECT seq FROM variant)),
e AS (SELECT wrong, "right", arg_min(bw, seq * 100 + k) AS base_wrong, arg_min(br, seq * 100 + k) AS base_right, min(seq * 100 + k) AS place FROM x GROUP BY ALL)"""


def _normalised() -> str:
    stop = _list(STOP)
    cases = " ".join(f"WHEN suffix(t, {_q(x)}) AND length(t) - {len(x)} >= 2 THEN left(t, length(t) - {len(x)})" for x in dictionary.TAILS)
    return f"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all({_ko('text')}, {_TOKENS})) AS t FROM documents), p AS (SELECT t, CASE {cases} ELSE t END AS c FROM w)
SELECT t, CASE WHEN list_contains({stop}, t) OR NOT regexp_matches(t, '[가-힣]') OR regexp_matches(c, '({'|'.join(dictionary.REJECT)})$') OR list_contains({stop}, c) OR length(c) NOT BETWEEN 2 AND 20 OR NOT regexp_matches(c, '[가-힣]') THEN '' ELSE c END AS term FROM p"""


SQL |= {
    "dict_union": f"""WITH b AS (SELECT 0 AS side, * FROM {_MARKET} UNION ALL SELECT 1, * FROM {_SUPPLY}),
f AS (SELECT *, row_number() OVER (PARTITION BY wrong, "right" ORDER BY side, seq) AS n FROM b)
SELECT row_number() OVER (ORDER BY side, seq) - 1 AS seq, wrong, "right" FROM f WHERE n = 1""",
    "dict_diff": f"SELECT m.* FROM {_MARKET} m WHERE NOT EXISTS (SELECT 1 FROM {_SUPPLY} s WHERE s.wrong = m.wrong AND s.\"right\" = m.\"right\")",
    "dict_growth": f"""SELECT min(seq) AS seq, wrong, "right" FROM {_MARKET} m WHERE length(wrong) <= 20 AND length("right") <= 20 AND wrong <> "right"
AND regexp_full_match(wrong, '[가-힣A-Za-z0-9]+( [가-힣A-Za-z0-9]+)?') AND regexp_full_match("right", '[가-힣A-Za-z0-9]+( [가-힣A-Za-z0-9]+)?')
AND NOT EXISTS (SELECT 1 FROM {_SUPPLY} s WHERE s.wrong = m.wrong AND s."right" = m."right") GROUP BY wrong, "right\"""",
    "override_upsert": """WITH o AS (SELECT o_orderpriority AS path, min(o_orderkey) AS seq FROM orders GROUP BY 1),
a AS (SELECT path, w AS wrong, '1992' AS "right", 'old' AS note, 0 AS is_new, seq FROM o, (SELECT unnest(['F', 'X']) AS w)
  UNION ALL SELECT o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS VARCHAR), 'new', 1, o_orderkey FROM orders WHERE o_totalprice > 100000),
g AS (SELECT path, wrong, arg_max("right", is_new * 1e12 + seq) AS "right", arg_max(note, is_new * 1e12 + seq) AS note, min(is_new) AS fresh, max(is_new) AS touched, arg_min(concat("right", '|', note), is_new * 1e12 + seq) AS was FROM a GROUP BY ALL)
SELECT path, wrong, "right", note, CASE WHEN fresh = 1 THEN 'added' WHEN touched = 0 THEN 'kept' WHEN was = concat("right", '|', note) THEN 'unchanged' ELSE 'updated' END AS action FROM g""",
    "particle_expand": f"WITH {_EXPANDED} SELECT wrong, \"right\", base_wrong, base_right FROM e",
    "rule_order": f"""WITH {_EXPANDED},
m AS (SELECT {_ko("concat(n_name, ' de')")} AS wrong, {_ko('n_name')} AS "right", n_nationkey AS place FROM nation),
b AS (SELECT wrong, "right", base_wrong, base_right, 0 AS part, place FROM e UNION ALL SELECT wrong, "right", wrong, "right", 1, place FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY wrong, "right" ORDER BY part, place) AS n FROM b)
SELECT row_number() OVER (ORDER BY length(wrong) DESC, part, place) - 1 AS ord, wrong, "right", base_wrong, base_right FROM f WHERE n = 1""",
    "term_normalise": _normalised(),
    "finalised_paths": f"""SELECT path, len(list_filter(string_split(path, '/'), lambda x: list_contains({_list(fx.FINAL_FOLDERS)}, x))) > 0 AS final
FROM (SELECT concat(source, '/', CASE lang WHEN 'en' THEN {_q(fx.FINAL_FOLDERS[0])} WHEN 'fr' THEN {_q('x' + fx.FINAL_FOLDERS[1])} WHEN 'de' THEN {_q(fx.FINAL_FOLDERS[2])} ELSE lang END, '/', doc_id, '.txt') AS path FROM documents)""",
}

# Generation ------------------------------------------------------------------------------------

_HEADS = generate.SECTIONS["summary"]


def section_check(spark, sf_dir):
    """Documents as outputs: with all sections, with three, with none, and breaking off in a heading."""
    part = lambda heads: F.concat(*(F.concat(F.lit(f"{h}\n"), F.col("text"), F.lit("\n")) for h in heads))
    said = F.when(F.col("lang") == "en", part(_HEADS)).when(F.col("lang") == "fr", part(_HEADS[:3])).when(F.col("lang") == "es", F.concat(part(_HEADS), F.lit("- \n"))).otherwise(F.col("text"))
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), said.alias("text")).select("path", generate.is_incomplete(F.col("text"), "summary").alias("incomplete"))


def response_extract(spark, sf_dir):
    """Turns of conversations as answers of either provider, in the four shapes that answers have."""
    text, role = F.concat(F.lit("  "), F.coalesce("text", F.lit("")), F.lit("\n")), F.concat(F.lit(" "), "role", F.lit(" "))
    item = lambda kind, x: F.struct(F.lit(kind).alias("type"), x.alias("text"))
    shapes = [
        F.struct(text.alias("output_text")),
        F.struct(F.array(F.struct(F.array(item("output_text", text), item("x", F.lit("skip")), item("text", role)).alias("content"))).alias("output")),
        F.struct(F.array(F.struct(F.struct(text.alias("content")).alias("message"))).alias("choices")),
        F.struct(F.array(F.struct(F.struct(F.array(F.struct(text.alias("text")), F.struct(F.lit(" ").alias("text")), F.struct(role.alias("text"))).alias("parts")).alias("content"))).alias("candidates")),
    ]
    body = F.to_json(shapes[3])
    for i, s in enumerate(shapes[:3]):
        body = F.when(F.col("turn") % 4 == i, F.to_json(s)).otherwise(body)
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", body.alias("body"))
    return rows.select("conv_id", "turn", F.md5(generate.openai_text(F.col("body"))).alias("openai_md5"), F.md5(generate.gemini_text(F.col("body"))).alias("gemini_md5"))


class Bare:
    """Requests that hold nothing but the texts, so that SQL can say what a client was asked."""

    def system(self) -> str:
        return ""

    def chunk(self, name, at, of, text, glossary) -> str:
        return text

    def merge(self, name, at, of, notes, glossary) -> str:
        return tree.GAP.join(notes)

    def final(self, name, notes, glossary) -> str:
        return tree.GAP.join(notes)

    def repair(self, name, notes, glossary, broken) -> str:
        return broken


#: Characters of notes that stay in one request of tree_notes, and levels of merging that its SQL spells out.
NOTE_CHARS, NOTE_LEVELS = 300, 5


def tree_notes(spark, sf_dir):
    """A note for each line of every document, merged level by level; the result has the digests of all requests on the way."""
    from lectern.sources.files import work_folder

    lines = F.filter(F.transform(fx.lines(F.col("text")), fx.strip), lambda x: x != "")
    docs = _docs(spark, sf_dir).select(F.col("path").cast("string").alias("path"), lines.alias("chunks"), F.array().cast("array<string>").alias("glossary"))
    return tree.generate(docs, generate.EchoClient(), work_folder(spark, "tree-notes"), prompts=Bare(), merge_limit=NOTE_CHARS)


def _echo(x: str) -> str:
    return f"concat('[', left(sha256({x}), 8), '] ', left({x}, 40))"


def _tree_sql() -> str:
    gap = "E'\\n\\n====\\n\\n'"
    out = [f"n0 AS (SELECT path, row_number() OVER (PARTITION BY path ORDER BY line_no) - 1 AS idx, {_echo('text')} AS note FROM {_LINES})"]
    for k in range(1, NOTE_LEVELS + 1):
        out.append(f"l{k} AS (SELECT path FROM n{k - 1} GROUP BY path HAVING count(*) > 1 AND sum(length(note)) > {NOTE_CHARS})")
        out.append(f"g{k} AS (SELECT path, idx // {generate.GROUP} AS idx, string_agg(note, {gap} ORDER BY idx) AS x FROM n{k - 1} SEMI JOIN l{k} USING (path) GROUP BY ALL)")
        out.append(f"n{k} AS (SELECT path, idx, note FROM n{k - 1} ANTI JOIN l{k} USING (path) UNION ALL SELECT path, idx, {_echo('x')} FROM g{k})")
    out.append(f"b AS (SELECT doc_id AS path, coalesce(x, '') AS x FROM documents LEFT JOIN (SELECT path, string_agg(note, {gap} ORDER BY idx) AS x FROM n{NOTE_LEVELS} GROUP BY path) ON path = doc_id)")
    return f"WITH {', '.join(out)} SELECT CAST(path AS VARCHAR) AS path, 'done' AS status, 'final' AS stage, {_echo('x')} AS text FROM b"


_BUILT = "CASE lang " + " ".join(
    f"WHEN '{lang}' THEN concat({', '.join(f'{_q(h)}, chr(10), text, chr(10)' for h in heads)}{more})" for lang, heads, more in (("en", _HEADS, ""), ("fr", _HEADS[:3], ""), ("es", _HEADS, ", '- ', chr(10)"))
) + " ELSE text END"
SQL |= {
    "section_check": f"""WITH d AS (SELECT doc_id AS path, trim({_BUILT}, {_WS}) AS s FROM documents), l AS (SELECT path, s, string_split(s, E'\\n') AS l FROM d),
c AS (SELECT path, s, len(list_filter(l, lambda x: starts_with(x, '## '))) AS heads, len(list_filter(l, lambda x: starts_with(x, '#'))) AS marks, trim(l[-1], {_WS}) AS last FROM l)
SELECT path, s = '' OR (heads < 4 AND marks < 6) OR (NOT ({' OR '.join(f'contains(s, {_q(h)})' for h in _HEADS)}) AND NOT ({' AND '.join(f'contains(s, {_q(k)})' for k in generate.KEYWORDS['summary'])}))
  OR length(s) < 240 OR regexp_matches(last, '^(###? |(-|[1-5]\\.)$)') AS incomplete FROM c""",
    "response_extract": f"""WITH c AS (SELECT conv_id, turn, turn % 4 AS k, role, trim(coalesce(text, ''), {_WS}) AS t FROM conversations)
SELECT conv_id, turn, md5(CASE k WHEN 0 THEN t WHEN 1 THEN CASE WHEN t = '' THEN role ELSE concat(t, E'\\n\\n', role) END WHEN 2 THEN t ELSE '' END) AS openai_md5,
  md5(CASE WHEN k = 3 THEN CASE WHEN t = '' THEN role ELSE concat(t, E'\\n\\n', role) END ELSE '' END) AS gemini_md5 FROM c""",
    "tree_notes": _tree_sql(),
}

ALL = (
    *(digits_to_sino, fold_thousands, fold_thousands_usage, feedback_order, feedback_lessons),
    *(script_lines, timestamp_ffill, aligned_lines, srt_text_lines, srt_blocks),
    *(fuzzy_suggest, similar_words, one_char_suggest, affix_terms, concept_ring, biased_scores, study_sections),
    *(dict_union, dict_diff, dict_growth, override_upsert, particle_expand, rule_order, term_normalise, finalised_paths),
    *(section_check, response_extract, tree_notes),
)
