"""Registered queries over the fixture tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as fx
from lectern.operators import generate, mining, rewrite, search, segments, summary
from lectern.plans import derived, gates

Query = Callable[[SparkSession, str], DataFrame]

#: Literals that the queries over documents look for or rewrite.
PATTERNS = ("the", "and", "password", "idiot", "Licensed under", "token = ", "ción", "ung ")
FOLD = (("thth", "th"), ("and", "und"), ("und", "&"), ("er er", "er"), ("ciónn", "n"), ("the ", "The "))
GATE = ("the", "THE", ("ing",), ("tion",))
TERMS = ("the", "and", "tion", "ción", "ung", "eaux", "password", "idiot")
MINED = "정재 정재는 정제 정제는 3합 3합이 비겹별 육합 육합을 식신격 편재성 편제성 편재성과"
GLOBS = ("http://*", "*.example.com/en/*", "*/[0-4]*", "*page=?&*", "*[!x]")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")


def _values(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def _q(s) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'" if isinstance(s, str) else str(s)


def _sql_values(rows, names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(map(_q, r)) + ")" for r in rows) + f") AS t({names})"


def _list(xs) -> str:
    return "[" + ", ".join(map(_q, xs)) + "]"


_LINES = "(SELECT doc_id AS path, i AS line_no, trim(l[i], E' \\t\\n\\r') AS text FROM (SELECT doc_id, string_split(text, E'\\n') AS l FROM documents), LATERAL (SELECT unnest(generate_series(1, len(l))) AS i) WHERE trim(l[i], E' \\t\\n\\r') <> '')"
_TOKENS = "regexp_extract_all(text, '[가-힣A-Za-z0-9]+')"
_SENTENCES = "list_filter(list_transform(string_split_regex(regexp_replace(trim(x, E' \\t\\n\\r'), '([.!?。！？])\\s+', E'\\\\1\\u0001', 'g'), E'\\u0001'), lambda s: trim(s)), lambda s: s <> '')"
_SENT_ROWS = f"(SELECT doc_id AS path, pos - 1 AS pos, s[pos] AS sentence FROM (SELECT doc_id, flatten(list_transform(string_split(text, E'\\n'), lambda x: {_SENTENCES})) AS s FROM documents), LATERAL (SELECT unnest(generate_series(1, len(s))) AS pos))"


# Search ----------------------------------------------------------------------------------------


def _hits(spark, sf_dir):
    patterns = _values(spark, enumerate(PATTERNS), "ord int, pattern string")
    return search.literal_hits(segments.numbered_lines(_docs(spark, sf_dir)), patterns)


def residual_hits(spark, sf_dir):
    return _hits(spark, sf_dir).select("path", "line_no", "pattern", F.md5("text").alias("line_md5"))


def residual_groups(spark, sf_dir):
    return search.group_hits(_hits(spark, sf_dir))


def residual_totals(spark, sf_dir):
    return search.totals(_hits(spark, sf_dir), _docs(spark, sf_dir))


def regex_hits(spark, sf_dir):
    return search.group_hits(search.regex_hits(segments.numbered_lines(_docs(spark, sf_dir)), ["[0-9]{4}", "^The ", "ing\\.$"]))


def report_lines_whole(spark, sf_dir):
    """The lines of the report of all hits, with their times and the number of files."""
    docs = _docs(spark, sf_dir)
    times = segments.timed_entries(segments.numbered_lines(docs)).drop("text")
    scanned = search.totals(_hits(spark, sf_dir), docs).first()["files_scanned"]
    hits = search.with_times(_hits(spark, sf_dir), times)
    return search.report_markdown(hits.withColumn("path", F.col("path").cast("string")), scanned).where("line <> ''").groupBy("line").agg(F.count("*").alias("n"))


def glob_overrides(spark, sf_dir):
    globs = _values(spark, ((g, fx.glob_pattern(g)) for g in GLOBS), "wrong string, glob_re string")
    lines = _table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.col("page_id").alias("line_no"), F.lit("\n".join(GLOBS)).alias("text"))
    return search.override_hits(lines, globs).select(F.col("line_no").alias("page_id"), F.col("pattern").alias("glob"))


_HITS = f"(SELECT path, line_no, pattern, text FROM {_LINES} l, (SELECT unnest({_list(PATTERNS)}) AS pattern) p WHERE contains(text, pattern))"

SQL: dict[str, str] = {
    "residual_hits": f"SELECT path, line_no, pattern, md5(text) AS line_md5 FROM {_HITS}",
    "residual_groups": f"SELECT 'literal' AS match_kind, pattern, count(*) AS n_hits, count(DISTINCT path) AS n_files FROM {_HITS} GROUP BY pattern",
    "residual_totals": f"SELECT (SELECT count(DISTINCT doc_id) FROM documents) AS files_scanned, count(*) AS total_hits, count(DISTINCT pattern) AS unique_groups FROM {_HITS}",
    "regex_hits": f"SELECT 'regex' AS match_kind, p AS pattern, count(*) AS n_hits, count(DISTINCT path) AS n_files FROM {_LINES}, (SELECT unnest(['[0-9]{{4}}', '^The ', 'ing\\.$']) AS p) WHERE regexp_matches(text, p) GROUP BY p",
    "report_lines_whole": f"""
WITH r AS (SELECT path, line_no, CASE WHEN regexp_matches(text, '^([0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}}( *화자 *[0-9]+)?$') THEN regexp_extract(text, '^(([0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}})', 1) END AS label FROM {_LINES}),
t AS (SELECT path, line_no, CASE WHEN label IS NULL THEN last_value(label IGNORE NULLS) OVER (PARTITION BY path ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS time FROM r),
h AS (SELECT path, line_no, pattern, text, coalesce(time, '--:--') AS time FROM {_HITS} JOIN t USING (path, line_no)),
l AS (SELECT unnest(['# Suspicious Transcript Candidates', concat('- files_scanned: ', (SELECT count(DISTINCT doc_id) FROM documents)), concat('- unique_groups: ', count(DISTINCT pattern)), concat('- total_hits: ', count(*))]) AS line FROM h
  UNION ALL SELECT unnest([concat('## ', pattern), '- kind: literal', concat('- hits: ', count(*)), concat('- files: ', count(DISTINCT path))]) FROM h GROUP BY pattern
  UNION ALL SELECT concat('- ', path, ':', line_no, ' [', time, '] ', text) FROM h)
SELECT line, count(*) AS n FROM l GROUP BY line""",
    "glob_overrides": f"SELECT page_id, g AS \"glob\" FROM pages, (SELECT unnest({_list(GLOBS)}) AS g) WHERE regexp_matches(url, CASE g WHEN 'http://*' THEN '^http://' WHEN '*.example.com/en/*' THEN '\\.example\\.com/en/' WHEN '*/[0-4]*' THEN '/[0-4]' WHEN '*page=?&*' THEN 'page=.&' ELSE '[^x]$' END)",
}

# Rewriting -------------------------------------------------------------------------------------


def literal_fold(spark, sf_dir):
    return _docs(spark, sf_dir).select("path", F.md5(rewrite.fold_literals(F.col("text"), list(FOLD))["text"]).alias("text_md5"))


def literal_counts(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("path", F.posexplode(rewrite.fold_literals(F.col("text"), list(FOLD))["counts"]).alias("rule", "n"))
    return rows.groupBy("rule").agg(F.sum("n").alias("uses"), F.count_if(F.col("n") > 0).alias("n_docs"))


def line_fold_usage(spark, sf_dir):
    folded = rewrite.fold_lines(segments.numbered_lines(_docs(spark, sf_dir)), list(FOLD))
    return rewrite.rule_usage(folded, list(FOLD))


def change_metrics(spark, sf_dir):
    after = rewrite.fold_literals(F.col("text"), [("and", "und"), ("thth", "th")])["text"]
    return _docs(spark, sf_dir).select("path", fx.changed_chars(F.col("text"), after).alias("changed_chars"))


def context_gate(spark, sf_dir):
    done = rewrite.gated_replace(F.col("text"), *GATE, window=30)
    return _docs(spark, sf_dir).select("path", done.alias("d")).select("path", F.md5("d.text").alias("text_md5"), "d.applied", "d.skipped")


def rewrite_stages(spark, sf_dir):
    rules = rewrite.Rules(literals=FOLD[:3], pair_include={FOLD[1]: ("ing",)}, regexes=(rewrite.RegexRule("([0-9]+)%", r"\1 %", "n%", "n %"),), stable=(("  ", " "),))
    done = rewrite.rewrite(_docs(spark, sf_dir), rules, [(fx.glob_pattern("*7"), "of", "OF")])
    return rewrite.audit(done).groupBy("stage", "wrong", "right").agg(F.sum("applied").alias("applied"), F.sum("skipped").alias("skipped"))


def word_boundary(spark, sf_dir):
    return _docs(spark, sf_dir).select("path", F.regexp_count("text", F.lit(fx.whole_word("the"))).cast("long").alias("n"))


def compound_regex(spark, sf_dir):
    done = rewrite.rewrite(_docs(spark, sf_dir), rewrite.Rules(compounds=(("(t)h(e)", r"\1-\2"),)))
    return done.select(F.col("path").cast("long"), F.aggregate("stats", F.lit(0).cast("long"), lambda n, s: n + s["applied"]).alias("n"), F.md5("corrected").alias("text_md5"))


_GATE_SQL = """
WITH s AS (SELECT doc_id AS path, string_split(text, 'the') AS p FROM documents),
o AS (SELECT path, p, list_transform(generate_series(1, len(p) - 1), lambda i: len(array_to_string(p[1:i], 'the'))) AS st, array_to_string(p, 'the') AS text FROM s),
g AS (SELECT path, p, text, list_transform(st, lambda a: contains(substring(text, greatest(a - 30, 0) + 1, a + 33 - greatest(a - 30, 0) + 30), 'ing') AND NOT contains(substring(text, greatest(a - 30, 0) + 1, a + 33 - greatest(a - 30, 0) + 30), 'tion')) AS ok FROM o)
SELECT path, md5(concat(p[1], array_to_string(list_transform(generate_series(1, len(ok)), lambda i: concat(CASE WHEN ok[i] THEN 'THE' ELSE 'the' END, p[i + 1])), ''))) AS text_md5,
  CAST(len(list_filter(ok, lambda x: x)) AS BIGINT) AS applied, CAST(len(ok) - len(list_filter(ok, lambda x: x)) AS BIGINT) AS skipped FROM g""".replace("a + 33 - greatest(a - 30, 0) + 30", "a + 33 - greatest(a - 30, 0)")


def _fold_sql(text: str, rules) -> str:
    for w, r in rules:
        text = f"replace({text}, {_q(w)}, {_q(r)})"
    return text


def _fold_counts(source: str, rules, key: str) -> str:
    parts = []
    for i, (w, _) in enumerate(rules):
        t = _fold_sql("text", rules[:i])
        parts.append(f"SELECT {key}, {i} AS rule, {_q(w)} AS wrong, {_q(rules[i][1])} AS \"right\", (length({t}) - length(replace({t}, {_q(w)}, ''))) // {len(w)} AS n FROM {source}")
    return " UNION ALL ".join(parts)


_BY_LENGTH = sorted(FOLD, key=lambda r: -len(r[0]))
_CHANGED = _fold_sql("text", [("and", "und"), ("thth", "th")])
SQL |= {
    "literal_fold": f"SELECT doc_id AS path, md5({_fold_sql('text', FOLD)}) AS text_md5 FROM documents",
    "literal_counts": f"SELECT rule, CAST(sum(n) AS BIGINT) AS uses, count(*) FILTER (n > 0) AS n_docs FROM ({_fold_counts('documents', FOLD, 'doc_id')}) GROUP BY rule",
    "line_fold_usage": f"SELECT wrong, \"right\", CAST(sum(n) AS BIGINT) AS uses FROM ({_fold_counts(_LINES, _BY_LENGTH, 'path')}) GROUP BY ALL HAVING sum(n) > 0",
    "change_metrics": f"WITH c AS (SELECT doc_id AS path, text AS a, {_CHANGED} AS b FROM documents), l AS (SELECT path, string_split(a, '') AS x, string_split(b, '') AS y FROM c) SELECT path, CAST(len(list_filter(generate_series(1, least(len(x), len(y))), lambda i: x[i] <> y[i])) + abs(len(x) - len(y)) AS BIGINT) AS changed_chars FROM l",
    "context_gate": _GATE_SQL,
    "word_boundary": "SELECT doc_id AS path, CAST(len(list_filter(string_split_regex(text, '[^가-힣A-Za-z0-9]'), lambda w: w = 'the')) AS BIGINT) AS n FROM documents",
    "compound_regex": "SELECT doc_id AS path, CAST(len(regexp_extract_all(text, 'the')) AS BIGINT) AS n, md5(replace(text, 'the', 't-e')) AS text_md5 FROM documents",
}

# Segments --------------------------------------------------------------------------------------


def sentences(spark, sf_dir):
    return segments.sentence_rows(_docs(spark, sf_dir)).select("path", "pos", F.md5("sentence").alias("sentence_md5"))


def chunk_pack(spark, sf_dir):
    body = F.replace("text", F.lit("\n"), F.lit("\n\n"))
    rows = _docs(spark, sf_dir).select("path", F.posexplode(segments.chunks(body, 900)).alias("idx", "chunk"))
    return rows.groupBy("path").agg(F.count("*").alias("n_chunks"), F.max(F.length("chunk")).alias("longest"), F.sum(F.length(F.regexp_replace("chunk", r"\s+", ""))).alias("kept_chars"))


SQL |= {
    "sentences": f"SELECT path, pos, md5(sentence) AS sentence_md5 FROM {_SENT_ROWS}",
}

# Mining and summaries --------------------------------------------------------------------------


def token_counts(spark, sf_dir):
    return mining.token_counts(segments.numbered_lines(_docs(spark, sf_dir))).select("token", "count")


def token_topk(spark, sf_dir):
    return mining.top_tokens(_docs(spark, sf_dir), 5)


def stem_counts(spark, sf_dir):
    lines = _values(spark, [("a", 1, MINED)], "path string, line_no int, text string").unionByName(segments.numbered_lines(_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")))
    return mining.stem_counts(mining.token_counts(lines)).select("token", "count")


def affix_related(spark, sf_dir):
    stems = mining.token_counts(segments.numbered_lines(_docs(spark, sf_dir))).select("token")
    return mining.related_to_terms(stems, _values(spark, enumerate(TERMS), "seq long, term string"))


def glossary_hits(spark, sf_dir):
    return generate.glossary(_docs(spark, sf_dir), _values(spark, enumerate(TERMS), "seq long, term string"), 3)


def domain_counts(spark, sf_dir):
    return summary.term_counts(_docs(spark, sf_dir), list(TERMS))


def keywords(spark, sf_dir):
    return summary.keywords(_docs(spark, sf_dir), list(TERMS[3:]), 8)


def sentence_scores(spark, sf_dir):
    return summary.document_sentences(_docs(spark, sf_dir), list(TERMS[3:]), 3, 8).select("path", "pos", "score", "rank")


def theme_sentences(spark, sf_dir):
    return summary.document_themes(_docs(spark, sf_dir), list(TERMS[3:]), 2, 8).select("path", "theme", "n", F.md5("sentence").alias("sentence_md5"))


_KEYS = f"""
WITH dom AS (SELECT doc_id AS path, t AS keyword, (length(text) - length(replace(text, t, ''))) // length(t) AS count FROM documents, (SELECT unnest({_list(TERMS[3:])}) AS t) WHERE contains(text, t)),
w AS (SELECT doc_id AS path, unnest(list_concat(regexp_extract_all(text, '[가-힣]{{2,}}'), regexp_extract_all(lower(text), '[a-z]{{2,}}'))) AS keyword FROM documents),
f AS (SELECT path, keyword, count(*) AS count FROM w ANTI JOIN dom USING (path, keyword) GROUP BY ALL),
b AS (SELECT path, keyword, count, true AS is_domain FROM dom UNION ALL SELECT path, keyword, count, false FROM f),
keys AS (SELECT path, row_number() OVER (PARTITION BY path ORDER BY is_domain DESC, count DESC, keyword) AS rank, keyword, is_domain, count FROM b QUALIFY rank <= 8)"""
_SCORED = _KEYS + f""",
own AS (SELECT path, list(keyword) AS k FROM keys GROUP BY path),
sc AS (SELECT s.path, s.pos, s.sentence, len(list_filter(list_concat(regexp_extract_all(sentence, '[가-힣]{{2,}}'), regexp_extract_all(lower(sentence), '[a-z]{{2,}}')), lambda x: list_contains(coalesce(k, []), x))) + CASE WHEN length(sentence) BETWEEN 20 AND 220 THEN 1 ELSE 0 END AS score FROM {_SENT_ROWS} s LEFT JOIN own USING (path)),
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, pos) AS rank FROM sc)"""
_SUFFIX = "|".join(mining._by_length())
SQL |= {
    "token_counts": f"SELECT token, count(*) AS count FROM (SELECT unnest({_TOKENS}) AS token FROM documents) GROUP BY token",
    "token_topk": f"SELECT path, token, count, row_number() OVER (PARTITION BY path ORDER BY count DESC, token) AS rank FROM (SELECT doc_id AS path, token, count(*) AS count FROM (SELECT doc_id, unnest({_TOKENS}) AS token FROM documents) GROUP BY ALL) QUALIFY rank <= 5",
    "stem_counts": f"SELECT stem AS token, count(*) AS count FROM (SELECT regexp_replace(token, '^(.{{2,}}?)({_SUFFIX})$', '\\1') AS stem FROM (SELECT unnest({_TOKENS}) AS token FROM (SELECT text FROM documents UNION ALL SELECT {_q(MINED)}))) WHERE length(stem) >= 2 GROUP BY stem",
    "affix_related": f"SELECT DISTINCT token FROM (SELECT DISTINCT unnest({_TOKENS}) AS token FROM documents), (SELECT unnest({_list(t for t in TERMS if ' ' not in t)}) AS term) WHERE starts_with(token, term) OR suffix(token, term) OR (length(token) >= 2 AND (starts_with(term, token) OR suffix(term, token)))",
    "glossary_hits": f"SELECT doc_id AS path, i AS rank, h[i] AS term FROM (SELECT doc_id, list_filter({_list(TERMS)}, lambda t: contains(text, t))[1:3] AS h FROM documents), LATERAL (SELECT unnest(generate_series(1, len(h))) AS i)",
    "domain_counts": f"SELECT doc_id AS path, t AS term, (length(text) - length(replace(text, t, ''))) // length(t) AS count FROM documents, (SELECT unnest({_list(TERMS)}) AS t) WHERE contains(text, t)",
    "keywords": _KEYS + " SELECT * FROM keys",
    "sentence_scores": _SCORED + " SELECT path, pos, score, rank FROM r WHERE rank <= 3",
    "theme_sentences": _SCORED + """,
th AS (SELECT path, (rank - 1) // 4 AS theme, list(keyword) AS words FROM keys WHERE rank <= 12 GROUP BY ALL),
o AS (SELECT path, sentence, min(rank) AS rank FROM r GROUP BY ALL),
h AS (SELECT o.path, theme, sentence, rank, len(list_filter(words, lambda w: contains(sentence, w))) > 0 AS hit FROM o JOIN th USING (path)),
a AS (SELECT *, max(hit) OVER (PARTITION BY path, theme) AS any_hit FROM h WHERE hit OR length(sentence) >= 20)
SELECT path, theme, row_number() OVER (PARTITION BY path, theme ORDER BY rank) AS n, md5(sentence) AS sentence_md5 FROM a WHERE hit OR NOT any_hit QUALIFY n <= 2""",
}

# Generation ------------------------------------------------------------------------------------


def run_status(spark, sf_dir):
    kinds = F.when(F.col("event_id") % 11 == 0, "failed").when(F.col("event_id") % 7 == 0, "partial").when(F.col("event_id") % 3 == 0, "skipped").otherwise("done")
    return generate.run_totals(_table(spark, sf_dir, "events").select(kinds.alias("status")))


def output_pending(spark, sf_dir):
    sources = _table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".script.txt")).alias("path"))
    done = _table(spark, sf_dir, "labels").select(F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".script.md")).alias("path"))
    return generate.pending(sources, done)


def conversation_notes_whole(spark, sf_dir):
    """As conversation_notes, but every note is a turn's whole text; wide rows are told by length and digest."""
    rows = _table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("path"), F.col("turn").alias("idx"), F.col("text").alias("note"))
    return generate.note_groups(rows, size=3).select("path", "group", F.length("note").alias("n_chars"), F.md5("note").alias("note_md5"))


def map_reduce_status(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("path", segments.chunks(F.col("text"), 2000).alias("chunks"), F.array(F.lit("the")).alias("glossary"))
    return generate.map_reduce(docs, generate.EchoClient()).groupBy("status", "stage").agg(F.count("*").alias("n"))


SQL |= {
    "run_status": "WITH s AS (SELECT CASE WHEN event_id % 11 = 0 THEN 'failed' WHEN event_id % 7 = 0 THEN 'partial' WHEN event_id % 3 = 0 THEN 'skipped' ELSE 'done' END AS s FROM events) SELECT count(*) AS total, count(*) FILTER (s = 'done') AS done, count(*) FILTER (s = 'partial') AS partial, count(*) FILTER (s = 'skipped') AS skipped, count(*) FILTER (s = 'failed') AS failed, CASE WHEN count(*) FILTER (s = 'failed') > 0 THEN 2 ELSE 0 END AS exit_code FROM s",
    "output_pending": "SELECT concat(source, '/', doc_id, '.script.txt') AS path FROM documents WHERE concat(source, '/', doc_id) NOT IN (SELECT concat('src', doc_id % 20, '/', doc_id) FROM labels)",
    "conversation_notes_whole": "SELECT path, \"group\", length(note) AS n_chars, md5(note) AS note_md5 FROM (SELECT conv_id AS path, turn // 3 AS \"group\", string_agg(text, E'\\n\\n====\\n\\n' ORDER BY turn, text) AS note FROM conversations GROUP BY ALL)",
    "map_reduce_status": "SELECT 'done' AS status, 'final' AS stage, count(*) AS n FROM documents",
}

_ALL = (
    *(residual_hits, residual_groups, residual_totals, regex_hits, report_lines_whole, glob_overrides),
    *(literal_fold, literal_counts, line_fold_usage, change_metrics, context_gate, rewrite_stages, word_boundary, compound_regex),
    *(sentences, chunk_pack, token_counts, token_topk, stem_counts, affix_related, glossary_hits, domain_counts, keywords),
    *(sentence_scores, theme_sentences, run_status, output_pending, conversation_notes_whole, map_reduce_status),
    *derived.ALL,
    *gates.ALL,
)


def queries() -> dict[str, Query]:
    return {q.__name__: partial(q) for q in _ALL}


def oracle_sql() -> dict[str, str]:
    return SQL | derived.SQL | gates.SQL
