"""Registered queries for the gated and staged rewriting of documents and the runs around it, each with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as fx
from lectern.operators import batch, dictionary, generate, mining, rewrite, running, segments, summary
from lectern.operators.rewrite import FamilyRule, RegexRule, Rules
from lectern.plans.derived import _LINES, _TOKENS, _WS, _docs, _korean, _ko, _list, _q, _table, _words, in_syllables, market_pairs, words
from lectern.streaming import incremental

#: A match of two syllables that needs a word of the domain near it.
SHORT, DOMAIN = (in_syllables("th"), in_syllables("un")), in_syllables("password")
#: Words that let a rule go on.
NEAR = ("password", "Licensed")
STABLE = (("  ", " "), (" ,", ","), ("password", "passwort"))
STABLE_REGEXES = ((r"([a-z])\.([A-Z])", r"\1. \2"), ("[0-9]{5,}", "#"))
REGEXES = (RegexRule("([a-z]+)ing", r"\1ING", "*ing", "*ING"), RegexRule("[0-9]+", "<n>", "digits", "<n>"))
FAMILY = FamilyRule("the[a-z]*", "the", "THE", skip_suffixes=("re", "n"), exclude=("idiot",), compound_prefixes=("o", "ba"), reject_near="[0-9]{3}", follow="[a-m]")
BUDGET = 400_000


def _told(done):
    """(path, n, text_md5): what was applied in each document, and a digest of its text."""
    applied = F.aggregate("stats", F.lit(0).cast("long"), lambda n, s: n + s["applied"])
    skipped = F.aggregate("stats", F.lit(0).cast("long"), lambda n, s: n + s["skipped"])
    return done.select(F.col("path").cast("long"), applied.alias("applied"), skipped.alias("skipped"), F.md5("corrected").alias("text_md5"))


def contextual_rules(spark, sf_dir):
    """A pattern that is replaced where a word stands within 120 characters of it and another does not."""
    rule = RegexRule("([a-z])ion", r"\1ION", "ion", "ION", include=NEAR, exclude=("idiot",))
    return _told(rewrite.rewrite(_docs(spark, sf_dir), Rules(contextual=(rule,))))


def family_rules(spark, sf_dir):
    """A stem whose match is kept by its suffix, by what stands before it, near it or after it."""
    return _told(rewrite.rewrite(_docs(spark, sf_dir), Rules(families=(FAMILY,))))


def plain_regexes(spark, sf_dir):
    done = rewrite.rewrite(_docs(spark, sf_dir), Rules(regexes=REGEXES))
    return rewrite.audit(done).select(F.col("path").cast("long"), "wrong", "right", "applied")


def stable_rules(spark, sf_dir):
    return _told(rewrite.rewrite(_docs(spark, sf_dir), Rules(stable=STABLE, stable_regexes=STABLE_REGEXES)))


def short_words(spark, sf_dir):
    """A short Hangul word, which needs a boundary on either side and a word of the domain near it."""
    rules = Rules(literals=(SHORT,), domain_keywords=(DOMAIN,))
    return _told(rewrite.rewrite(_korean(spark, sf_dir), rules))


def pair_gates(spark, sf_dir):
    """Two pairs one after the other, the second with words that let it go and words that hold it."""
    rules = Rules(literals=(("and the", "und the"), ("the ", "THE ")), pair_include={("the ", "THE "): ("ing",)}, pair_exclude={("the ", "THE "): ("idiot", "password")})
    return _told(rewrite.rewrite(_docs(spark, sf_dir), rules))


def path_overrides(spark, sf_dir):
    """Overrides that hold for the documents whose path fits a pattern, the longest first."""
    over = [(fx.glob_pattern("*7"), "an", "AN"), (fx.glob_pattern("*7"), "and ", "& "), (fx.glob_pattern("[12]*"), "ung", "UNG")]
    return _told(rewrite.rewrite(_docs(spark, sf_dir), Rules(), over))


def run_metrics(spark, sf_dir):
    """Each document's changed characters and sums over rules, as a run reports them."""
    rules = Rules(literals=(("and", "und"), ("the ", "THE ")), pair_include={("the ", "THE "): ("ing",)}, stable=(("ung", "UNG"),))
    done = rewrite.rewrite(_docs(spark, sf_dir), rules, [(fx.glob_pattern("*7"), "ment", "MENT")])
    return rewrite.metrics(done).select(F.col("path").cast("long"), "changed_chars", "applied_rules", "applied_hits", "skipped_rules", "skipped_hits", "override_rules", "override_hits")


def changed_documents(spark, sf_dir):
    done = batch.correct(_docs(spark, sf_dir), Rules(stable=(("idiot", "friend"), ("token = ", "token: "))))
    return batch.changed(done).select(F.col("path").cast("long"), "status", F.md5("script").alias("script_md5"))


def report_lines_of_runs(spark, sf_dir):
    """Counts of a report: terms in the corrected text, and lines of the script."""
    done = batch.correct(_docs(spark, sf_dir), Rules(stable=(("the", "The"),)))
    lines = batch.report(done, ["The", "password", "idiot"]).where("line LIKE 'term_hits%' OR line LIKE 'script_lines%'")
    return lines.select(F.col("path").cast("long"), "line")


def paired_files(spark, sf_dir):
    """Every script with its corrected text, by path."""
    docs = _table(spark, sf_dir, "documents")
    path = lambda kind: F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(f".{kind}.txt")).alias("path")
    both = batch.pair_with_corrected(docs.select(path("script"), "text"), docs.select(path("corrected"), F.replace("text", F.lit("the"), F.lit("The")).alias("text")))
    return both.select("path", "corrected_path", F.md5("corrected").alias("corrected_md5"))


def uncorrected_files(spark, sf_dir):
    """Documents that no label names, as raw files whose corrected file is missing."""
    path = lambda kind: F.concat(F.col("doc_id").cast("string"), F.lit(f"{kind}.txt")).alias("path")
    return incremental.uncorrected(_table(spark, sf_dir, "documents").select(path("")), _table(spark, sf_dir, "labels").select(path(".corrected")))


def term_seed(spark, sf_dir):
    terms = words(spark, sf_dir, "benchmark")
    pairs = market_pairs(spark, sf_dir).select("seq", "wrong", "right")
    return dictionary.term_seed(terms, pairs)


def budget_files(spark, sf_dir):
    """The first documents whose characters together stay within a budget."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return running.within_budget(rows, BUDGET, F.col("n_chars"), "doc_id")


def running_chars(spark, sf_dir):
    """Characters of the documents of a source before each, and the longest so far."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    sums = running.running(rows, ["source"], "doc_id", F.col("n_chars"), "before")
    return running.running(sums, ["source"], "doc_id", F.col("n_chars"), "longest", how="max", inclusive=True)


def quota_messages(spark, sf_dir):
    """Which turns a client would take for an exhausted quota, were they errors."""
    said = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("HTTP 429: "), "text")).when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" Quota Exceeded"))).otherwise(F.col("text"))
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", generate.is_quota_error(F.coalesce(said, F.lit(""))).alias("quota"))


def long_sentences(spark, sf_dir):
    """Sentences of 14 characters or more."""
    rows = segments.sentence_rows(_docs(spark, sf_dir), ends=".!?", least=14)
    return rows.groupBy("path").agg(F.count("*").alias("n"), F.sum(F.length("sentence")).alias("chars"))


def concept_lists(spark, sf_dir):
    """The first words of each document without repeats and without short words inside others."""
    found = F.slice(fx.tokens(F.lower("text")), 1, 40)
    return _docs(spark, sf_dir).select("path", F.array_join(summary.distinct_concepts(found, 10), " ").alias("concepts"))


def keyword_first_sentences(spark, sf_dir):
    """For two words in turn, the first sentences that have them."""
    rows = segments.sentence_rows(_docs(spark, sf_dir), ends=".!?").groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "sentence"))), lambda x: x["sentence"]).alias("s"))
    picked = summary.keyword_sentences(F.col("s"), F.array(F.lit("password"), F.lit("tion")))
    return rows.select("path", F.md5(F.array_join(picked, "|")).alias("picked_md5"))


def mined_candidates(spark, sf_dir):
    """Words of documents that may be misspelt terms of the benchmark."""
    counts = mining.token_counts(segments.numbered_lines(_korean(spark, sf_dir)))
    none = spark.createDataFrame([], "seq long, wrong string, right string")
    return mining.typo_candidates(counts, words(spark, sf_dir, "benchmark"), none, 2)


def _gated(source: str, pattern: str, condition: str, replaced: str, window: int = 120) -> str:
    """SQL of matches m at a (up to e), of a text: those that meet a condition over near, rest of the text and m are replaced."""
    near = f"substring(text, greatest(a - {window}, 0) + 1, e + {window} - greatest(a - {window}, 0))"
    return f"""WITH s AS (SELECT doc_id AS path, {source} AS text FROM documents), p AS (SELECT path, text, regexp_extract_all(text, {_q(pattern)}) AS m, string_split_regex(text, {_q(pattern)}) AS g FROM s),
x AS (SELECT path, text, m[i] AS m, g[i + 1] AS after, i, len(array_to_string(g[1:i], '')) + len(array_to_string(m[1:i - 1], '')) AS a FROM p, LATERAL (SELECT unnest(generate_series(1, len(m))) AS i)),
y AS (SELECT *, a + length(m) AS e FROM x), z AS (SELECT *, {near} AS near FROM y), ok AS (SELECT *, ({condition}) AS fine FROM z),
r AS (SELECT path, count(*) FILTER (fine) AS applied, count(*) FILTER (NOT fine) AS held, string_agg(concat(CASE WHEN fine THEN {replaced} ELSE m END, after), '' ORDER BY i) AS tail FROM ok GROUP BY path)"""


def _any(words_) -> str:
    return "(" + " OR ".join(f"contains(near, {_q(w)})" for w in words_) + ")"


_NONE = "CAST(0 AS BIGINT)"
_WORD = "[가-힣A-Za-z0-9]"
_PLAIN = f" SELECT p.path, coalesce(applied, 0) AS applied, {_NONE} AS skipped, md5(concat(g[1], coalesce(tail, ''))) AS text_md5 FROM p LEFT JOIN r ON r.path = p.path"
_SKIPS = _PLAIN.replace(f"{_NONE} AS skipped", "coalesce(held, 0) AS skipped")
_TIGHT = "substring(text, greatest(a - 24, 0) + 1, e + 24 - greatest(a - 24, 0))"
_FAMILY = f"""NOT (a > 0 AND regexp_matches(substring(text, a, 1), '{_WORD}') AND NOT (suffix(substring(text, 1, a), 'o') OR suffix(substring(text, 1, a), 'ba')))
AND NOT starts_with(substring(m, 4), 're') AND NOT starts_with(substring(m, 4), 'n') AND NOT contains(near, 'idiot') AND NOT regexp_matches({_TIGHT}, '[0-9]{{3}}')
AND regexp_matches(ltrim(concat(substring(m, 4), substring(text, e + 1, 24)), {_WS}), '^[a-m]')"""


def _count(text: str, word: str) -> str:
    return f"(length({text}) - length(replace({text}, {_q(word)}, ''))) // {len(word)}"


def _fold(text: str, rules) -> str:
    for w, r in rules:
        text = f"replace({text}, {_q(w)}, {_q(r)})"
    return text


_PAIRS_SQL = _gated("replace(text, 'and the', 'und the')", "the ", "contains(near, 'ing') AND NOT contains(near, 'idiot') AND NOT contains(near, 'password')", "'THE '")
_METRICS = _gated(
    "replace(CASE WHEN doc_id % 10 = 7 THEN replace(text, 'ment', 'MENT') ELSE text END, 'and', 'und')", "the ", "contains(near, 'ing')", "'THE '"
) + f""",
f AS (SELECT p.path, applied, held, concat(g[1], coalesce(tail, '')) AS t FROM p LEFT JOIN r ON r.path = p.path),
d AS (SELECT doc_id AS path, text, CASE WHEN doc_id % 10 = 7 THEN {_count('text', 'ment')} ELSE 0 END AS n_over, CASE WHEN doc_id % 10 = 7 THEN replace(text, 'ment', 'MENT') ELSE text END AS o FROM documents),
c AS (SELECT path, text, n_over, {_count('o', 'and')} AS n_and, coalesce(applied, 0) AS n_the, coalesce(held, 0) AS n_held, {_count('t', 'ung')} AS n_ung, string_split(text, '') AS a, string_split(replace(t, 'ung', 'UNG'), '') AS b FROM d JOIN f USING (path))
SELECT path, CAST(len(list_filter(generate_series(1, least(len(a), len(b))), lambda i: a[i] <> b[i])) + abs(len(a) - len(b)) AS BIGINT) AS changed_chars,
  CAST((n_and > 0)::INT + (n_the > 0)::INT + (n_ung > 0)::INT AS BIGINT) AS applied_rules, CAST(n_and + n_the + n_ung AS BIGINT) AS applied_hits, CAST((n_held > 0)::INT AS BIGINT) AS skipped_rules, CAST(n_held AS BIGINT) AS skipped_hits,
  CAST((n_over > 0)::INT AS BIGINT) AS override_rules, CAST(n_over AS BIGINT) AS override_hits FROM c"""
_SENTENCE = f"list_filter(flatten(list_transform(string_split(text, E'\\n'), lambda x: list_transform(string_split(regexp_replace(trim(x, {_WS}), '([.!?])\\s+', E'\\\\1\\u0001', 'g'), E'\\u0001'), lambda s: trim(s, {_WS})))), lambda s: s <> '')"
_SUFFIXES = "|".join(mining._by_length())

_OVER = "CASE WHEN doc_id % 10 = 7 THEN replace(text, 'of', 'OF') ELSE text END"
_PERCENT = "regexp_replace({0}, '([0-9]+)%', '\\1 %', 'g')"
_STAGES = _gated(f"replace({_PERCENT.format(_OVER)}, 'thth', 'th')", "and", "contains(near, 'ing')", "'und'") + f""",
f AS (SELECT p.path, coalesce(applied, 0) AS a, coalesce(held, 0) AS h, concat(g[1], coalesce(tail, '')) AS t FROM p LEFT JOIN r ON r.path = p.path),
d AS (SELECT doc_id AS path, CASE WHEN doc_id % 10 = 7 THEN {_count('text', 'of')} ELSE 0 END AS n_of, {_OVER} AS o FROM documents),
n AS (SELECT path, n_of, len(regexp_extract_all(o, '[0-9]+%')) AS n_pc, {_count(_PERCENT.format('o'), 'thth')} AS n_th, a, h, {_count('t', 'und')} AS n_und, {_count("replace(t, 'und', '&')", '  ')} AS n_sp FROM d JOIN f USING (path)),
u AS (SELECT 'override' AS stage, 'of' AS wrong, 'OF' AS "right", n_of AS n, 0 AS s FROM n UNION ALL SELECT 'regex', 'n%', 'n %', n_pc, 0 FROM n UNION ALL SELECT 'pair', 'thth', 'th', n_th, 0 FROM n
  UNION ALL SELECT 'pair', 'and', 'und', a, h FROM n UNION ALL SELECT 'pair', 'und', '&', n_und, 0 FROM n UNION ALL SELECT 'stable', '  ', ' ', n_sp, 0 FROM n)
SELECT stage, wrong, "right", CAST(sum(n) AS BIGINT) AS applied, CAST(sum(s) AS BIGINT) AS skipped FROM u GROUP BY ALL HAVING sum(n) + sum(s) > 0"""

SQL: dict[str, str] = {
    "rewrite_stages": _STAGES,
    "contextual_rules": _gated("text", "[a-z]ion", f"{_any(NEAR)} AND NOT contains(near, 'idiot')", "concat(left(m, 1), 'ION')") + _PLAIN,
    "family_rules": _gated("text", "the[a-z]*", _FAMILY, "concat('THE', substring(m, 4))") + _PLAIN,
    "plain_regexes": """WITH a AS (SELECT doc_id AS path, CAST(len(regexp_extract_all(text, '[a-z]+ing')) AS BIGINT) AS n1, regexp_replace(text, '([a-z]+)ing', '\\1ING', 'g') AS t FROM documents),
b AS (SELECT *, CAST(len(regexp_extract_all(t, '[0-9]+')) AS BIGINT) AS n2 FROM a)
SELECT path, '*ing' AS wrong, '*ING' AS "right", n1 AS applied FROM b WHERE n1 > 0 UNION ALL SELECT path, 'digits', '<n>', n2 FROM b WHERE n2 > 0""",
    "stable_rules": f"""WITH a AS (SELECT doc_id AS path, {_fold('text', STABLE)} AS t, {' + '.join(_count(_fold('text', STABLE[:i]), w) for i, (w, _) in enumerate(STABLE))} AS n FROM documents),
b AS (SELECT path, n + len(regexp_extract_all(t, '[a-z]\\.[A-Z]')) AS n, regexp_replace(t, '([a-z])\\.([A-Z])', '\\1. \\2', 'g') AS t FROM a)
SELECT path, CAST(n + len(regexp_extract_all(t, '[0-9]{{5,}}')) AS BIGINT) AS applied, {_NONE} AS skipped, md5(regexp_replace(t, '[0-9]{{5,}}', '#', 'g')) AS text_md5 FROM b""",
    "short_words": _gated(_ko("text"), SHORT[0], f"NOT (a > 0 AND regexp_matches(substring(text, a, 1), '{_WORD}')) AND NOT regexp_matches(substring(text, e + 1, 1), '{_WORD}') AND contains(near, {_q(DOMAIN)})", _q(SHORT[1])) + _SKIPS,
    "pair_gates": _PAIRS_SQL + f", c AS (SELECT doc_id AS path, {_count('text', 'and the')} AS n FROM documents) SELECT p.path, CAST(n + coalesce(applied, 0) AS BIGINT) AS applied, coalesce(held, 0) AS skipped, md5(concat(g[1], coalesce(tail, ''))) AS text_md5 FROM p JOIN c ON c.path = p.path LEFT JOIN r ON r.path = p.path",
    "path_overrides": f"""WITH d AS (SELECT doc_id AS path, text, doc_id % 10 = 7 AS seven, CAST(doc_id AS VARCHAR)[1] IN ('1', '2') AS low FROM documents),
a AS (SELECT *, CASE WHEN seven THEN {_count('text', 'and ')} ELSE 0 END AS n1, CASE WHEN seven THEN replace(text, 'and ', '& ') ELSE text END AS t FROM d),
b AS (SELECT *, CASE WHEN low THEN {_count('t', 'ung')} ELSE 0 END AS n2, CASE WHEN low THEN replace(t, 'ung', 'UNG') ELSE t END AS u FROM a)
SELECT path, CAST(n1 + n2 + CASE WHEN seven THEN {_count('u', 'an')} ELSE 0 END AS BIGINT) AS applied, {_NONE} AS skipped, md5(CASE WHEN seven THEN replace(u, 'an', 'AN') ELSE u END) AS text_md5 FROM b""",
    "run_metrics": _METRICS,
    "changed_documents": f"""WITH c AS (SELECT doc_id AS path, text, replace(replace(text, 'idiot', 'friend'), 'token = ', 'token: ') AS t FROM documents),
l AS (SELECT path, list_transform(string_split(t, E'\\n'), lambda x: trim(x, {_WS})) AS l FROM c WHERE t <> text),
k AS (SELECT path, list_filter(generate_series(1, len(l)), lambda i: NOT regexp_full_match(l[i], '([0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}}( *화자 *[0-9]+)?')) AS ok, l FROM l),
j AS (SELECT path, trim(regexp_replace(array_to_string(list_transform(ok, lambda i: l[i]), E'\\n'), '\\n{{3,}}', E'\\n\\n', 'g'), E'\\n') AS s FROM k)
SELECT path, 'done' AS status, md5(CASE WHEN s = '' THEN '' ELSE concat(s, E'\\n') END) AS script_md5 FROM j""",
    "report_lines_of_runs": f"""WITH c AS (SELECT doc_id AS path, replace(text, 'the', 'The') AS t FROM documents),
n AS (SELECT path, contains(t, 'The')::INT + contains(t, 'password')::INT + contains(t, 'idiot')::INT AS hits, len(list_filter(list_transform(string_split(t, E'\\n'), lambda x: trim(x, {_WS})), lambda x: x <> '' AND NOT regexp_full_match(x, '([0-9]{{1,2}}:)?[0-9]{{1,2}}:[0-9]{{2}}( *화자 *[0-9]+)?'))) AS lines FROM c)
SELECT path, concat('term_hits_after_correction: ', hits) AS line FROM n UNION ALL SELECT path, concat('script_lines_after_cleanup: ', lines) FROM n""",
    "paired_files": "SELECT concat(source, '/', doc_id, '.script.txt') AS path, concat(source, '/', doc_id, '.corrected.txt') AS corrected_path, md5(replace(text, 'the', 'The')) AS corrected_md5 FROM documents",
    "uncorrected_files": "SELECT concat(doc_id, '.txt') AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "term_seed": f"""WITH b AS (SELECT 0 AS side, seq, term FROM {_words('benchmark')} UNION ALL SELECT 1, c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey < 5),
f AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY side, seq) AS n FROM b) SELECT row_number() OVER (ORDER BY side, seq) - 1 AS seq, term FROM f WHERE n = 1""",
    "budget_files": f"SELECT doc_id, n_chars, spent FROM (SELECT doc_id, n_chars, CAST(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent FROM documents) WHERE spent + n_chars <= {BUDGET}",
    "running_chars": "SELECT doc_id, source, n_chars, CAST(coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, max(n_chars) OVER (PARTITION BY source ORDER BY doc_id) AS longest FROM documents",
    "quota_messages": "SELECT conv_id, turn, turn % 3 < 2 OR regexp_matches(lower(coalesce(text, '')), 'http 429|resource_exhausted|quota exceeded|rate limit') AS quota FROM conversations WHERE turn % 3 = 2 OR text IS NOT NULL UNION ALL SELECT conv_id, turn, false FROM conversations WHERE turn % 3 < 2 AND text IS NULL",
    "long_sentences": f"SELECT doc_id AS path, len(l) AS n, CAST(list_sum(list_transform(l, lambda s: length(s))) AS BIGINT) AS chars FROM (SELECT doc_id, list_filter({_SENTENCE}, lambda s: length(s) >= 14) AS l FROM documents) WHERE len(l) > 0",
    "keyword_first_sentences": f"""WITH s AS (SELECT doc_id AS path, {_SENTENCE} AS s FROM documents),
f AS (SELECT path, s, list_concat(list_filter(s, lambda x: contains(x, 'password')), list_filter(s, lambda x: contains(x, 'tion'))) AS h FROM s WHERE len(s) > 0),
u AS (SELECT path, s, list_filter(generate_series(1, len(h)), lambda i: list_position(h, h[i]) = i) AS spots, h FROM f)
SELECT path, md5(array_to_string(CASE WHEN len(spots) > 0 THEN list_transform(spots[1:2], lambda i: h[i]) ELSE s[1:2] END, '|')) AS picked_md5 FROM u""",
    "mined_candidates": f"""WITH t AS (SELECT token, count(*) AS count FROM (SELECT unnest(regexp_extract_all({_ko('text')}, {_TOKENS})) AS token FROM {_LINES}) GROUP BY token), d AS {_words('benchmark')},
c AS (SELECT token, count, regexp_replace(token, '^(.{{2,}}?)({_SUFFIXES})$', '\\1') AS stem FROM t WHERE count >= 2 AND token NOT IN (SELECT unnest({_list(mining.STOPWORDS)})) AND length(token) BETWEEN 2 AND 15 AND regexp_matches(token, '[가-힣0-9]') AND NOT regexp_matches(token, '({'|'.join(mining.ENDINGS)})$') AND token NOT IN (SELECT term FROM d))
SELECT token, count, stem, substring(token, length(stem) + 1) AS suffix FROM c WHERE length(stem) >= 2 AND regexp_matches(stem, '[가-힣0-9]') AND stem NOT IN (SELECT term FROM d)""",
}

ALL = (
    *(contextual_rules, family_rules, plain_regexes, stable_rules, short_words, pair_gates, path_overrides, run_metrics, changed_documents, report_lines_of_runs),
    *(paired_files, uncorrected_files, term_seed, budget_files, running_chars, quota_messages, long_sentences, concept_lists, keyword_first_sentences, mined_candidates),
)
