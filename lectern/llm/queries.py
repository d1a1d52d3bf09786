"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import alignment, bpe, chat, decontaminate, embedding_dedup, jaccard_join, mixing, quality, secrets, toxicity, training_order, warc, whitening

#: Name of the tokenizer's file in the package public_tokenizers.
TOKENIZER = "word_bpe_49k.json"
#: Names of the files that are aligned.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_overlaps(docs, items))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    labels = _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.score(docs, toxicity.train(docs, labels, ["low_quality", "toxic"]))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.group(_table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = chat.from_turns(_table(spark, sf_dir, "conversations"))
    return chat.link(messages, {"respond": chat.RESPOND}, ["conv_id", "turn"])


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(_table(spark, sf_dir, "embeddings"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_samples(docs))
    return secrets.digest(secrets.scan(docs, model))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), *map(tokenizer_path, ALIGNED))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

OP9_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 9))) AS i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
dwins AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM docs, sizes, LATERAL (SELECT unnest(generate_series(1, len(w) - n + 1)) AS i) WHERE len(w) >= n),
hits AS (SELECT d.doc_id, d.i, d.n, w.item_id FROM dwins d JOIN wins w ON d.s = w.s AND d.n = w.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY 1),
found AS (SELECT doc_id, count(item_id) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


_SHINGLES = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(list_transform(generate_series(1, greatest(1, len(w) - 3)), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM docs WHERE len(w) > 0),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, any_value(a.n) + any_value(b.n) AS total, count(*) AS c FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common WHERE 100 * c >= 85 * (total - c)),
reach AS (SELECT u AS doc_id, u AS other FROM links UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u)
"""

OP2_SQL = _SHINGLES + """
SELECT d.doc_id, CAST(coalesce(len(s.s), 0) AS BIGINT) AS n_shingles, coalesce(r.c, d.doc_id) AS component_id, coalesce(k.class_id, d.doc_id) AS class_id
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS c FROM reach GROUP BY 1) r USING (doc_id)
LEFT JOIN (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(s)) AS class_id FROM sets) k USING (doc_id)
"""


OP3_SQL = """
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS content FROM conversations),
ids AS (
  SELECT *, CASE role WHEN 'user' THEN concat(conv_id, '-', turn) WHEN 'assistant' THEN concat(conv_id, '-', turn - 1) END AS call_id,
    CASE WHEN role = 'user' THEN concat(conv_id, '-', turn - 2) END AS after FROM m),
calls AS (SELECT DISTINCT call_id, after FROM ids WHERE role = 'user'),
depths AS (
  WITH RECURSIVE d AS (
    SELECT call_id, 0 AS depth FROM calls WHERE after NOT IN (SELECT call_id FROM calls)
    UNION ALL SELECT c.call_id, d.depth + 1 FROM calls c JOIN d ON c.after = d.call_id)
  SELECT * FROM d),
answered AS (SELECT DISTINCT call_id FROM ids WHERE role = 'assistant')
SELECT i.conv_id, i.turn, i.call_id,
  CASE WHEN i.call_id IS NULL THEN 'message' WHEN role = 'assistant' AND d.depth IS NULL THEN 'orphan'
    WHEN role = 'user' AND content = '' THEN 'invalid' WHEN role = 'user' AND a.call_id IS NULL THEN 'unanswered'
    WHEN role = 'user' THEN 'call' ELSE 'result' END AS status,
  CASE WHEN i.call_id IS NULL THEN 0 ELSE d.depth * 2 + CASE role WHEN 'user' THEN 1 ELSE 2 END END AS position,
  CASE WHEN role = 'user' AND content = '' THEN '$.prompt: under minLength' END AS errors,
  CASE role WHEN 'user' THEN concat('{"role":"assistant","tool_call":{"arguments":{"prompt":', to_json(content), ',"turn":', turn, '},"id":"', i.call_id, '","name":"respond"}}')
    WHEN 'assistant' THEN concat('{"content":', to_json(content), ',"role":"tool","tool_call_id":"', i.call_id, '"}')
    ELSE concat('{"content":', to_json(content), ',"role":', to_json(role), '}') END AS json
FROM ids i LEFT JOIN depths d USING (call_id) LEFT JOIN answered a USING (call_id)
"""

OP8_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM m
"""


OP11_SQL = """
WITH d AS (
  SELECT doc_id, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source),
o AS (
  SELECT *, 2 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
    coalesce(sum(2 * source_size) OVER before, 0) AS filled, coalesce(sum(weight) OVER before, 0) AS taken
  FROM s WINDOW before AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
share AS (
  SELECT CAST(150 * total - 100 * filled AS BIGINT) AS spare, CAST(weights - taken AS BIGINT) AS units
  FROM o WHERE (150 * total - 100 * filled) * weight <= cap * 100 * (weights - taken) ORDER BY taken LIMIT 1),
t AS (
  SELECT source, source_size, coalesce((SELECT least(CAST(cap AS DOUBLE), CAST(weight * spare AS DOUBLE) / CAST(100 * units AS DOUBLE)) FROM share), CAST(cap AS DOUBLE)) AS target
  FROM s JOIN (SELECT source AS name, cap FROM o) ON source IS NOT DISTINCT FROM name),
p AS (
  SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(budget // source_size, 2) ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + least(greatest(budget - epochs * source_size - before, 0), size) AS BIGINT) AS taken
FROM e
"""


def queries() -> dict[str, Query]:
    return {"op1_toxicity": op1_toxicity, "op2_jaccard_join": op2_jaccard_join, "op3_chat": op3_chat, "op4_bpe": op4_bpe, "op5_embedding_dedup": op5_embedding_dedup, "op6_secrets": op6_secrets, "op7_quality": op7_quality, "op8_warc": op8_warc, "op9_decontamination": op9_decontamination, "op10_training_order": op10_training_order, "op11_mixing": op11_mixing, "op12_alignment": op12_alignment, "op13_whitening": op13_whitening}


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": OP2_SQL, "op3_chat": OP3_SQL, "op8_warc": OP8_SQL, "op9_decontamination": OP9_SQL, "op11_mixing": OP11_SQL}
