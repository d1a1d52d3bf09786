"""Dictionary mining: token and stem counts, and suggestions of replacements and terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import digits_to_sino, has_hangul, tokens
from lectern.operators.similar import closest
from lectern.sources.files import work_folder

# Suffixes peeled from tokens, endings of words that are no terms, and stop words.
SUFFIXES = (
    "으로", "에게", "에서", "부터", "까지", "처럼", "하고", "이라", "라고", "라는", "이면", "이나", "이며", "이예요", "이에요", "입니다", "예요",
    "죠", "요", "은", "는", "이", "가", "을", "를", "와", "과", "도", "만", "에", "로", "별", "께서", "께", "의",
)
ENDINGS = ("합니다", "했다", "하는", "하면", "하고", "해서", "하죠", "하잖아요", "거든요", "테니까요", "아니고", "라고", "니까", "네요", "요", "다")
TERM_ENDINGS = ("하잖아", "하잖아요", "하고", "하고요", "이고", "인가", "이라고", "라고", "거예요", "할거예요", "아", "어", "고", "요", "죠", "까", "네")
STOPWORDS = (
    "오늘", "부터", "어떻게", "고민", "많이", "어쨌든", "최대한", "뭐라", "그럴까", "이렇게", "기존", "생각", "시도", "왜", "그래서", "이것", "이게",
    "자기", "스스로", "얘기", "정답", "지나치게들", "대한", "작업", "작업들", "맞다", "틀리다", "접근", "중요", "먼저", "염두", "보시기", "바랍니다",
    "그냥", "우리", "주변", "모든", "부분", "부분들",
)
#: Similarity below this is never suggested.
LEAST_SIMILAR = 0.85
ONE_CHAR_SUFFIX, ONE_CHAR_SCORE = "별", 0.70


def _by_length() -> list[str]:
    return sorted(SUFFIXES, key=lambda s: (-len(s), s))


def suffix_of(token: Column) -> Column:
    """The longest suffix that leaves a stem of two characters or more, or ''."""
    return F.regexp_extract(token, f"^.{{2,}}?({'|'.join(_by_length())})$", 1)


def stem_of(token: Column) -> Column:
    return F.substring(token, F.lit(1), F.length(token) - F.length(suffix_of(token)))


def token_counts(lines: DataFrame) -> DataFrame:
    """(token, count, first): first is the smallest (path, line_no, place) at which it stands."""
    rows = lines.select("path", "line_no", F.posexplode(tokens(F.col("text"))).alias("at", "token"))
    return rows.groupBy("token").agg(F.count("*").alias("count"), F.min(F.struct("path", "line_no", "at")).alias("first"))


def stem_counts(counts: DataFrame) -> DataFrame:
    """(token, count, first) of the stems of two characters or more.

    The length is tested as a maximum, since a test of the stem itself would be moved to every token of the texts.
    """
    rows = counts.select(stem_of(F.col("token")).alias("token"), "count", "first").groupBy("token")
    return rows.agg(F.sum("count").alias("count"), F.min("first").alias("first"), F.max(F.length("token")).alias("size")).where("size >= 2").drop("size")


def _ends(token: Column, endings) -> Column:
    return token.rlike(f"({'|'.join(endings)})$")


def typo_candidates(counts: DataFrame, terms: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """(token, count, stem, suffix) of tokens that may be misspelt terms."""
    known = terms.select(F.col("term").alias("token")).union(pairs.select("wrong")).distinct()
    spoken = lambda c: has_hangul(c) | c.rlike("[0-9]")
    t = F.col("token")
    rows = counts.where((F.col("count") >= least) & ~t.isin(*STOPWORDS) & F.length(t).between(2, 15) & spoken(t) & ~_ends(t, ENDINGS))
    rows = rows.join(known, "token", "left_anti").select("token", "count", stem_of(t).alias("stem"), suffix_of(t).alias("suffix"))
    right = terms.select(F.col("term").alias("stem")).distinct()
    return rows.where((F.length("stem") >= 2) & spoken(F.col("stem"))).join(right, "stem", "left_anti")


def one_char_matches(stems: DataFrame, terms: DataFrame) -> DataFrame:
    """(stem, match): terms of equal length that differ in one place, first those with the same first character.

    Stems and terms meet on the forms that they take with one place blanked, an equi-join.
    """
    blanked = lambda c: F.explode(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.lit("\u0000"), F.substring(c, i + 1, F.length(c)))))
    left = stems.select("stem").distinct().select("stem", blanked(F.col("stem")).alias("form"))
    right = terms.where(~F.contains("term", F.lit(" "))).groupBy("term").agg(F.min("seq").alias("seq")).select("term", "seq", blanked(F.col("term")).alias("form"))
    both = left.join(right, "form").where("stem <> term")
    same = F.substring("stem", 1, 1) == F.substring("term", 1, 1)
    return both.groupBy("stem").agg(F.min_by("term", F.struct((~same).alias("other"), "seq")).alias("match"))


def suggest_replacements(counts: DataFrame, terms: DataFrame, pairs: DataFrame, least: int = 1, cutoff: float = 0.78, most: int = 30) -> DataFrame:
    """(wrong, right, count, reason, score): by digits spelt out, by similarity, or by one character.

    terms (seq, term) is a dictionary, whose terms are compared; the effective cutoff is at
    least LEAST_SIMILAR.  Candidates are written to a table, so texts are read for them once.
    """
    cutoff = max(cutoff, LEAST_SIMILAR)
    spark, table = counts.sparkSession, work_folder(counts.sparkSession, "candidates")
    counts.select("token", "count").write.parquet(f"{table}/counts")  # so that tests of a token are not moved to all its occurrences
    typo_candidates(spark.read.parquet(f"{table}/counts"), terms, pairs, least).write.parquet(f"{table}/rows")
    rows = spark.read.parquet(f"{table}/rows")
    plain = terms.where(~F.contains("term", F.lit(" "))).select("term")
    spelt = rows.select("stem").distinct().where("stem rlike '[0-9]'").select("stem", digits_to_sino(F.col("stem")).alias("spelt")).where("spelt <> stem")
    spelt = spelt.join(terms.select(F.col("term").alias("spelt")).distinct(), "spelt")
    near = closest(rows.select("stem"), plain, cutoff)
    single = one_char_matches(rows.where(F.col("suffix") == ONE_CHAR_SUFFIX), terms).withColumnRenamed("match", "single")
    out = rows.join(spelt, "stem", "left").join(near, "stem", "left").join(single, "stem", "left")
    with_suffix = lambda c: F.struct(F.concat(c, F.col("suffix")).alias("right"))
    choice = (
        F.when(F.col("spelt").isNotNull(), F.struct(F.concat("spelt", "suffix").alias("right"), F.lit("digit->korean").alias("reason"), F.lit(1.0).alias("score")))
        .when(F.col("match").isNotNull(), F.struct(F.concat("match", "suffix").alias("right"), F.format_string("similarity:%.2f", "score").alias("reason"), F.col("score").alias("score")))
        .when((F.col("suffix") == ONE_CHAR_SUFFIX) & F.col("single").isNotNull(), F.struct(F.concat("single", "suffix").alias("right"), F.lit("single-char-diff+별").alias("reason"), F.lit(ONE_CHAR_SCORE).alias("score")))
    )
    picked = out.withColumn("c", choice).where("c is not null and c.right <> token").select(F.col("token").alias("wrong"), "c.right", "count", "c.reason", "c.score")
    return picked.orderBy(F.desc("count"), F.desc("score"), "wrong").limit(most)


def related_to_terms(stems: DataFrame, terms: DataFrame) -> DataFrame:
    """Stems that begin or end with a term, or that a term begins or ends with.

    Both sides meet on their own heads and tails, so it is an equi-join at every size.
    """
    anchors = terms.where("length(term) >= 2 and not contains(term, ' ')").select("term").distinct()
    heads = lambda c: F.transform(F.sequence(F.lit(2), F.length(c)), lambda i: F.concat(F.lit("<"), F.substring(c, F.lit(1), i)))
    tails = lambda c: F.transform(F.sequence(F.lit(2), F.length(c)), lambda i: F.concat(F.lit(">"), F.substring(c, F.length(c) - i + 1, i)))
    whole = lambda c: F.array(F.concat(F.lit("<"), c), F.concat(F.lit(">"), c))
    s, t = F.col("token"), F.col("term")
    inside = stems.select("token", F.explode(F.concat(heads(s), tails(s))).alias("k")).join(anchors.select(F.explode(whole(t)).alias("k")), "k", "left_semi")
    around = stems.select("token", F.explode(whole(s)).alias("k")).join(anchors.select(F.explode(F.concat(heads(t), tails(t))).alias("k")).distinct(), "k", "left_semi")
    return inside.select("token").union(around.select("token")).distinct()


def suggest_terms(stems: DataFrame, terms: DataFrame, least: int = 2, most: int = 30) -> DataFrame:
    """(term, count): frequent stems related to known terms; ties go by first appearance.

    Where a stem stands first is only looked for among ties that may be in the result, since a
    struct's minimum is found by a sort of all tokens.
    """
    spark, table = stems.sparkSession, work_folder(stems.sparkSession, "related")
    t = F.col("token")
    fit = (F.col("count") >= least) & F.length(t).between(2, 12) & ~t.isin(*STOPWORDS) & has_hangul(t) & ~_ends(t, ENDINGS) & ~_ends(t, TERM_ENDINGS)
    stems.select("token", "count").write.parquet(f"{table}/stems")  # so that tests of a stem are not moved to all its occurrences
    spark.read.parquet(f"{table}/stems").where(fit).join(terms.select(F.col("term").alias("token")).distinct(), "token", "left_anti").write.parquet(f"{table}/fit")
    rows = spark.read.parquet(f"{table}/fit")
    rows.join(related_to_terms(rows, terms), "token", "left_semi").write.parquet(f"{table}/near")
    near = spark.read.parquet(f"{table}/near")
    last = near.orderBy(F.desc("count")).limit(most).agg(F.min("count")).first()[0]
    near = near.where(F.col("count") >= F.lit(last))
    ties = near.groupBy("count").agg(F.count("*").alias("n")).where("n > 1").select("count")
    near.join(ties, "count", "left_semi").select("token").write.parquet(f"{table}/tied")
    tied = spark.read.parquet(f"{table}/tied")
    if tied.isEmpty():
        return near.orderBy(F.desc("count")).limit(most).select(F.col("token").alias("term"), "count")
    first = stems.join(tied, "token", "left_semi").select("token", "first")
    return near.join(first, "token", "left").orderBy(F.desc("count"), "first").limit(most).select(F.col("token").alias("term"), "count")


def top_tokens(docs: DataFrame, k: int, key: str = "path", text_col: str = "text") -> DataFrame:
    """(key, token, count, rank) of each document's k commonest tokens; ties go by the token.

    Texts are dealt by key once, so neither their tokens nor the counts move again.
    """
    rows = docs.select(key, text_col).repartition(key).select(key, F.explode(tokens(F.col(text_col))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("count"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("count"), "token"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)
