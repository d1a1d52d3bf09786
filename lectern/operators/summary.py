"""Extractive summaries: keywords, scored sentences, themes, concepts and study texts.

Ties that a hash order would settle go by the term itself.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import SPACE, let, occurrences, title_tokens
from lectern.operators.search import with_terms
from lectern.operators.segments import ENDS, sentence_list
from lectern.sources.files import work_folder

# Words that are no keywords.
STOPWORDS = (
    "이렇게", "그렇죠", "그러니까", "거예요", "거에요", "이게", "그게", "있는", "있어요", "있고", "있습니다", "하는데", "하면은", "그", "이", "저", "요",
    "그리고", "그런데", "그래서", "하지만", "때문", "부분", "정도", "이런", "저런", "그냥", "지금", "경우", "대한", "이야기", "내용", "있다", "없다",
    "한다", "된다", "합니다", "하는", "에서", "으로", "까지", "에게", "하기", "하면", "때", "것", "수", "좀", "더", "등", "관련", "통해", "기준", "상태",
    "부분들", "부분이", "것들", "하죠", "하는거", "같은", "이런식", "여기", "저기", "이번", "저번", "이제", "먼저", "다시", "사실",
)
# Headings, by which other tools find the parts of a study text.
HEADINGS = ("## 🔖 핵심 주제별로 나눠서 정리해줘", "## 📑 시험문제를 만들어줘", "## 📗 꼭 공부해야 할 내용을 알려줘", "### 핵심 키워드 정의", "### 단계별 이해 흐름")
#: Words of themes of a text without keywords, and this library's own wording of what stands in a study text.
NO_THEMES = (("요점", "용어"), ("짜임", "연결"), ("쓰임", "사례"))
NO_SENTENCE = "이 주제의 낱말이 든 문장이 없습니다."
QUESTION = "- 문제(%s): `%s`와(과) `%s`는 서로 어떻게 이어집니까?"
ANSWER = "- 풀이: `%s`의 뜻을 먼저 밝히고, 본문에서 `%s`와(과) 함께 쓰인 자리를 들어 설명합니다."
DEFINITION = "- **%s**: 본문에 자주 나오는 낱말. 처음 나온 문장에서 뜻을 찾아 적어 두세요."
FLOW = (
    "1. 낱말의 뜻을 본문에서 찾아 적는다.",
    "2. 함께 나오는 낱말끼리 줄로 잇는다.",
    "3. 이은 낱말로 새 문장을 지어 본다.",
    "4. 헷갈린 낱말은 문제를 다시 풀며 고친다.",
)
#: Tokens that are scored, and those of them that are English.
SPOKEN, ENGLISH = "[가-힣A-Za-z]{2,}", "^[A-Za-z]+$"
KEYWORDS, THEME_SIZE, THEMES, CONCEPTS = 16, 4, 3, 5


def words(text: Column) -> Column:
    """Hangul words as they are and English words in lower case, of two letters or more."""
    return F.concat(F.regexp_extract_all(text, F.lit("[가-힣]{2,}"), F.lit(0)), F.regexp_extract_all(F.lower(text), F.lit("[a-z]{2,}"), F.lit(0)))


def term_counts(docs: DataFrame, terms: list[str], path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, term, count) of domain terms by non-overlapping occurrences."""
    rows = with_terms(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")), sorted(set(terms)))
    counted = F.transform("found", lambda t: F.struct(t.alias("term"), occurrences(F.col("text"), t).alias("count")))
    return rows.select("path", F.explode(counted).alias("x")).select("path", "x.*")


def _apart(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Documents whose path has one row, and those whose path has more, if any; only the paths are read for that."""
    again = docs.groupBy("path").agg(F.count("*").alias("n")).where("n > 1").select(F.col("path").alias("again"))
    if again.isEmpty():
        return docs, None
    same = F.col("path").eqNullSafe(F.col("again"))
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def _counted(said: Column) -> Column:
    """(keyword, count) of the different words of an array, by one sort and the places where a word begins."""
    starts = lambda w: F.array_compact(F.transform(w, lambda x, i: F.when((i == 0) | (x != F.get(w, i - 1)), i)))
    one = lambda w, at: lambda s, k: F.struct(F.get(w, s).alias("keyword"), (F.coalesce(F.get(at, k + 1), F.size(w)) - s).cast("long").alias("count"))
    return let(F.sort_array(said), lambda w: let(starts(w), lambda at: F.transform(at, one(w, at))))


def _keyed(docs: DataFrame, terms: list[str], limit: int) -> DataFrame:
    """(path, text, best) of documents whose path has one row: an array of their keywords (other, less, keyword) in order."""
    place = lambda other, n, word: F.struct(F.lit(other).alias("other"), (-n).alias("less"), word.alias("keyword"))
    domain = F.transform("found", lambda t: place(0, occurrences(F.col("text"), t), t))
    free = F.filter(_counted(words(F.col("text"))), lambda x: ~x["keyword"].isin(*STOPWORDS) & ~F.array_contains("found", x["keyword"]))
    best = F.slice(F.sort_array(F.concat(domain, F.transform(free, lambda x: place(1, x["count"], x["keyword"])))), 1, limit)
    return with_terms(docs, sorted(set(terms))).select("path", "text", F.coalesce(best, F.array().cast("array<struct<other:int,less:bigint,keyword:string>>")).alias("best"))


def keywords(docs: DataFrame, terms: list[str], limit: int = KEYWORDS, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, rank, keyword, is_domain, count): domain terms first, then frequent words.

    The words of a document are counted within its row, so none of them move.  Only of paths with
    several rows they are counted together as rows.
    """
    own, shared = _apart(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")))
    ranked = lambda path, text, found: ((i, w, other == 0, -less) for i, (other, less, w) in enumerate(_best(text, found, limit), 1))
    out = _within(own, terms, ranked, rank=pa.int32(), keyword=pa.string(), is_domain=pa.bool_(), count=pa.int64())
    return out if shared is None else out.unionByName(_keyword_rows(shared, terms, limit))


#: The patterns of words() and segments.sentence_list(), for texts that Python has; str.splitlines() and str.strip() know the same line ends and blanks.
_HANGUL, _LATIN, _END = re.compile("[가-힣]{2,}"), re.compile("[a-z]{2,}"), re.compile(f"([{re.escape(ENDS)}]){SPACE}+")
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}


def _words(text: str) -> list[str]:
    """What words() gives."""
    latin = _LATIN.findall(text.lower())
    return latin if text.isascii() else _HANGUL.findall(text) + latin


def _sentences(text: str) -> Iterator[str]:
    """What segments.sentence_list() gives."""
    for line in text.splitlines():
        parts = [*_END.split(line.strip()), ""]  # what stands before each end, and the end
        for a, b in zip(parts[::2], parts[1::2], strict=True):
            if s := (a + b).strip():
                yield s


def _best(text: str | None, found: list[str], limit: int) -> list[tuple[int, int, str]]:
    """(other, less, keyword) of a text's keywords in order, as in _keyed()."""
    if text is None:
        return []
    domain = sorted((0, -text.count(t), t) for t in found)
    said = Counter(_words(text))
    for w in (*STOPWORDS, *found):
        said.pop(w, None)
    return [*domain, *heapq.nsmallest(limit - len(domain), ((1, -n, w) for w, n in said.items()))][:limit]


def _in_order(text: str | None, keys: set[str]) -> list[tuple[int, int, str]]:
    """(less, pos, sentence): a text's sentences, the best first, by the same score as _score()."""
    score = lambda s: sum(map(keys.__contains__, _words(s))) + (20 <= len(s) <= 220)
    return sorted((-score(s), pos, s) for pos, s in enumerate(_sentences(text or "")))


def _within(docs: DataFrame, terms: list[str], make: Callable[..., Iterable[tuple]], **kinds: pa.DataType) -> DataFrame:
    """(path, *kinds): the rows that make(path, text, terms found) gives of each document (path, text), in one pass over the texts."""
    names = ["path", *kinds]

    def rows(batches):
        for batch in batches:
            at, columns = [], [[] for _ in kinds]
            for k, given in enumerate(zip(*(batch.column(c).to_pylist() for c in ("path", "text", "found")), strict=True)):
                for row in make(*given):
                    at.append(k)
                    for column, x in zip(columns, row, strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("path").take(pa.array(at, pa.int64())), *map(pa.array, columns, kinds.values())], names)

    schema = f"path {docs.schema['path'].dataType.simpleString()}, " + ", ".join(f"{n} {_SQL[k]}" for n, k in kinds.items())
    return with_terms(docs, sorted(set(terms))).mapInArrow(rows, schema)


def document_sentences(docs: DataFrame, terms: list[str], most: int, limit: int = KEYWORDS, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """scored_sentences() of documents by their own keywords(), up to a rank; all of it is made where a text is, so no text moves.

    Only of paths with several rows texts meet their keywords by a join.  A document without a path has no keywords.
    """
    own, shared = _apart(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")))

    def ranked(path, text, found):
        keys = {w for _, _, w in _best(text, found, limit)} if path is not None else set()
        return ((pos, s, -less, i) for i, (less, pos, s) in enumerate(_in_order(text, keys)[:most], 1))

    out = _within(own, terms, ranked, pos=pa.int32(), sentence=pa.string(), score=pa.int32(), rank=pa.int32())
    return out if shared is None else out.unionByName(scored_sentences(shared, _keyword_rows(shared, terms, limit)).where(F.col("rank") <= most))


def document_themes(docs: DataFrame, terms: list[str], bullets: int = 4, limit: int = KEYWORDS, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """theme_sentences() of documents by the themes of their own keywords(), made as in document_sentences()."""
    own, shared = _apart(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")))

    def picked(path, text, found):
        keys = [w for _, _, w in _best(text, found, limit)] if path is not None else []
        every = list(dict.fromkeys(s for _, _, s in _in_order(text, set(keys)))) if keys else []
        for theme in range(min(THEMES, -(-len(keys) // THEME_SIZE))):
            ws = keys[theme * THEME_SIZE : (theme + 1) * THEME_SIZE]
            said = [s for s in every if any(w in s for w in ws)] or [s for s in every if len(s) >= 20]
            yield from ((theme, n, s) for n, s in enumerate(said[:bullets], 1))

    out = _within(own, terms, picked, theme=pa.int32(), n=pa.int32(), sentence=pa.string())
    if shared is None:
        return out
    keys = _keyword_rows(shared, terms, limit)
    return out.unionByName(theme_sentences(scored_sentences(shared, keys), themes(keys), bullets))


def _ranked(rows: DataFrame) -> DataFrame:
    out = rows.select("path", F.posexplode("best").alias("at", "x"))
    return out.select("path", (F.col("at") + 1).alias("rank"), "x.keyword", (F.col("x.other") == 0).alias("is_domain"), (-F.col("x.less")).alias("count"))


def _keyword_rows(docs: DataFrame, terms: list[str], limit: int) -> DataFrame:
    """The same of documents whose path has several rows."""
    domain = term_counts(docs, terms).select("path", F.col("term").alias("keyword"), "count", F.lit(True).alias("is_domain"))
    free = docs.select("path", F.explode(words(F.col("text"))).alias("keyword")).where(~F.col("keyword").isin(*STOPWORDS))
    free = free.groupBy("path", "keyword").agg(F.count("*").alias("count")).join(domain.select("path", "keyword"), ["path", "keyword"], "left_anti")
    both = domain.unionByName(free.withColumn("is_domain", F.lit(False)))
    rank = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("is_domain"), F.desc("count"), "keyword"))
    return both.withColumn("rank", rank).where(F.col("rank") <= limit).select("path", "rank", "keyword", "is_domain", "count")


def _score(sentence: Column, keys: Column) -> Column:
    return F.size(F.filter(words(sentence), lambda w: F.array_contains(keys, w))) + F.length(sentence).between(20, 220).cast("int")


def scored_sentences(docs: DataFrame, keys: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, pos, sentence, score, rank): words that are keywords, and one for a medium length.

    Texts meet their keywords before they are cut, and sentences are ranked where their text is.
    """
    own = keys.groupBy("path").agg(F.collect_set("keyword").alias("keys"))  # as many as KEYWORDS
    rows = docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")).join(own, "path", "left").withColumn("keys", F.coalesce("keys", F.array().cast("array<string>")))
    each = F.transform(sentence_list(F.col("text")), lambda s: F.struct(s.alias("sentence"), _score(s, F.col("keys")).alias("score")))
    ranked = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("score"), "pos"))
    return rows.select("path", F.posexplode(each).alias("pos", "x")).select("path", "pos", "x.sentence", "x.score").withColumn("rank", ranked)


def themes(keys: DataFrame) -> DataFrame:
    """(path, theme, words): the first keywords in groups, at most THEMES of them."""
    theme = F.floor((F.col("rank") - 1) / THEME_SIZE).cast("int")
    rows = keys.withColumn("theme", theme).where(F.col("theme") < THEMES).groupBy("path", "theme")
    return rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "keyword"))), lambda x: x["keyword"]).alias("words"))


def _by_theme(scored: DataFrame, groups: DataFrame, limit: int) -> DataFrame:
    """(path, theme, said): the best different sentences of every theme in order, which may be none."""
    once = scored.groupBy("path").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("rank", "sentence"))), lambda x: x["sentence"])).alias("every"))
    themes_ = groups.groupBy("path").agg(F.collect_list(F.struct("theme", "words")).alias("themes"))
    rows = themes_.join(once, "path", "left").withColumn("every", F.coalesce("every", F.array().cast("array<string>")))
    return rows.select("path", F.inline(_picked(F.col("themes"), F.col("every"), limit))).select("path", "theme", "said")


def _picked(themes_: Column, every: Column, limit: int) -> Column:
    """Themes (theme, words), each with the best of a document's sentences, which are in order."""
    having = lambda ws: F.filter(every, lambda s: F.exists(ws, lambda w: F.contains(s, w)))
    best = lambda own: F.slice(F.when(F.size(own) > 0, own).otherwise(F.filter(every, lambda s: F.length(s) >= 20)), 1, limit)
    return F.transform(themes_, lambda t: F.struct(t["theme"].alias("theme"), t["words"].alias("words"), let(having(t["words"]), best).alias("said")))


def theme_sentences(scored: DataFrame, groups: DataFrame, limit: int = 4) -> DataFrame:
    """(path, theme, n, sentence): the best different sentences with a word of the theme.

    A theme that no sentence has takes the best sentences of 20 characters or more.
    """
    rows = _by_theme(scored, groups, limit).select("path", "theme", F.posexplode("said").alias("at", "sentence"))
    return rows.select("path", "theme", (F.col("at") + 1).alias("n"), "sentence")


def concepts(docs: DataFrame, keys: DataFrame, size: int = CONCEPTS, path_col: str = "path") -> DataFrame:
    """(path, n, concept, peer): title words, domain keywords, all keywords; padded, peers in a ring."""
    stem = F.regexp_replace(F.regexp_extract(F.col(path_col), r"([^/]+)$", 1), r"\.[^./]+$", "")
    title = docs.select(F.col(path_col).alias("path"), F.posexplode(title_tokens(stem)).alias("at", "concept")).withColumn("tier", F.lit(0))
    every = keys.select("path", F.col("rank").alias("at"), F.col("keyword").alias("concept"), F.when(F.col("is_domain"), 1).otherwise(2).alias("tier"))
    once = title.unionByName(every).groupBy("path", "concept").agg(F.min(F.struct("tier", "at")).alias("place"))
    n = F.row_number().over(Window.partitionBy("path").orderBy("place"))
    kept = once.withColumn("n", n).where(F.col("n") <= size).groupBy("path").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "concept"))), lambda x: x["concept"]).alias("found"))
    every_path = docs.select(F.col(path_col).alias("path")).join(kept, "path", "left").withColumn("found", F.coalesce("found", F.array().cast("array<string>")))
    full = F.transform(F.sequence(F.lit(1), F.lit(size)), lambda i: F.coalesce(F.get("found", i - 1), F.concat(F.lit("핵심개념"), i.cast("string"))))
    return every_path.withColumn("all", full).select("path", F.posexplode("all").alias("i", "concept"), "all").select("path", (F.col("i") + 1).alias("n"), "concept", F.get("all", (F.col("i") + 1) % size).alias("peer"))


def _no_themes() -> Column:
    return F.array(*(F.struct(F.lit(i).alias("theme"), F.array(*map(F.lit, ws)).alias("words")) for i, ws in enumerate(NO_THEMES)))


def _outlined(docs: DataFrame, terms: list[str], bullets: int) -> DataFrame:
    """(path, best, themes) of documents whose path has one row: keywords, and themes with their sentences, all made within the row."""
    rows = _keyed(docs, terms, KEYWORDS).withColumn("own", F.transform("best", lambda x: x["keyword"]))
    ordered = F.transform(sentence_list(F.col("text")), lambda s, i: F.struct((-_score(s, F.col("own"))).alias("less"), i.alias("pos"), s.alias("sentence")))
    every = F.array_distinct(F.transform(F.sort_array(ordered), lambda x: x["sentence"]))
    rows = rows.select("path", "best", "own", F.coalesce(every, F.array().cast("array<string>")).alias("every"))
    cut = F.transform(F.array(*map(F.lit, range(THEMES))), lambda t: F.struct(t.alias("theme"), F.slice("own", t * THEME_SIZE + 1, THEME_SIZE).alias("words")))
    groups = F.when(F.size("own") > 0, F.filter(cut, lambda t: F.size(t["words"]) > 0)).otherwise(_no_themes())
    return rows.select("path", "best", _picked(groups, F.col("every"), bullets).alias("themes"))


def _outlined_rows(docs: DataFrame, terms: list[str], bullets: int) -> DataFrame:
    """The same of documents whose path has several rows."""
    keys = _keyword_rows(docs, terms, KEYWORDS)
    bare = docs.select("path").distinct().join(keys.select("path").distinct(), "path", "left_anti")
    groups = themes(keys).unionByName(bare.select("path", F.inline(_no_themes())))
    said = groups.join(_by_theme(scored_sentences(docs, keys), groups, bullets), ["path", "theme"])
    said = said.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("theme", "words", "said"))).alias("themes"))
    best = keys.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("rank", "keyword", "is_domain", "count"))).alias("x"))
    best = best.select("path", F.transform("x", lambda x: F.struct(F.when(x["is_domain"], 0).otherwise(1).alias("other"), (-x["count"]).alias("less"), x["keyword"].alias("keyword"))).alias("best"))
    return said.join(best, "path", "left").select("path", F.coalesce("best", F.array().cast("array<struct<other:int,less:bigint,keyword:string>>")).alias("best"), "themes")


def sections(docs: DataFrame, terms: list[str], bullets: int = 4, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, part, n, line): the lines of a summary in order: title, themes, questions, definitions, flow.

    A text without keywords has the themes NO_THEMES; a theme without a sentence has NO_SENTENCE.
    Texts are read once, for a table of keywords, themes and their sentences, of which all lines are made.
    """
    paths = docs.select(F.col(path_col).alias("path"))
    own, shared = _apart(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")))
    table = work_folder(docs.sparkSession, "outlines")
    _outlined(own, terms, bullets).write.parquet(table)
    if shared is not None:
        _outlined_rows(shared, terms, bullets).write.mode("append").parquet(table)
    outlines = docs.sparkSession.read.parquet(table)
    keys, groups = _ranked(outlines), outlines.select("path", F.inline("themes"))
    place = lambda part, n, line: (F.lit(part).alias("part"), n.cast("int").alias("n"), line.alias("line"))
    head = F.concat(F.lit("### 주제 "), (F.col("theme") + 1).cast("string"), F.lit(". "), F.concat_ws(", ", F.slice("words", 1, 2)))
    heads = groups.select("path", *place(1, F.col("theme") * 100, head))
    told = F.posexplode(F.when(F.size("said") > 0, F.col("said")).otherwise(F.array(F.lit(NO_SENTENCE)))).alias("at", "sentence")
    told = groups.select("path", "theme", told).select("path", *place(1, F.col("theme") * 100 + F.col("at") + 1, F.concat(F.lit("- "), "sentence")))
    ends = groups.select("path", *place(1, F.col("theme") * 100 + 99, F.lit("")))
    ring = concepts(docs, keys, path_col=path_col)
    kind = F.when(F.col("n") % 2 == 1, "객관식").otherwise("단답형")
    three = F.array(F.concat(F.col("n").cast("string"), F.lit(". 개념: "), "concept"), F.format_string(QUESTION, kind, "concept", "peer"), F.format_string(ANSWER, "concept", "peer"))
    asked = ring.select("path", "n", F.posexplode(three).alias("i", "line")).select("path", *place(2, F.col("n") * 10 + F.col("i"), F.col("line")))
    both = ring.select("path", F.col("concept").alias("term"), "n").unionByName(keys.where("rank <= 5").select("path", F.col("keyword").alias("term"), (F.col("rank") + 100).alias("n")))
    defined = both.groupBy("path", "term").agg(F.min("n").alias("n")).select("path", *place(3, F.col("n"), F.format_string(DEFINITION, "term")))
    stem = F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), r"\.[^./]+$", "")
    one = lambda part, n, line: F.struct(F.lit(part).alias("part"), F.lit(n).alias("n"), line.alias("line"))
    fixed = [(2, 0, HEADINGS[1]), (2, 1, ""), (2, 1000, ""), (3, -3, HEADINGS[2]), (3, -2, ""), (3, -1, HEADINGS[3]), (3, 1000, ""), (4, 0, HEADINGS[4]), *((4, i, line) for i, line in enumerate(FLOW, 1))]
    first = [one(0, 0, F.concat(F.lit("# "), stem, F.lit(" 요약"))), *(one(0, i, F.lit(line)) for i, line in enumerate(("", HEADINGS[0], ""), 1))]
    frame = paths.select("path", F.inline(F.array(*first, *(one(p, n, F.lit(line)) for p, n, line in fixed))))
    out = frame
    for rows in (heads, told, ends, asked, defined):
        out = out.unionByName(rows)
    return out


def study_texts(lines_: DataFrame) -> DataFrame:
    """(path, text): the whole text of each document of sections()."""
    rows = lines_.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("part", "n", "line"))).alias("x"))
    return rows.select("path", F.concat(F.array_join(F.transform("x", lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))


def biased_scores(docs: DataFrame, terms: list[str], bias: int = 1000, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, keyword, score): occurrences of domain terms plus a bias, and one for each token that is not English.

    As in keywords(), a document is counted within its row.
    """
    own, shared = _apart(docs.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")))
    rows = with_terms(own, sorted(set(terms)))
    entry = lambda word, n: F.struct(word.alias("keyword"), n.cast("long").alias("score"))
    domain = F.transform("found", lambda t: entry(t, occurrences(F.col("text"), t) + bias))
    free = F.filter(_counted(F.regexp_extract_all("text", F.lit(SPOKEN), F.lit(0))), lambda x: ~x["keyword"].isin(*STOPWORDS) & ~x["keyword"].rlike(ENGLISH))
    same = lambda e, i, x: F.coalesce(F.get(e, i)["keyword"] == x["keyword"], F.lit(False))
    total = lambda e, i, x: entry(x["keyword"], x["score"] + F.when(same(e, i + 1, x), F.get(e, i + 1)["score"]).otherwise(0))
    # A keyword has two entries at most, side by side.
    summed = let(F.sort_array(F.concat(domain, F.transform(free, lambda x: entry(x["keyword"], x["count"])))), lambda e: F.array_compact(F.transform(e, lambda x, i: F.when(~same(e, i - 1, x), total(e, i, x)))))
    out = rows.select("path", F.inline(summed))
    return out if shared is None else out.unionByName(_biased_rows(shared, terms, bias))


def _biased_rows(docs: DataFrame, terms: list[str], bias: int) -> DataFrame:
    """The same of documents whose path has several rows."""
    domain = term_counts(docs, terms).select("path", F.col("term").alias("keyword"), (F.col("count") + bias).alias("score"))
    free = docs.select("path", F.explode(F.regexp_extract_all("text", F.lit(SPOKEN), F.lit(0))).alias("keyword")).where(~F.col("keyword").isin(*STOPWORDS) & ~F.col("keyword").rlike(ENGLISH))
    return domain.unionByName(free.withColumn("score", F.lit(1).cast("long"))).groupBy("path", "keyword").agg(F.sum("score").alias("score"))


def distinct_concepts(candidates: Column, limit: int = 10) -> Column:
    """An ordered list without repeats and without short words inside a word that is already there."""
    step = lambda a, c: F.when((F.size(a) >= limit) | (c == "") | F.exists(a, lambda x: (x == c) | (F.contains(x, c) & (F.length(c) <= 2))), a).otherwise(F.array_append(a, c))
    return F.aggregate(candidates, F.array().cast("array<string>"), step)


def keyword_sentences(sentences: Column, keys: Column, limit: int = 2) -> Column:
    """Keywords outermost: the first different sentences that have them, else the first sentences."""
    having = lambda k: F.filter(sentences, lambda s: F.contains(s, k))
    found = F.slice(F.array_distinct(F.flatten(F.transform(keys, having))), 1, limit)
    return F.when(F.size(found) > 0, found).otherwise(F.slice(sentences, 1, limit))
