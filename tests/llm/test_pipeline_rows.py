import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import quality
from lectern.llm.queries import tokenizer_path
from tests_llm_cases import LONG, empty, odd_rows, words
from tests_llm_cases import SCHEMA as ODD

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, sf, rows, schema=SCHEMA, labels=250, benchmark=()):
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(labels)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")


def test_rows_without_an_id_and_with_one_id_are_judged_by_themselves(spark, tmp_path):
    rng = random.Random(1)
    good = {i: (words(rng.randint(40, 120), 1000 + i) + ". ").capitalize() for i in range(300)}
    junk = " ".join(rng.choice("!@#$%^&*") * 9 for _ in range(200))
    other = words(80, 5000) + ". "
    rows = [*good.items(), (None, other), (None, other + "tail"), (None, good[7] + "tail"), (None, junk), (260, junk)]  # 260 has no label
    rows += [(11, good[11])] * 3 + [(12, third := words(90, 6000) + ".")]  # another text of document 12
    sf = str(tmp_path / "sf")
    write(spark, sf, [(i, t, "en", "src", len(t)) for i, t in rows])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = corpus_pipeline.quality_stage(spark, docs, sf)
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    docs.write.parquet(f"{tmp_path}/0")
    docs = spark.read.parquet(f"{tmp_path}/0")
    texts = sorted((str(r["doc_id"]), r["text"]) for r in docs.collect())
    assert texts == sorted((str(i), t) for i, t in rows if t != junk)
    left = corpus_pipeline.near_duplicate_stage(spark, docs, sf)
    assert left.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sorted(x for x in left if x[0] is not None) == sorted([*good.items(), (12, third)])
    assert len(bare := [t for i, t in left if i is None]) == 1 and bare[0] in (other, other + "tail")


def slow_groups(rows, size, per):
    """Smallest id of each row's group, over all pairs."""
    sets = [{tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if (w := t.lower().split()) else set() for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= per * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), key), key)
    return [least[find(i)] for i in range(len(rows))]


def test_pipeline_equals_slow_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(4)
    leak = words(14, 900)
    texts = {i: words(rng.randint(30, 90), 2000 + i) + "." for i in range(260)}
    texts |= {300 + i: texts[i].replace(".", " " + words(i % 9, 77)) for i in range(40)}
    texts |= {400 + i: f"{words(40, 600 + i)} {leak} {words(40, 700 + i)}" for i in range(5)}
    texts |= {500 + i: words(50, 800 + i) + f" api_key = {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(5)}
    texts |= {600: "#$% " * 300, 601: "", 602: LONG[:150_000]}
    sf = str(tmp_path / "sf")
    write(spark, sf, [(i, t, None if i % 3 else "en", "s", len(t)) for i, t in texts.items()], benchmark=[(1, leak)])
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rejected = {r["doc_id"] for r in quality.score(docs, labels).where("rejected").collect()}
    assert {600, 601} <= rejected
    rows = [(i, t) for i, t in texts.items() if i not in rejected]
    rows = [r for r, g in zip(rows, slow_groups(rows, 5, 80), strict=True) if r[0] == g]
    rows = [r for r in rows if f" {leak} " not in f" {r[1]} "]
    stage3 = docs.where(F.col("doc_id").isin([i for i, _ in rows]))
    masked = {r["doc_id"]: r["text"] for r in corpus_pipeline.secrets_stage(spark, stage3, sf).collect()}
    tokenizer = Tokenizer.from_file(tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, _ in rows:
        assert i < 500 or i == 602 or "[SECRET]" in masked[i]
        ids = tokenizer.encode(masked[i], add_special_tokens=False).ids
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and len(want) > 200 and 602 in want


def test_odd_rows_clashing_columns_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path / "odd")
    names = ODD + ", `__id` long, `__text` string, `__row` int, `__h` long, tag int"
    write(spark, sf, [(*r, 1, "t", 2, 3, 4) for r in odd_rows()], names, labels=12)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert {(r["__id"], r["__text"], r["__row"], r["__h"], r["tag"]) for r in out.collect()} <= {(1, "t", 2, 3, 4)}
    assert corpus_pipeline.run(spark, sf).count() <= len(odd_rows())
    sf = str(tmp_path / "none")
    write(spark, sf, [], labels=0)
    assert corpus_pipeline.run(spark, sf).count() == 0
    assert empty(spark).count() == 0
