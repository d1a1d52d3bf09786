import random

import pytest

from lectern.llm.queries import tokenizer_path
from tests_llm_cases import words

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_take_effect_on_a_small_corpus(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(1)
    good = {i: (words(rng.randint(40, 120), 1000 + i) + ". ").capitalize() for i in range(300)}
    leak = words(15, 777)
    texts = dict(good)
    texts[1000] = good[3] + "tail"  # near copy
    texts[1001] = " ".join(rng.choice("!@#$%^&*") * 9 for _ in range(200))  # junk
    texts[1002] = words(60, 102) + " " + leak + " " + words(60, 103)
    texts[1003] = words(1500, 104) + " password=abcdef0123456789aa "
    rows = [(i, t, "en", "src", len(t)) for i, t in texts.items()] + [(3, good[3], "en", "src", len(good[3]))]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(250)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = docs.columns
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        ids.append(sorted(r["doc_id"] for r in docs.select("doc_id").collect()))
        if k == 3:
            masked = docs.where("doc_id = 1003").first()
            assert "[SECRET]" in masked["text"] and "abcdef0123" not in masked["text"] and masked["n_chars"] == len(masked["text"])
    start = sorted([*texts, 3])
    assert ids[0] == [i for i in start if i != 1001]
    assert ids[1] == [i for i in sorted(texts) if i not in (1000, 1001)]  # one row of each group
    assert ids[2] == [i for i in ids[1] if i != 1002] and ids[3] == ids[2] == ids[4]
