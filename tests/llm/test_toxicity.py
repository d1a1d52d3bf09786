import math
import random

import numpy as np

from lectern.llm import toxicity as tx
from tests_llm_cases import empty, odd, words

RUDE, THREAT = ["vile", "dolt", "creep"], ["smash", "hurt", "ruin"]


def made(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        w = words(rng.randint(5, 60), seed * 10_000 + i).split()
        toxic, threat = rng.random() < 0.3, False
        if toxic:
            w += rng.sample(RUDE, 2)
            threat = rng.random() < 0.5
        if threat:
            w += rng.sample(THREAT, 2)
        rng.shuffle(w)
        rows.append((i, " ".join(w).title(), int(toxic), int(threat)))
    return rows


def test_held_out_accuracy_and_chain(spark):
    train, test = made(700, 1), made(400, 2)
    df = spark.createDataFrame(train, "doc_id long, text string, toxic int, threat int")
    chain = tx.train(df.select("doc_id", "text"), df.select("doc_id", "toxic", "threat"), ["toxic", "threat"])
    assert len(chain.models[0].earlier) == 0 and len(chain.models[1].earlier) == 1 and chain.models[1].earlier[0] > 0
    held = spark.createDataFrame([r[:2] for r in test], "doc_id long, text string")
    got = {r["doc_id"]: r for r in tx.score(held, chain).collect()}
    for k, name in ((2, "is_toxic"), (3, "is_threat")):
        assert np.mean([got[r[0]][name] == bool(r[k]) for r in test]) > 0.98


def test_out_of_fold_is_not_in_sample():
    rng = np.random.default_rng(0)
    texts = [{b"w%d" % i} for i in range(100)]  # nothing to learn
    y = rng.integers(0, 2, (100, 2))
    chain = tx.fit_chain(["a", "b"], texts, y)
    assert not chain.models[0].words and abs(chain.models[0].intercept) < 1


def test_odd_rows(spark):
    labels = spark.createDataFrame([(5, 1), (6, 0), (6, 1), (7, None), (None, 1), (10, 0)], "doc_id long, toxic int")
    chain = tx.train(odd(spark), labels, ["toxic"])
    got = tx.score(odd(spark), chain).collect()
    assert len(got) == 13 and all(0 <= r["p_toxic"] <= 1 for r in got)
    bare = tx.train(odd(spark), labels.limit(0), ["toxic"])
    assert not any(r["is_toxic"] for r in tx.score(odd(spark), bare).collect())
    one = tx.train(odd(spark), labels.where("toxic = 1"), ["toxic"])
    assert not any(r["is_toxic"] for r in tx.score(odd(spark), one).collect())
    assert tx.score(empty(spark), chain).count() == 0


def slow_chain(names, train, test):
    """Probabilities of test rows by plain loops: (words, labels) and words; folds by place in train."""

    def sigmoid(x):
        return 1 / (1 + math.exp(-min(30, max(-30, x))))

    def odds(p):
        return min(8, max(-8, math.log(min(max(p, 1e-6), 1 - 1e-6) / min(max(1 - p, 1e-6), 1))))

    def fit(rows, y):
        if len(set(y)) < 2:
            return [], [], [0.0] * (len(rows[0][1]) + 1 if rows else 1), odds(sum(y) / len(y))
        n1, n0 = max(1, sum(y)), max(1, len(y) - max(1, sum(y)))
        score = []
        for w in {w for words, _ in rows for w in words}:
            b = sum(v for (words, _), v in zip(rows, y, strict=True) if w in words)
            a = sum(w in words for words, _ in rows) - b
            if a + b >= tx.LEAST_DOCS:
                s = (a + b) / (n0 + n1)
                score.append((-abs(b / n1 - a / n0) / math.sqrt(s * (1 - s) * (1 / n0 + 1 / n1) + 1e-12), w))
        words = [w for _, w in sorted(score)[: tx.WORDS]]
        x = np.array([[float(w in own) for w in words] + list(before) + [1.0] for own, before in rows])
        beta, ridge = np.zeros(x.shape[1]), np.array([tx.RIDGE] * (x.shape[1] - 1) + [1e-6])
        for _ in range(25):
            p = np.array([sigmoid(float(r @ beta)) for r in x])
            hess = sum(max(q * (1 - q), 1e-6) * np.outer(r, r) for q, r in zip(p, x, strict=True)) + np.diag(ridge)
            step = np.linalg.solve(hess, sum((v - q) * r for v, q, r in zip(y, p, x, strict=True)) - ridge * beta)
            beta = beta + step
            if np.abs(step).max() < 1e-6:
                break
        return words, beta, None, None

    def predict(model, own, before):
        words, beta, flat, intercept = model
        if flat is not None:
            return sigmoid(intercept)
        return sigmoid(sum(b for w, b in zip(words, beta, strict=False) if w in own) + sum(b * e for b, e in zip(beta[len(words) :], before, strict=False)) + beta[-1])

    before, models = [[] for _ in train], []
    for j in range(len(names)):
        y = [labels[j] for _, labels in train]
        rows = [(own, e) for (own, _), e in zip(train, before, strict=True)]
        folds = []
        for f in range(tx.FOLDS):
            inside = [k for k in range(len(rows)) if k % tx.FOLDS != f]
            folds.append(fit([rows[k] for k in inside], [y[k] for k in inside]))
        out = [odds(predict(folds[i % tx.FOLDS], own, e)) for i, (own, e) in enumerate(rows)]
        models.append(fit(rows, y))
        before = [[*e, o] for e, o in zip(before, out, strict=True)]
    result = []
    for own in test:
        e = []
        p = []
        for m in models:
            p.append(predict(m, own, e))
            e = [*e, odds(p[-1])]
        result.append(p)
    return result


def test_probabilities_equal_a_slow_chain():
    rows = made(140, 5)
    sets = [set(r[1].lower().encode().split()) for r in rows]
    labels = np.array([r[2:] for r in rows])
    chain = tx.fit_chain(["a", "b"], sets[:100], labels[:100])
    want = slow_chain(["a", "b"], list(zip(sets[:100], labels[:100].tolist(), strict=True)), sets[100:])
    assert np.abs(tx.predict(chain, sets[100:]) - np.array(want)).max() < 1e-9


def test_labels_named_like_columns_and_very_many_rows_of_one_id(spark, monkeypatch):
    rows = made(200, 3)
    df = spark.createDataFrame([(*r[:2], *r[2:], r[2], r[3]) for r in rows], "doc_id long, text string, t int, `order` int, `__id` int, words int")
    names = ["t", "order", "__id", "words"]
    chain = tx.train(df.select("doc_id", "text"), df.select("doc_id", *names), names)
    assert tx.score(df.select("doc_id", "text"), chain).columns[1:5] == [f"p_{n}" for n in names]
    monkeypatch.setattr(tx, "SAMPLE", 50)
    seen = []
    monkeypatch.setattr(tx, "fit_chain", lambda names, texts, labels: seen.append(len(texts)))
    many = spark.createDataFrame([(1, f"text {i}") for i in range(3000)] + [(1, "again")] * 3000, "doc_id long, text string")
    tx.train(many, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), ["toxic"])
    assert 10 < seen[0] < 150
