"""Toxicity by a classifier chain: linear models of categories, each fed the earlier ones.

The model of a category is a logistic regression on which of its telling words a text has, and
on the log odds that the earlier categories of the chain got.  In training those are
out-of-fold: a row's earlier probabilities come from models that never saw it, as will be so for
new texts.  Words are chosen within each fold too.  A category's threshold is the one with the
best F1 over the out-of-fold probabilities.

The models are fitted on a bounded sample of labelled rows (SAMPLE); every text is scored whole.

Defined results: null and empty texts have no words and are scored by the intercepts; rows whose
labels are null in a category of the chain do not train; repeated labels of a document count as
one row with the largest values; equal texts of one id train once, and of an id with very many texts a share; without both values of a category in the sample its
probability is their share and nothing is marked; repeated rows each get a row; an empty table
gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import slices, texts_of, tidy
from lectern.llm.decontaminate import words_of

#: About so many labelled rows train the chain.
SAMPLE = 4_000
FOLDS, WORDS, LEAST_DOCS, RIDGE = 5, 300, 5, 1.0


@dataclass
class Model:
    """Weights of words, of earlier categories' log odds, and the intercept."""

    words: dict[bytes, float]
    earlier: np.ndarray
    intercept: float


@dataclass
class Chain:
    names: list[str]
    models: list[Model]
    limits: list[float]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _odds(p):
    return np.clip(np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1)), -8, 8)


def _telling(texts: list[set], y: np.ndarray) -> list[bytes]:
    """Words whose share of documents differs most between the classes, in standard errors."""
    counts: dict[bytes, list[int]] = {}
    for words, label in zip(texts, y.tolist(), strict=True):
        for w in words:
            counts.setdefault(w, [0, 0])[label] += 1
    n1 = max(1, int(y.sum()))
    n0 = max(1, len(y) - n1)
    scored = []
    for w, (a, b) in counts.items():
        if a + b >= LEAST_DOCS:
            share = (a + b) / (n0 + n1)
            scored.append((-abs(b / n1 - a / n0) / np.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-12), w))
    return [w for _, w in sorted(scored)[:WORDS]]


def _fit(texts: list[set], earlier: np.ndarray, y: np.ndarray) -> Model:
    if y.min(initial=1) == y.max(initial=0):
        return Model({}, np.zeros(earlier.shape[1]), float(_odds(np.array(y.mean()))))
    words = _telling(texts, y)
    at = {w: i for i, w in enumerate(words)}
    x = np.zeros((len(y), len(words) + earlier.shape[1] + 1))
    for i, t in enumerate(texts):
        x[i, [at[w] for w in at.keys() & t]] = 1.0
    x[:, len(words) : -1] = earlier
    x[:, -1] = 1.0
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ beta)
        weight = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * weight[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(dict(zip(words, beta[: len(words)].tolist(), strict=True)), beta[len(words) : -1], float(beta[-1]))


def _predict(model: Model, texts: list[set], earlier: np.ndarray) -> np.ndarray:
    sums = [sum(model.words[w] for w in sorted(model.words.keys() & t)) for t in texts]
    return _sigmoid(np.array(sums) + earlier @ model.earlier + model.intercept)


def _best_limit(p: np.ndarray, y: np.ndarray) -> float:
    if not len(y) or y.min() == y.max():
        return 2.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.append(p[order][1:] < p[order][:-1], True)  # a limit cannot part ties
    k = int(np.argmax(np.where(last, f1, 0)))
    after = p[order][k + 1] if k + 1 < len(y) else 0.0
    return float((p[order][k] + after) / 2)


def fit_chain(names: list[str], texts: list[set], labels: np.ndarray) -> Chain:
    """labels: rows x categories, 0 or 1; texts: the distinct words of each row."""
    n = len(texts)
    fold = np.arange(n) % FOLDS
    earlier = np.zeros((n, 0))
    chain = Chain(list(names), [], [])
    for j in range(len(names)):
        y = labels[:, j]
        p = np.zeros(n)
        for f in range(FOLDS):
            inside, outside = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(inside) and len(outside):
                model = _fit([texts[i] for i in inside], earlier[inside], y[inside])
                p[outside] = _predict(model, [texts[i] for i in outside], earlier[outside])
        chain.models.append(_fit(texts, earlier, y) if n else Model({}, np.zeros(j), 0.0))
        chain.limits.append(_best_limit(p, y))
        earlier = np.column_stack([earlier, _odds(p)])
    return chain


def predict(chain: Chain, texts: list[set]) -> np.ndarray:
    """Probabilities, rows x categories."""
    earlier = np.zeros((len(texts), 0))
    out = []
    for model in chain.models:
        p = _predict(model, texts, earlier)
        out.append(p)
        earlier = np.column_stack([earlier, _odds(p)])
    return np.column_stack(out)


def _word_sets(batches):
    for batch in batches:
        sets = [sorted(set(words_of(t))) for t in texts_of(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(sets, pa.list_(pa.binary())), *batch.columns[1:]], ["words", *batch.schema.names[1:]])


def train(docs: DataFrame, labels: DataFrame, names: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """labels: id_col and a 0/1 column for each name."""
    own = [f"__label{j}" for j in range(len(names))]
    known = labels.select(F.col(id_col).alias("__id"), *(F.col(c).cast("int").alias(o) for c, o in zip(names, own, strict=True))).dropna().groupBy("__id").agg(*(F.max(o).alias(o) for o in own))
    n = max(1, known.count())
    order = F.xxhash64(F.col("__id").cast("string"))
    sample = known.where(F.pmod(order, F.lit(1_000_000)) < int(1e6 * min(1.0, SAMPLE / n)) + 1)
    rows = docs.select(F.col(text_col).alias("__text"), F.col(id_col).alias("__id")).join(F.broadcast(sample), "__id")  # about SAMPLE ids, by the filter above
    rows = rows.select("__text", *own, order.alias("__order"), F.xxhash64("__text").alias("__row")).dropDuplicates(["__order", "__row"])
    texts_n = rows.select("__order", "__row").count()  # many texts may share an id
    if texts_n > 2 * SAMPLE:
        rows = rows.where(F.pmod(F.xxhash64("__order", "__row"), F.lit(1_000_000)) < int(1e6 * SAMPLE / texts_n))
    rows = rows.select("__text", *own, "__order", "__row").mapInArrow(_word_sets, "words array<binary>, " + ", ".join(f"{o} int" for o in own) + ", __order long, __row long")
    number: dict[bytes, int] = {}
    got = []
    for r in rows.toLocalIterator():
        got.append((r["__order"], np.array([number.setdefault(bytes(w), len(number)) for w in r["words"]], np.int32), [r[o] for o in own], r["__row"]))
    got.sort(key=lambda g: (g[0], g[2], g[3]))
    seen = np.bincount(np.concatenate([g[1] for g in got]) if got else np.zeros(0, np.int32), minlength=len(number))
    known = [w if n >= LEAST_DOCS else None for w, n in zip(number, seen.tolist(), strict=True)]  # rarer words cannot be chosen
    del number
    texts = [{known[i] for i in g[1].tolist()} - {None} for g in got]
    return fit_chain(names, texts, np.array([g[2] for g in got], int).reshape(len(got), len(names)))


def _scorer(told, names):
    def rows(batches):
        chain = told.value
        for batch in slices(batches, 1):
            texts = [set(words_of(t)) for t in texts_of(batch.column(1))]
            p = predict(chain, texts)
            marks = [pa.array(p[:, j] > chain.limits[j]) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, j]) for j in range(len(names))), *marks], ["doc_id", *(f"p_{c}" for c in names), *(f"is_{c}" for c in names)])

    return tidy(rows)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, p_<category> and is_<category> for each category of the chain."""
    told = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"p_{c} double" for c in chain.names), *(f"is_{c} boolean" for c in chain.names)])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scorer(told, chain.names), schema)
