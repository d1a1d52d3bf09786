"""Similarity join of short strings: what is not below a ratio of matched characters, at any number of terms.

The ratio is 2 M / (a + b), where M characters of strings of lengths a and b lie in matching blocks.  A
cutoff c needs M >= c (a + b) / 2.  Between two blocks at least one character is unmatched, so there
are at most a + b - 2 M + 1 blocks, and a block of n characters holds n - q + 1 grams of q characters:
strings that reach the cutoff share at least M - (q - 1)(a + b - 2 M + 1) grams.  With all grams in one
order, rare ones first, two strings that must share t of them share one of the first n - t + 1 of either.
So stems and terms meet in an equi-join on a few rare grams each; pairs whose lengths or whose numbers of
shared grams cannot reach the cutoff are left out there, and only the others are compared exactly.
"""

from __future__ import annotations

import difflib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counters of the sketch that orders grams: its size at every size of the tables.
SKETCH = 1 << 16
#: Lengths up to which the choice of q is proven by trying; beyond, the bound grows with the lengths.
TRIED = 64


def matched(a: int, b: int, cutoff: float) -> int:
    """Characters that strings of these lengths must match to reach the cutoff."""
    return max(0, math.ceil(cutoff * (a + b) / 2 - 1e-9))


def partners(a: int, cutoff: float) -> range:
    """Lengths of strings that can reach the cutoff with one of length a."""
    low, high = math.ceil(cutoff * a / (2 - cutoff) - 1e-9), math.floor(a * (2 - cutoff) / cutoff + 1e-9)
    return range(max(1, low), high + 1)


def shared(a: int, b: int, cutoff: float, q: int) -> int:
    """Grams of q characters that such strings share at least; a match of all has one block."""
    m = matched(a, b, cutoff)
    return m - (q - 1) * (a + b - 2 * m + 1)


def gram_size(cutoff: float, least: int) -> int:
    """The longest grams, of two characters or one, of which strings from `least` characters on share one at least."""
    two = cutoff > 2 / 3 and all(shared(a, b, cutoff, 2) > 0 for a in range(least, TRIED) for b in partners(a, cutoff))
    return 2 if two else 1


def grams(text: str, q: int) -> list[tuple[str, int]]:
    """The grams of a text, each with the number of equal ones before it."""
    seen: Counter = Counter()
    out = []
    for i in range(len(text) - q + 1):
        g = text[i : i + q]
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def _place(gram: tuple[str, int]) -> int:
    return xxhash.xxh64_intdigest(f"{gram[0]}\0{gram[1]}")


def ranked(text: str, cutoff: float, q: int, counts: np.ndarray) -> tuple[list[int], int]:
    """Hashes of a text's grams, rare ones first, and how many of them a partner has at least one of in its own first ones."""
    own = [h for _, h in sorted((int(counts[h % SKETCH]), h) for h in {_place(g) for g in grams(text, q)})]
    least = min((shared(len(text), b, cutoff, q) for b in partners(len(text), cutoff)), default=1)
    return own, max(0, len(own) - max(1, least) + 1)


def _counted(q):
    def rows(batches):
        total = np.zeros(SKETCH, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for g in grams(text, q):
                    total[_place(g) % SKETCH] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["place", "n"])

    return rows


def _prefixes(told, cutoff, q):
    def rows(batches):
        for batch in batches:
            own = [ranked(t, cutoff, q, told.value) for t in batch.column(0).to_pylist()]
            own = [(np.array(h, np.uint64).view(np.int64), n) for h, n in own]
            all_, first = (pa.array(x, pa.list_(pa.int64())) for x in ([h for h, _ in own], [h[:n] for h, n in own]))
            yield pa.RecordBatch.from_arrays([batch.column(0), all_, first], ["text", "grams", "first"])

    return rows


def _compared(cutoff):
    def rows(batches):
        for batch in batches:
            out = []
            for stem, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                m = difflib.SequenceMatcher(None, term, stem)
                if m.real_quick_ratio() >= cutoff and m.quick_ratio() >= cutoff and (score := m.ratio()) >= cutoff:
                    out.append((stem, term, score, difflib.SequenceMatcher(None, stem, term).ratio()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64(), pa.float64()))], ["stem", "term", "score", "back"])

    return rows


def pairs(stems: DataFrame, terms: DataFrame, cutoff: float, least: int = 3) -> DataFrame:
    """(stem, term, score, back): all pairs of the distinct stems and terms whose ratio reaches the cutoff.

    score is the ratio from term to stem, back that from stem to term; they may differ.  Stems shorter
    than `least` characters are left out, as are nulls and empty terms.
    """
    left = stems.select(F.col(stems.columns[0]).alias("text")).where(F.length("text") >= least).distinct()
    right = terms.select(F.col(terms.columns[0]).alias("text")).where(F.length("text") > 0).distinct()
    shortest = min(partners(least, cutoff)) if partners(least, cutoff) else least
    q = gram_size(cutoff, min(least, shortest))
    counts = np.zeros(SKETCH, np.int64)
    for r in left.unionByName(right).mapInArrow(_counted(q), "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most SKETCH rows
        counts[r["place"]] = r["n"]
    told = stems.sparkSession.sparkContext.broadcast(counts)
    made = lambda rows, name: rows.mapInArrow(_prefixes(told, cutoff, q), "text string, grams array<long>, first array<long>").select(F.col("text").alias(name), F.col("grams").alias(f"{name}_grams"), F.col("first").alias(f"{name}_first"), F.explode("first").alias("gram"))
    both = made(left, "stem").join(made(right, "term"), "gram")
    a, b = F.length("stem"), F.length("term")
    need = F.ceil(cutoff * (a + b) / 2 - 1e-9)
    able = 2 * F.least(a, b) >= cutoff * (a + b) - 1e-9
    once = F.col("gram") == F.array_min(F.array_intersect("stem_first", "term_first"))  # a pair meets at each gram that it shares
    enough = F.size(F.array_intersect("stem_grams", "term_grams")) >= need - (q - 1) * (a + b - 2 * need + 1)
    return both.where(able & once & enough).select("stem", "term").mapInArrow(_compared(cutoff), "stem string, term string, score double, back double")


def closest(stems: DataFrame, terms: DataFrame, cutoff: float) -> DataFrame:
    """(stem, match, score): each stem's most similar term, the larger one of ties, if it also reaches the cutoff the other way and their lengths differ by one at most.

    The two tests come after the choice: a stem whose best term fails them has no match.
    """
    best = pairs(stems, terms, cutoff).groupBy("stem").agg(F.max(F.struct("score", "term", "back")).alias("x"))
    rows = best.select("stem", F.col("x.term").alias("match"), F.col("x.back").alias("score"))
    return rows.where((F.abs(F.length("stem") - F.length("match")) <= 1) & (F.col("score") >= cutoff))
