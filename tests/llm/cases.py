"""Small documents with nulls, empty and very long texts, ties, repeats and clashing columns."""

import random


def words(n, seed=0, size=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)) if size else ""


LONG = words(60_000, 99)
BASE = words(200, 1)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, kind int, n long, token string, h string, row long"


def odd_rows():
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, BASE), (6, BASE), (6, BASE), (7, BASE + " extra"), (8, "one two"), (9, "ONE two"), (10, words(200, 2)), (None, "no id here at all"), (11, "Über ÉTÉ　x\x1fy"),
    ]
    return [(i, t, None if i == 3 else "en", None, None, "clash", 7, 8, "clash", "clash", 9) for i, t in texts]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
