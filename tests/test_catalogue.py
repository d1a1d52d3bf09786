"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from lectern.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = {"chunk_pack", "fuzzy_suggest", "study_sections", "fold_thousands_usage", "feedback_order", "feedback_lessons", "similar_words", "concept_lists"}  # most have slow versions in test_whole_queries.py


def _cell(v):
    return "~" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no fixture tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(_cell(r[c]) for c in columns) for r in df.collect())
    if name in ROWS_ONLY:
        assert got
        return
    cur = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(_cell(r[i]) for i in order) for r in cur.fetchall())


def test_no_oracle_without_a_query():
    assert set(catalogue.oracle_sql()) | ROWS_ONLY == set(catalogue.queries())
