"""Every registered query against its SQL twin, run by DuckDB on the same files."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from textmill import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "~"
        return repr(round(v, 9)) if isinstance(v, float) else str(v)

    return [columns[i] for i in order], sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, FOLDER)
    cur = duck.execute(catalog.oracle_sql()[name])
    want = comparable([d[0] for d in cur.description], cur.fetchall())
    assert comparable(got.columns, [tuple(r) for r in got.collect()]) == want


def test_sizes_of_the_vocabulary(spark):
    info = {r["item"]: r["value"] for r in catalog.queries()["vocab_info"](spark, FOLDER).collect()}
    assert info["bpe_vocab_size"] == 264 and info["merges"] == 8 and info["specials"] == 4 and info["vocab_size"] == 268
    assert [info[n] for n in ("<PAD>", "<UNK>", "<BOS>", "<EOS>")] == [264, 265, 266, 267]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["domain", "source", "row_key", "running", "block"] and df.count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
