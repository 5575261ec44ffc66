"""Every registered query against its DuckDB oracle on sf0.001: rows, names, values."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
        return None
    if hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if isinstance(v, float) and math.isfinite(v) and v == int(v):
        return int(v)
    return v


def _canon(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.to_dict("records")]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    from tidemark.plans.star import QUERIES

    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    gc, gr = _canon(got)
    wc, wr = _canon(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["account", "week"]


def test_oracle_mart_column_classes_match_spark(spark):
    from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

    from tidemark.operators.quality import classify_columns
    from tidemark.plans import oracle_sql

    mart = entry.queries()["customer_week_mart"](spark, SF_SMALL)
    discrete, continuous = classify_columns(mart)
    assert sorted(discrete) == sorted(oracle_sql.MART_DISCRETE)
    assert sorted(continuous) == sorted(oracle_sql.MART_CONTINUOUS)
    ints = [f.name for f in mart.schema.fields if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType))]
    assert sorted(c for c in ints if c in continuous) == sorted(oracle_sql.MART_INTEGRAL)
