"""The study's queries against DuckDB on the smallest tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from locusframe.plans import queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_as_duckdb(spark, duck, name):
    df = queries.queries()[name](spark, DATA)
    got = duck.sql(queries.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(got.columns)
    ours = Counter(tuple(norm(r[c]) for c in columns) for r in df.collect())
    theirs = Counter(tuple(map(norm, r)) for r in got.select(*[f'"{c}"' for c in columns]).fetchall())
    assert ours == theirs


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(queries.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_have_rows(spark):
    """Every site is looked up, and subjects of one time point occur."""
    q = queries.queries()
    got = q["reference_base"](spark, DATA)
    assert got.count() == q["interval_annotate"](spark, DATA).count() == 5334
    assert got.where("position >= 40").count() > 5000
    assert q["subjects_single_timepoint"](spark, DATA).count() > 10


@pytest.mark.parametrize(("name", "first"), [("mag_score_sorted", lambda r: -r["score_tTest (%)"]), ("legacy_gene_score_sorted", lambda r: -r["score"]), ("legacy_group_tests_sorted", lambda r: (r["contig"], r["position"])), ("legacy_outlier_genes", lambda r: r["p_value"])])
def test_sorted(spark, name, first):
    rows = queries.queries()[name](spark, DATA).collect()
    assert len(rows) > 5 and rows == sorted(rows, key=first)
