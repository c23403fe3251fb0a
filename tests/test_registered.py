"""A quick part of the registered queries against their SQL on the smallest tables, and the driver contract."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "growth_ranking", "monthly_series", "scan_csv", "label_csv_scan", "append_with_resume", "stringify_extras", "scored_examples", "excerpts",
    "reply_values", "last_labels", "hierarchy_order", "topic_centroids", "top_n_topics", "central_examples", "compare_clusterings",
    "combined_runs", "nearest_neighbors", "topic_terms",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def shown(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("null" if pd.api.types.is_scalar(v) and pd.isna(v) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_sql(spark, db, name):
    got, want = entry.queries()[name](spark, FOLDER).toPandas(), db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert shown(got) == shown(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_files_follow_the_scan(spark):
    from topicloom.checks.tables import Tables

    parts = lambda n: Tables(spark, "none").several_files(spark.range(0, 100, 1, n)).rdd.getNumPartitions()
    assert parts(2) == 4 and parts(9) == 9
