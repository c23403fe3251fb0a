"""Registered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from topicloom.llm.queries import ORACLES, QUERIES
from topicloom.session import materialize

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def shown(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple("null" if pd.api.types.is_scalar(v) and pd.isna(v) else str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    db = duckdb.connect()
    for table in os.listdir(FOLDER):
        db.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{table}'")
    got, want = QUERIES[name](spark, FOLDER).toPandas(), db.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and shown(got) == shown(want)


def test_all_are_registered():
    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and "pipeline" in found and set(QUERIES) <= set(found)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] == counts[3] > 0
    assert docs.groupBy("doc_id").count().where("count > 2").isEmpty()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
