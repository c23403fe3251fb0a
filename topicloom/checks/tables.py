"""The given tables in the roles of the engine's stage tables, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicloom.session import fresh_path


@dataclass(frozen=True)
class Tables:
    """Access to one data folder."""

    spark: SparkSession
    folder: str

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return fresh_path(self.spark, "check") + "/" + name

    def several_files(self, rows: DataFrame, least: int = 4) -> DataFrame:
        """The rows dealt over several files to be, more of them the more the scan has parts, so that a file keeps its size."""
        return rows.repartition(max(least, rows.rdd.getNumPartitions()))

    def order_posts(self) -> DataFrame:
        """Dated, scored posts over several years."""
        slot = F.col("o_custkey") % 12
        return self.read("orders").select(
            F.col("o_orderkey").alias("post_id"),
            F.col("o_orderdate").cast("timestamp_ntz").alias("date"),
            F.col("o_totalprice").alias("score"),
            (slot - 1).cast("int").alias("topic"),
            (slot % 3).cast("int").alias("parent_topic"),
            F.col("o_orderpriority").alias("subreddit"),
        )

    def event_posts(self) -> DataFrame:
        """Dated, scored posts over one month."""
        slot = F.col("user_id") % 12
        return self.read("events").select(
            F.col("event_id").alias("post_id"),
            F.col("ts").cast("timestamp_ntz").alias("date"),
            F.col("value").alias("score"),
            (slot - 1).cast("int").alias("topic"),
            (slot % 3).cast("int").alias("parent_topic"),
        )

    def text_posts(self) -> DataFrame:
        """Posts with title and body; topics come from the source, the first of them counting as noise."""
        return self.read("documents").select(
            F.col("doc_id").alias("post_id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.col("text").alias("body"),
            F.col("source").alias("subreddit"),
            F.col("n_chars").alias("score"),
            F.concat(F.lit("/r/"), F.col("source"), F.lit("/"), F.col("doc_id")).alias("permalink"),
            (F.col("doc_id") % 9 - 1).cast("int").alias("topic"),
            (F.col("doc_id") % 9 % 3).cast("int").alias("parent_topic"),
        )

    def vectors(self) -> DataFrame:
        """Vectors with a clustering; label 9 counts as noise."""
        return self.read("embeddings").select(
            F.col("vec_id").alias("post_id"),
            "embedding",
            F.when(F.col("label") == 9, -1).otherwise(F.col("label")).cast("int").alias("topic"),
        )

    def vector_posts(self) -> DataFrame:
        """Vectors with text, for the posts that have both."""
        text = self.read("documents").select(F.col("doc_id").alias("post_id"), "text")
        return self.vectors().join(text, "post_id")

    def other_run(self, step: int) -> DataFrame:
        """A second clustering that differs in every ``step``-th post."""
        changed = F.when(F.col("vec_id") % step == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        return self.read("embeddings").select(
            F.col("vec_id").alias("post_id"),
            F.when(F.col("label") == 9, -1).otherwise(changed + 100).cast("int").alias("topic"),
        )


# The same roles for the reference SQL, to be used as common table expressions.
ORDER_POSTS = """order_posts AS (
  SELECT o_orderkey AS post_id, CAST(o_orderdate AS TIMESTAMP) AS date, o_totalprice AS score,
         CAST(o_custkey % 12 - 1 AS INTEGER) AS topic, CAST(o_custkey % 12 % 3 AS INTEGER) AS parent_topic,
         o_orderpriority AS subreddit FROM orders)"""
EVENT_POSTS = """event_posts AS (
  SELECT event_id AS post_id, CAST(ts AS TIMESTAMP) AS date, value AS score,
         CAST(user_id % 12 - 1 AS INTEGER) AS topic, CAST(user_id % 12 % 3 AS INTEGER) AS parent_topic FROM events)"""
TEXT_POSTS = """text_posts AS (
  SELECT doc_id AS post_id, split_part(text, chr(10), 1) AS title, text AS body, source AS subreddit,
         n_chars AS score, '/r/' || source || '/' || doc_id AS permalink,
         CAST(doc_id % 9 - 1 AS INTEGER) AS topic, CAST(doc_id % 9 % 3 AS INTEGER) AS parent_topic FROM documents)"""
VECTORS = """vectors AS (
  SELECT vec_id AS post_id, CAST(embedding AS DOUBLE[]) AS embedding,
         CAST(CASE WHEN label = 9 THEN -1 ELSE label END AS INTEGER) AS topic FROM embeddings)"""
VECTOR_POSTS = VECTORS + """, vector_posts AS (
  SELECT v.*, d.text FROM vectors v JOIN documents d ON v.post_id = d.doc_id)"""


def other_run_sql(name: str, step: int) -> str:
    return f"""{name} AS (
  SELECT vec_id AS post_id, CAST(CASE WHEN label = 9 THEN -1 ELSE
         (CASE WHEN vec_id % {step} = 0 THEN (label + 1) % 10 ELSE label END) + 100 END AS INTEGER) AS topic FROM embeddings)"""


def centroids_sql(source: str, name: str = "centroids", key: str = "topic") -> str:
    """Mean vectors per key of ``source``, noise left out."""
    keep = f"WHERE {key} IS NOT NULL AND {key} <> -1"
    return f"""{name} AS (
  SELECT {key}, list(m ORDER BY d) AS centroid, max(n) AS size FROM (
    SELECT {key}, d, avg(x) AS m, count(*) AS n FROM (
      SELECT {key}, unnest(range(len(embedding))) AS d, unnest(embedding) AS x FROM {source} {keep}) GROUP BY {key}, d)
  GROUP BY {key})"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query on the given tables with the SQL that must give the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
