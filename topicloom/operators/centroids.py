"""Topic centroids and the similarity of posts to them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.vectors import as_vector, to_lists, to_matrix, unit_rows
from topicloom.session import materialize

# Centroids that one pass over the posts sends to every task stay below this size; larger sets take more passes.
SHIPPED_BYTES = 64 * 1024 * 1024
CELLS_PER_STEP = 4_000_000


def topic_centroids(points: DataFrame, group: Sequence[str] = ("topic",), vector: str = "embedding") -> DataFrame:
    """Mean vector and row count per group, noise left out. Partial means are combined before the shuffle."""
    rows = points
    for g in group:
        rows = rows.where(F.col(g).isNotNull())
    if "topic" in group:
        rows = rows.where(F.col("topic") != -1)
    mean = Summarizer.mean(array_to_vector(as_vector(F.col(vector))))
    return rows.groupBy(*group).agg(vector_to_array(mean).alias("centroid"), F.count(F.lit(1)).alias("size"))


def best_columns(sims: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``n`` largest entries, first column wins ties; minus infinity marks a row that has no more."""
    work = sims.copy()
    n = min(n, sims.shape[1])
    where = np.empty((sims.shape[0], n), dtype=np.int64)
    scores = np.empty((sims.shape[0], n))
    rows = np.arange(sims.shape[0])
    for j in range(n):
        where[:, j] = np.argmax(work, axis=1)
        scores[:, j] = work[rows, where[:, j]]
        work[rows, where[:, j]] = -np.inf
    return where, scores


def merge_best(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``n`` entries of largest score, smaller ids first among ties; minus infinity marks an empty place."""
    order = np.lexsort((ids, -scores), axis=1)[:, :n]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)


def top_n_topics(posts: DataFrame, centroids: DataFrame, top_n: int, keep: Sequence[str] = ("post_id",), shipped_bytes: int = SHIPPED_BYTES) -> DataFrame:
    """Per post the ``top_n`` most similar topics and their scores as two arrays, best first, ids break ties.

    Posts stay where they are: each pass sends one chunk of the centroids (``shipped_bytes`` at most) to the tasks, which
    merge it into the best so far. One chunk needs one narrow pass; with more, what a pass found is written before
    the next. Rows need no key: repeated and null ids are rows like any other.
    """
    centers = materialize(centroids.select("topic", "centroid"), "centroids")
    extent = centers.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("width")).first()
    chunks = max(1, -(-extent["n"] * (extent["width"] or 0) * 8 // shipped_bytes))
    columns = list(keep)
    found = [T.StructField("top_n_topics", T.ArrayType(T.IntegerType())), T.StructField("top_n_scores", T.ArrayType(T.DoubleType()))]
    rows = posts.select(*keep, as_vector(F.col("embedding")).alias("__vector"))
    rows = rows.withColumns({"top_n_topics": F.array().cast("array<int>"), "top_n_scores": F.array().cast("array<double>")})
    for chunk in range(chunks):
        here = centers if chunks == 1 else centers.where(F.pmod(F.xxhash64("topic"), F.lit(chunks)) == chunk)
        some = sorted(here.collect(), key=lambda r: r["topic"])
        if not some:
            continue
        last = chunk == chunks - 1
        schema = T.StructType([rows.schema[c] for c in columns] + ([] if last else [rows.schema["__vector"]]) + found)
        rows = rows.mapInArrow(_merging(some, top_n, columns if last else [*columns, "__vector"]), schema)
        if not last:
            rows = materialize(rows, "top-topics")
    return rows.select(*columns, "top_n_topics", "top_n_scores")


def _merging(some: list, top_n: int, columns: list[str]):
    """The pass that merges one chunk of centroids into the best topics so far."""
    ids = np.array([r["topic"] for r in some], dtype=np.int32)
    units = unit_rows(np.array([r["centroid"] for r in some], dtype=np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS_PER_STEP // len(ids))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sims = unit_rows(to_matrix(part.column("__vector"))) @ units.T
                where, scores = best_columns(sims, top_n)
                topics = ids[where]
                before = part.column("top_n_topics")
                if len(before.flatten()):
                    topics, scores = merge_best(np.hstack([to_matrix(before).astype(np.int32), topics]), np.hstack([to_matrix(part.column("top_n_scores")), scores]), top_n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in columns] + [to_lists(topics, pa.int32()), to_lists(scores, pa.float64())],
                    names=[*columns, "top_n_topics", "top_n_scores"],
                )

    return score


def own_similarity(posts: DataFrame, centers: DataFrame, group: Sequence[str], name: str = "sim", shipped_bytes: int = SHIPPED_BYTES) -> DataFrame:
    """``posts`` with the cosine of ``embedding`` and the ``centroid`` of the row's own group; rows of other groups drop out.

    The posts are not shuffled, so a group with most of them costs no more than others: each pass sends one chunk of
    the centroids to the tasks, and a row is kept in the pass that holds its group.
    """
    keys = list(group)
    centers = materialize(centers.select(*keys, "centroid"), "own-centroids")
    extent = centers.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("width")).first()
    chunks = max(1, -(-extent["n"] * (extent["width"] or 0) * 8 // shipped_bytes))
    schema = T.StructType([*posts.schema.fields, T.StructField(name, T.DoubleType())])
    found = None
    for chunk in range(chunks):
        here = centers if chunks == 1 else centers.where(F.pmod(F.xxhash64(*keys), F.lit(chunks)) == chunk)
        rows = here.collect()
        number = {tuple(r[k] for k in keys): i for i, r in enumerate(rows)}
        units = unit_rows(np.array([r["centroid"] for r in rows], dtype=np.float64)) if rows else np.zeros((0, 0))
        one = posts.mapInArrow(_own(number, units, keys), schema)
        found = one if found is None else found.unionByName(one)
    return found


def _own(number: dict, units: np.ndarray, keys: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.array([number.get(k, -1) for k in zip(*(batch.column(c).to_pylist() for c in keys))], dtype=np.int64)
            part = batch.filter(pa.array(place >= 0))
            if part.num_rows:
                place = place[place >= 0]
                sims = np.einsum("ij,ij->i", unit_rows(to_matrix(part.column("embedding"))), units[place])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sims)], schema=pa.schema([*part.schema, pa.field("sim", pa.float64())]))

    return score


def nearest_topic(posts: DataFrame, centroids: DataFrame, keep: Sequence[str] = ("post_id",)) -> DataFrame:
    """The most similar topic of each post and its score; null when there are no topics."""
    return top_n_topics(posts, centroids, 1, keep).select(
        *keep, F.get("top_n_topics", F.lit(0)).alias("topic_near"), F.get("top_n_scores", F.lit(0)).alias("score_near")
    )


def reassign_noise(posts: DataFrame, centroids: DataFrame, threshold: float) -> DataFrame:
    """Noise posts take the nearest topic when its similarity reaches ``threshold`` (inclusive).

    Only the noise rows are scored; ``posts`` needs ``post_id``, ``topic`` and ``embedding`` and keeps its columns.
    """
    noise = posts.where(F.col("topic") == -1)
    near = nearest_topic(noise, centroids, keep=[c for c in posts.columns if c != "embedding"])
    moved = near.withColumn(
        "topic",
        F.when(F.col("score_near") >= threshold, F.col("topic_near")).otherwise(F.lit(-1)).cast(posts.schema["topic"].dataType),
    ).drop("topic_near", "score_near")
    settled = posts.where((F.col("topic") != -1) | F.col("topic").isNull()).drop("embedding")
    return settled.unionByName(moved)


def with_assignments(posts: DataFrame, clusters: DataFrame, top_n: int, keep: Sequence[str] = ("post_id", "topic")):
    """The stage table of a clustering: ids, topic, and the top topics by centroid similarity."""
    joined = clusters.join(posts.select("post_id", "embedding"), "post_id")
    return top_n_topics(joined, topic_centroids(joined), top_n, keep)
