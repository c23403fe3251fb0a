"""Topics split in two by k-means, all approved topics in the same rounds."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.vectors import as_vector, dot, to_lists, to_matrix
from topicloom.operators.centroids import SHIPPED_BYTES, topic_centroids
from topicloom.session import materialize

# Fixed value: topics with fewer posts are not split.
MIN_ROWS = 4
# Rounds after which a split that still moves is given up with a warning.
ROUNDS = 300


def _distance2(a, b):
    return dot(a, a) - 2 * dot(a, b) + dot(b, b)


def _starts(rows: DataFrame) -> DataFrame:
    """Two start vectors per topic: the post farthest from the mean, and the post farthest from that one."""
    mean = topic_centroids(rows).select("topic", "centroid")
    first = _farthest(rows, mean, "first")
    second = _farthest(rows, first.withColumnRenamed("first", "centroid"), "second")
    return first.join(second, "topic")


def _farthest(rows: DataFrame, centers: DataFrame, name: str) -> DataFrame:
    away = rows.join(centers, "topic").select("topic", "post_id", "embedding", _distance2(F.col("embedding"), F.col("centroid")).alias("d"))
    # Largest distance, then smallest id; rounding keeps equal distances equal whatever the batch.
    best = F.min(F.struct((-F.round("d", 12)).alias("minus"), "post_id")).alias("m")
    winner = away.drop("embedding").groupBy("topic").agg(best).select("topic", F.col("m.post_id").alias("post_id"))
    # Vectors are read for the winners only; a repeated id counts once.
    return rows.join(winner, ["topic", "post_id"]).dropDuplicates(["topic"]).select("topic", F.col("embedding").alias(name))


def _sides(matrix: np.ndarray, place: np.ndarray, centers: np.ndarray) -> np.ndarray:
    gap = [((matrix - centers[place, side]) ** 2).sum(axis=1) for side in (0, 1)]
    return (gap[1] < gap[0]).astype(np.int32)


def _lookup(topics: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(topics, values)


def _packed(rows: DataFrame) -> DataFrame:
    """``topics, vectors``: the topics and vectors of one batch of rows as bytes, which every round reads again."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                topics = batch.column("topic").to_numpy(zero_copy_only=False).astype(np.int64)
                both = topics.tobytes(), to_matrix(batch.column("embedding")).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in both], names=["topics", "vectors"])

    return rows.select("topic", "embedding").mapInArrow(pack, "topics binary, vectors binary")


def _sums(matrix: np.ndarray, slot: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The slots in use, ascending, with their row counts and vector sums."""
    order = np.argsort(slot, kind="stable")
    counts = np.bincount(slot, minlength=slots)
    used = np.flatnonzero(counts)
    first = np.concatenate([[0], np.cumsum(counts[used])[:-1]])
    return used, counts[used], np.add.reduceat(matrix[order], first, axis=0)


def _round(packs: DataFrame, topics: np.ndarray, centers: np.ndarray):
    """New centers: every task sends one partial sum per topic and side."""
    width = centers.shape[2]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(2 * len(topics), np.int64), np.zeros((2 * len(topics), width))
        for batch in batches:
            for names, vectors in zip(batch.column("topics"), batch.column("vectors")):
                place = _lookup(topics, np.frombuffer(names.as_buffer(), np.int64))
                matrix = np.frombuffer(vectors.as_buffer(), np.float64).reshape(len(place), width)
                used, n, total = _sums(matrix, place * 2 + _sides(matrix, place, centers), 2 * len(topics))
                counts[used] += n
                sums[used] += total
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64()), to_lists(sums[used], pa.float64())], names=["slot", "n", "s"])

    pieces = packs.mapInArrow(partial, "slot long, n long, s array<double>")
    totals = pieces.groupBy("slot").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("s"))).alias("s"))
    new = centers.copy()
    for r in totals.collect():
        new[r["slot"] // 2, r["slot"] % 2] = np.array(r["s"]) / r["n"]
    return new


def split_topics(posts: DataFrame, topics: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``post_id, topic, side``: the posts of the given topics cut in two; topics under four posts stay out.

    Every topic gives two halves. Where all vectors are equal there is nothing to tell them apart by, and a hash of the
    id does, with the smallest and the largest id on different sides.

    The centers of a round are two vectors per approved topic, shipped only while they fit the size bound; more
    topics than that are taken in batches.
    """
    wanted = posts.join(topics.select("topic").distinct(), "topic", "left_semi")
    rows = wanted.select("topic", "post_id", as_vector(F.col("embedding")).alias("embedding"))
    sizes = rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_ROWS)
    rows = materialize(rows.join(sizes.select("topic"), "topic", "left_semi"), "split-rows")
    starts = materialize(_starts(rows), "split-starts")
    same = starts.where(F.col("first") == F.col("second")).select("topic")
    ends = rows.join(same, "topic", "left_semi").groupBy("topic").agg(F.min("post_id").alias("low"), F.max("post_id").alias("high"))
    by_id = F.when(F.col("post_id") == F.col("low"), 0).when(F.col("post_id") == F.col("high"), 1).otherwise(F.pmod(F.xxhash64("post_id"), F.lit(2)))
    equal = rows.join(ends, "topic").select("post_id", "topic", by_id.cast("int").alias("side"))
    starts = starts.where(F.col("first") != F.col("second"))
    rows = rows.join(starts.select("topic"), "topic", "left_semi")
    schema = T.StructType([rows.schema["post_id"], rows.schema["topic"], T.StructField("side", T.IntegerType())])
    width = starts.select(F.max(F.size("first")).alias("w")).first()["w"]
    if not width:
        return equal
    per_batch = max(1, SHIPPED_BYTES // (16 * width))
    batches = max(1, -(-starts.count() // per_batch))
    out = equal
    for b in range(batches):
        here = F.pmod(F.xxhash64("topic"), F.lit(batches)) == b
        found = _split_batch(rows.where(here), starts.where(here), rounds, schema)
        if batches > 1:
            found = materialize(found, "split-sides")
        out = out.unionByName(found)
    return out


def _split_batch(rows: DataFrame, starts: DataFrame, rounds: int, schema: T.StructType) -> DataFrame:
    known = sorted(starts.collect(), key=lambda r: r["topic"])
    if not known:
        return rows.sparkSession.createDataFrame([], schema)
    topics = np.array([r["topic"] for r in known])
    centers = np.array([[r["first"], r["second"]] for r in known], dtype=np.float64)
    packs = materialize(_packed(rows), "split-packs")
    for _ in range(rounds):
        moved = _round(packs, topics, centers)
        if np.allclose(moved, centers, rtol=0, atol=1e-12):
            break
        centers = moved
    else:
        warnings.warn(f"the halves of some topics still move after {rounds} rounds", stacklevel=2)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                place = _lookup(topics, batch.column("topic").to_numpy(zero_copy_only=False))
                side = _sides(to_matrix(batch.column("embedding")), place, centers)
                yield pa.RecordBatch.from_arrays([batch.column("post_id"), batch.column("topic"), pa.array(side, pa.int32())], names=["post_id", "topic", "side"])

    return rows.mapInArrow(dealt, schema)


def new_split_ids(halves: DataFrame, next_id: DataFrame, order: Sequence[str] = ("rank", "side")) -> DataFrame:
    """``topic, side, new_topic``: ids from the next free one, topics in decision order, first half first."""
    from topicloom.operators.ranking import dense_ids

    return dense_ids(halves.join(F.broadcast(next_id)), order, "new_topic", F.col("next_id")).select("topic", "side", "new_topic")
