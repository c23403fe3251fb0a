"""Topics grouped by Ward linkage on their centroids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.vectors import as_vector, to_matrix
from topicloom.operators.blocks import column_of, pair_up, pick, spread_parts
from topicloom.operators.components import connected_components
from topicloom.session import materialize


def _nearest_kernel(a: pa.Table, b: pa.Table, _same: bool) -> pa.Table:
    """Per cluster of the left block its nearest other cluster in the right block; blocks arrive in id order."""
    left, right = to_matrix(a.column("vec")), to_matrix(b.column("vec"))
    na, nb = a.column("n").to_numpy(), b.column("n").to_numpy()
    square = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * left @ right.T
    height = np.sqrt(2.0 * na[:, None] * nb[None, :] / (na[:, None] + nb[None, :]) * np.maximum(square, 0))
    height = np.round(height, 12)
    height[a.column("id").to_numpy()[:, None] == b.column("id").to_numpy()[None, :]] = np.inf
    best = np.argmin(height, axis=1)
    low = height[np.arange(len(best)), best]
    real = np.nonzero(np.isfinite(low))[0]
    return pa.table({"id": pick(column_of(a, "id"), real), "other": pick(column_of(b, "id"), best[real]), "height": low[real]})


def ward_merges(centroids: DataFrame) -> DataFrame:
    """``step, a, b, height``: the whole Ward tree of a centroid table.

    Every round joins all pairs of clusters that are each other's nearest, which yields the same tree as taking the
    closest pair one at a time. Only the nearest cluster per cluster leaves a block.
    """
    spark = centroids.sparkSession
    clusters = materialize(
        centroids.select(F.col("topic").cast("long").alias("id"), F.lit(1.0).alias("n"), as_vector(F.col("centroid")).alias("vec")), "ward"
    )
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("other", T.LongType()), T.StructField("height", T.DoubleType())])
    merges, left, step = None, clusters.count(), 0
    while left > 1:
        blocks = spread_parts(clusters, left)
        near = pair_up(blocks, blocks, _nearest_kernel, schema)
        near = near.groupBy("id").agg(F.min(F.struct("height", "other")).alias("m")).select("id", "m.height", "m.other")
        near = materialize(near, "ward-near")
        back = near.select(F.col("id").alias("other"), F.col("other").alias("id"))
        pairs = near.join(back, ["id", "other"]).where(F.col("id") < F.col("other")).select("id", "other", "height")
        grown = materialize(_join_pairs(clusters, pairs), "ward")
        now = grown.count()
        if now == left:
            # A cycle of equal distances: take its lowest link.
            link = near.select(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other"), "height")
            pairs = link.orderBy("height", "id", "other").limit(1)
            grown = materialize(_join_pairs(clusters, pairs), "ward")
            now = left - 1
        made = pairs.select(F.lit(step).alias("step"), F.col("id").alias("a"), F.col("other").alias("b"), "height")
        merges = made if merges is None else merges.unionByName(made)
        clusters, left, step = grown, now, step + 1
    return merges if merges is not None else spark.createDataFrame([], "step int, a long, b long, height double")


def _join_pairs(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """The clusters with each pair replaced by its weighted mean under the smaller id."""
    kept = clusters.join(pairs.select(F.col("other").alias("id")), "id", "left_anti")
    tails = clusters.select(F.col("id").alias("other"), F.col("n").alias("n2"), F.col("vec").alias("vec2"))
    grown = kept.join(pairs.select("id", "other").join(tails, "other"), "id", "left")
    total = F.col("n") + F.col("n2")
    mean = F.zip_with("vec", "vec2", lambda x, y: (x * F.col("n") + y * F.col("n2")) / total)
    alone = F.col("n2").isNull()
    return grown.select("id", F.when(alone, F.col("n")).otherwise(total).alias("n"), F.when(alone, F.col("vec")).otherwise(mean).alias("vec"))


def ward_groups(centroids: DataFrame, groups: int) -> DataFrame:
    """``topic, l1_id``: topics cut into ``groups`` groups (all apart when there are fewer topics).

    Groups are numbered by their smallest topic.
    """
    from topicloom.operators.ranking import dense_ids

    centroids = materialize(centroids, "centroids")
    merges = materialize(ward_merges(centroids), "ward-tree")
    topics = centroids.count()
    kept = merges.orderBy("height", "step", "a", "b").limit(max(0, topics - groups))
    roots = connected_components(kept.select(F.lit(0).alias("part"), F.col("a").alias("src"), F.col("b").alias("dst")))
    members = centroids.select(F.col("topic").cast("long").alias("id")).join(roots, "id", "left").select(
        F.col("id").cast(centroids.schema["topic"].dataType).alias("topic"), F.coalesce("root", "id").alias("root")
    )
    ids = dense_ids(members.select("root").distinct(), ["root"], "l1_id")
    return members.join(ids, "root").select("topic", "l1_id")
