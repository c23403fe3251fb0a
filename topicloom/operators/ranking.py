"""Top rows per group and stable samples that hold up when one group has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicloom.session import materialize

SPREAD = 64
# Samples are cut by this many bits of the hash.
RANGE_BITS = 16


def top_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    limit: int,
    rank: str = "rank",
    spread_on: str = "post_id",
    spread: int = SPREAD,
) -> DataFrame:
    """The first ``limit`` rows of each group in ``order``, with their rank.

    Ranks are taken in ``spread`` slices of a group first, so that a hot group is sorted by many tasks and the
    final ranking sees at most ``spread * limit`` rows of it. Every row competes; none is sampled away.
    """
    sliced = df.withColumn("__slice", F.pmod(F.xxhash64(spread_on), F.lit(spread)))
    first = Window.partitionBy(*group, "__slice").orderBy(*order)
    last = Window.partitionBy(*group).orderBy(*order)
    return (
        sliced.withColumn(rank, F.row_number().over(first))
        .where(F.col(rank) <= limit)
        .drop("__slice", rank)
        .withColumn(rank, F.row_number().over(last))
        .where(F.col(rank) <= limit)
    )


def collect_ranked(df: DataFrame, group: Sequence[str], value: str, rank: str = "rank", name: str = "examples"):
    """Values of a ranked table as one array per group, in rank order, without nulls."""
    pairs = F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(rank, value))))
    return df.groupBy(*group).agg(F.transform(pairs, lambda p: p[value]).alias(name))


def sample_exact(df: DataFrame, rows: int, seed: int, key: str = "post_id") -> DataFrame:
    """Exactly ``rows`` rows (all when there are fewer), the same ones for every partitioning.

    Rows are taken in the order of a seeded hash, which is cut by ranges: only the rows of the range in which the sample
    ends are sorted, and whole rows are read for the sample alone.
    """
    place = F.xxhash64(F.col(key), F.lit(seed))
    reach = F.shiftright(place, 64 - RANGE_BITS)
    counts = df.groupBy(reach.alias("range")).agg(F.count(F.lit(1)).alias("n")).collect()
    left = rows
    for range_no, n in sorted((r["range"], r["n"]) for r in counts):
        if n > left:
            whole = df.where(reach < range_no)
            return whole.unionByName(df.where(reach == range_no).orderBy(place, F.col(key)).limit(left)) if left else whole
        left -= n
    return df


def topic_sizes(clusters: DataFrame, topic: str = "topic") -> DataFrame:
    """Rows per topic without noise; rank by size, then id, is left to the reader."""
    return clusters.where((F.col(topic) != -1) & F.col(topic).isNotNull()).groupBy(topic).agg(
        F.count(F.lit(1)).alias("size")
    )


def largest_topics(clusters: DataFrame, limit: int | None = None, min_size: int | None = None, topic: str = "topic"):
    """Topics by size, largest first, at least ``min_size`` rows, the first ``limit`` of them."""
    sizes = topic_sizes(clusters, topic)
    if min_size is not None:
        sizes = sizes.where(F.col("size") >= min_size)
    ordered = sizes.orderBy(F.desc("size"), F.asc(topic))
    return ordered if limit is None else ordered.limit(limit)


def dense_ids(keys: DataFrame, order: Sequence[str], name: str = "new_id", start: int | Column = 0) -> DataFrame:
    """Consecutive ids for the rows of a key table in the given order (its columns tell all rows apart).

    Rows are cut into ranges of the order, numbered within each, and moved by the counts of the ranges before: no task
    sorts the whole table. The driver sees one count per range, at most as many as there are shuffle partitions.
    """
    ranges = materialize(keys.repartitionByRange(*[F.col(c) for c in order]).withColumn("__range", F.spark_partition_id()), "id-ranges")
    before, moved = 0, []
    for row in sorted(ranges.groupBy("__range").count().collect()):
        moved += [F.lit(row["__range"]), F.lit(before)]
        before += row["count"]
    offset = F.element_at(F.create_map(*moved), F.col("__range")) if moved else F.lit(0)
    position = F.row_number().over(Window.partitionBy("__range").orderBy(*[F.col(c) for c in order])) - 1 + offset
    first = F.lit(start) if isinstance(start, int) else start
    return ranges.withColumn(name, (position + first).cast("int")).drop("__range")


def next_topic_id(clusters: DataFrame, empty: int = 1) -> DataFrame:
    """One row: the largest topic id plus one; ``empty`` when there are no topics."""
    top = F.max(F.when(F.col("topic") != -1, F.col("topic")))
    return clusters.agg(F.coalesce(top + 1, F.lit(empty)).cast("int").alias("next_id"))
