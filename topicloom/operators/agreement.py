"""How two clusterings agree, and a consensus of several."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.session import materialize


def side_by_side(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two clusterings of the same posts in one row each, columns marked by side."""
    def marked(df: DataFrame, side: str) -> DataFrame:
        return df.select("post_id", *[F.col(c).alias(f"{c}_{side}") for c in df.columns if c != "post_id"])

    return marked(left, "left").join(marked(right, "right"), "post_id")


def contingency(pairs: DataFrame, left: str = "topic_left", right: str = "topic_right") -> DataFrame:
    """Posts per pair of labels, noise on either side left out."""
    kept = pairs.where((F.col(left) != -1) & (F.col(right) != -1))
    return kept.groupBy(left, right).agg(F.count(F.lit(1)).alias("n"))


def _two(x: Column) -> Column:
    x = x.cast("double")
    return x * (x - 1) / 2


def _entropy(n: Column, total: Column) -> Column:
    return -F.sum(n / total * F.log(n / total))


def pair_scores(table: DataFrame, left: str = "topic_left", right: str = "topic_right") -> DataFrame:
    """One row: adjusted Rand index and normalised mutual information from a contingency table.

    Row and column sums are joined on their labels, so the work is linear in the label pairs.
    """
    rows = table.groupBy(left).agg(F.sum("n").alias("a"))
    cols = table.groupBy(right).agg(F.sum("n").alias("b"))
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("t"))
    row_part = rows.join(F.broadcast(total)).agg(
        F.coalesce(F.sum(_two(F.col("a"))), F.lit(0.0)).alias("pairs_a"),
        F.coalesce(_entropy(F.col("a"), F.col("t")), F.lit(0.0)).alias("h_a"),
    )
    col_part = cols.join(F.broadcast(total)).agg(
        F.coalesce(F.sum(_two(F.col("b"))), F.lit(0.0)).alias("pairs_b"),
        F.coalesce(_entropy(F.col("b"), F.col("t")), F.lit(0.0)).alias("h_b"),
    )
    n = F.col("n").cast("double")
    cell = F.sum(n / F.col("t") * F.log(n * F.col("t") / (F.col("a") * F.col("b"))))
    cells = table.join(rows, left).join(cols, right).join(F.broadcast(total)).agg(
        F.coalesce(F.sum(_two(F.col("n"))), F.lit(0.0)).alias("pairs_ab"), F.coalesce(cell, F.lit(0.0)).alias("mi")
    )
    # Four one-row aggregates side by side.
    one = cells.join(F.broadcast(row_part)).join(F.broadcast(col_part)).join(F.broadcast(total))
    expected = F.coalesce(F.try_divide(F.col("pairs_a") * F.col("pairs_b"), _two(F.col("t"))), F.lit(0.0))
    room = (F.col("pairs_a") + F.col("pairs_b")) / 2 - expected
    both = (F.col("h_a") + F.col("h_b")) / 2
    return one.select(
        F.when(room == 0, F.lit(1.0)).otherwise(F.try_divide(F.col("pairs_ab") - expected, room)).alias("ari"),
        F.when(both == 0, F.lit(1.0)).otherwise(F.try_divide(F.col("mi"), both)).alias("nmi"),
    )


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two label lists; two empty lists agree fully."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)))


def label_pair_table(pairs: DataFrame) -> DataFrame:
    """One pass over the joined posts: per pair of labels, noise included, counts and sums of the list scores."""
    a, b = F.col("top_n_topics_left"), F.col("top_n_topics_right")
    hit = F.coalesce(F.array_contains(b, F.get(a, F.lit(0))), F.lit(False)).cast("int")
    return pairs.groupBy("topic_left", "topic_right").agg(
        F.count(F.lit(1)).alias("n"), F.sum(jaccard(a, b)).alias("jaccard_sum"), F.sum(hit).alias("top1_hits")
    )


def list_scores(table: DataFrame) -> DataFrame:
    """One row over all posts, noise included: rows, mean Jaccard of top lists, share whose top topic the other lists."""
    rows = F.coalesce(F.sum("n"), F.lit(0))
    return table.agg(
        rows.alias("rows_compared"),
        F.try_divide(F.sum("jaccard_sum"), rows).alias("avg_jaccard"),
        F.try_divide(F.sum("top1_hits"), rows).alias("top1_share"),
    )


def compare_clusterings(left: DataFrame, right: DataFrame) -> DataFrame:
    """The comparison report of two clusterings, one row. The posts are joined and read once."""
    table = materialize(label_pair_table(side_by_side(left, right)), "label-pairs")
    real = table.where((F.col("topic_left") != -1) & (F.col("topic_right") != -1))
    return pair_scores(real).join(F.broadcast(list_scores(table))).select(
        "rows_compared",
        F.round("ari", 4).alias("ari_no_neg1"),
        F.round("nmi", 4).alias("nmi_no_neg1"),
        F.round("avg_jaccard", 4).alias("avg_topn_jaccard"),
        F.round(F.col("top1_share") * 100, 2).alias("top1_in_other_topn_pct"),
    )


def clustering_metrics(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Topics, noise share in percent, mean and median topic size, per run named by ``by``."""
    sizes = labels.groupBy(*by, "topic").agg(F.count(F.lit(1)).alias("n"))
    real = F.when(F.col("topic") != -1, F.col("n"))
    noise = F.sum(F.when(F.col("topic") == -1, F.col("n")).otherwise(F.lit(0)))
    return sizes.groupBy(*by).agg(
        F.count(real).alias("topics"),
        F.coalesce(F.round(F.try_divide(noise, F.sum("n")) * 100, 2), F.lit(0.0)).alias("noise_pct"),
        F.coalesce(F.round(F.avg(real), 2), F.lit(0.0)).alias("avg_cluster_size"),
        F.coalesce(F.round(F.median(real), 2), F.lit(0.0)).alias("median_cluster_size"),
    )


def map_to_base(base: DataFrame, runs: DataFrame, threshold: float) -> DataFrame:
    """``run, topic -> base_topic``: each run cluster takes the base cluster it overlaps most, if alike enough.

    ``base`` has ``post_id, topic``; ``runs`` has ``run, post_id, topic``. Ties go to the base cluster whose
    smallest shared post id is lowest. Overlaps are counted before anything is ranked.
    """
    named = runs.where(F.col("topic") != -1)
    run_sizes = named.groupBy("run", "topic").agg(F.count(F.lit(1)).alias("run_size"))
    base_real = base.where(F.col("topic") != -1).select("post_id", F.col("topic").alias("base_topic"))
    base_sizes = base_real.groupBy("base_topic").agg(F.count(F.lit(1)).alias("base_size"))
    shared = named.join(base_real, "post_id").groupBy("run", "topic", "base_topic").agg(
        F.count(F.lit(1)).alias("overlap"), F.min("post_id").alias("first_id")
    )
    best = shared.groupBy("run", "topic").agg(
        F.min(F.struct((-F.col("overlap")).alias("minus"), "first_id", "base_topic")).alias("m")
    ).select("run", "topic", F.col("m.base_topic").alias("base_topic"), (-F.col("m.minus")).alias("overlap"))
    union = F.col("run_size") + F.col("base_size") - F.col("overlap")
    scored = run_sizes.join(best, ["run", "topic"], "left").join(base_sizes, "base_topic", "left")
    alike = F.coalesce(F.col("overlap") / union, F.lit(0.0)) >= threshold
    return scored.select(
        "run", "topic", F.when(alike & F.col("base_topic").isNotNull(), F.col("base_topic")).otherwise(F.lit(-1)).alias("base_topic")
    )


def map_runs(base: DataFrame, runs: DataFrame, threshold: float) -> DataFrame:
    """The runs with their labels replaced by base labels; noise stays noise."""
    mapping = map_to_base(base, runs, threshold)
    return runs.join(mapping, ["run", "topic"], "left").select(
        "run", "post_id", F.coalesce("base_topic", F.lit(-1)).alias("topic")
    )


def consensus(base: DataFrame, mapped: DataFrame, k: int) -> DataFrame:
    """Per post the label most sources voted for, if at least ``k`` did, else -1; earlier sources win ties.

    ``mapped`` has ``run`` numbered from 1; the base votes as source 0.
    """
    votes = base.select("post_id", F.lit(0).alias("run"), "topic").unionByName(mapped.select("post_id", "run", "topic"))
    counted = votes.where(F.col("topic") != -1).groupBy("post_id", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.min("run").alias("first_run")
    )
    winner = counted.groupBy("post_id").agg(F.min(F.struct((-F.col("n")).alias("minus"), "first_run", "topic")).alias("w"))
    chosen = winner.where(-F.col("w.minus") >= k).select("post_id", F.col("w.topic").alias("won"))
    return base.select("post_id").join(chosen, "post_id", "left").select("post_id", F.coalesce("won", F.lit(-1)).alias("topic"))
