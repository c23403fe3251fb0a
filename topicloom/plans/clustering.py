"""Clustering jobs: each takes stage tables and returns a stage table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.operators.agreement import clustering_metrics, consensus, map_runs
from topicloom.operators.centroids import reassign_noise, topic_centroids, top_n_topics, with_assignments
from topicloom.operators.communities import communities, multi_graph, number_communities, simple_graph
from topicloom.operators.density import DensitySetting, density_cluster_labels, density_runs, number_clusters
from topicloom.operators.density_tree import density_tree_labels, tree_runs
from topicloom.operators.descent import descended_neighbors
from topicloom.operators.neighbors import nearest_neighbors
from topicloom.operators.ranking import dense_ids, largest_topics, next_topic_id
from topicloom.operators.reduce import COMPONENTS, fit_components, reduce_dimensions
from topicloom.session import materialize

# Defaults of the clustering jobs.
TOP_N = 3
GRAPH_NEIGHBORS = 30
CONSENSUS_VOTES = 2
CONSENSUS_JACCARD = 0.6
JITTER_FLOOR_SAMPLES = 2


# How neighbours are found: all of them, or most of them with bounded work per post.
SEARCHES = {"exact": nearest_neighbors, "descent": descended_neighbors}


def graph_cluster(posts: DataFrame, k: int = GRAPH_NEIGHBORS, method: str = "leiden", top_n: int = TOP_N, weighted: bool | None = None, search: str = "exact", **limits):
    """Neighbour graph, communities, top topics. Every post gets a topic; there is no noise.

    ``search="descent"`` finds most neighbours with work per post that does not grow with the table, "exact" all of them.

    ``limits`` go to the community search (min_gain, patience, max_rounds, max_levels). ``leiden`` keeps communities connected and counts mutual neighbours twice; ``louvain`` uses similarities as weights.
    """
    if method not in ("leiden", "louvain"):
        raise ValueError(f"unknown method {method!r}")
    if search not in SEARCHES:
        raise ValueError(f"unknown search {search!r}")
    near = materialize(SEARCHES[search](posts, k), "neighbors")
    by_similarity = weighted if weighted is not None else method == "louvain"
    edges = simple_graph(near) if by_similarity else multi_graph(near)
    members = communities(posts.select(F.col("post_id").alias("id")), edges, connected=method == "leiden", **limits)
    clusters = materialize(number_communities(members), "clusters")
    return with_assignments(posts, clusters, top_n)


def _reduced(posts: DataFrame, components: int | None) -> DataFrame:
    return posts if components is None else reduce_dimensions(posts, fit_components(posts, components))


def _density_labels(posts: DataFrame, settings: Sequence[DensitySetting], search: str = "exact") -> DataFrame:
    """``post_id, run, topic`` of every setting: by its similarity limit if it has one, else by a density tree."""
    limited, trees = [s for s in settings if s.min_sim is not None], [s for s in settings if s.min_sim is None]
    if not trees:
        return density_cluster_labels(posts, limited)
    near = materialize(SEARCHES[search](posts, max(s.graph_neighbors() for s in trees)), "neighbors")
    found = density_tree_labels(posts, trees, near)
    return found.unionByName(density_cluster_labels(posts, limited)) if limited else found


def density_cluster(
    posts: DataFrame,
    setting: DensitySetting,
    top_n: int = TOP_N,
    reassign_threshold: float | None = None,
    components: int | None = None,
    recompute_centroids: bool = False,
    search: str = "exact",
) -> DataFrame:
    """Density clusters with noise, optional reassignment of noise, top topics.

    A setting without ``min_sim`` needs no level: clusters come from a density tree over neighbours found by ``search``.
    Top topics are scored against the centroids from before the reassignment unless ``recompute_centroids``.
    """
    labels = _density_labels(_reduced(posts, components), [setting], search).select("post_id", "topic")
    rows = posts.select("post_id", "embedding").join(materialize(labels, "labels"), "post_id")
    return finish(rows, top_n, reassign_threshold, recompute_centroids)


def finish(rows: DataFrame, top_n: int, reassign_threshold: float | None, recompute_centroids: bool, keep: Sequence[str] = ()):
    """Centroids, optional reassignment of noise, and top topics for labelled vectors."""
    columns = ["post_id", "topic", *keep]
    centers = topic_centroids(rows)
    if reassign_threshold is not None:
        centers = materialize(centers, "centroids")
        settled = materialize(reassign_noise(rows.select(*columns, "embedding"), centers, reassign_threshold), "reassigned")
        rows = rows.select("post_id", "embedding").join(settled, "post_id")
        if recompute_centroids:
            centers = topic_centroids(rows)
    return top_n_topics(rows, centers, top_n, columns)


def _split_within(rows: DataFrame, min_size: int, setting: DensitySetting) -> DataFrame:
    """``post_id, grp, rank, sub`` for the posts of topics of at least ``min_size`` that fall apart into several parts.

    All large topics are clustered in one job; neighbours never cross topics. ``sub`` is null for noise inside a topic.
    """
    large = largest_topics(rows, min_size=min_size)
    order = Window.orderBy(F.desc("size"), F.asc("topic"))
    large = materialize(large.withColumn("rank", F.row_number().over(order)).select(F.col("topic").alias("grp"), "rank"), "large")
    members = rows.withColumnRenamed("topic", "grp").join(large, "grp")
    search = density_runs if setting.min_sim is not None else tree_runs
    found = number_clusters(search(members.select("grp", "post_id", "embedding"), [setting]))
    found = materialize(found.select("grp", "post_id", F.col("topic").alias("sub")), "sub-topics")
    several = found.groupBy("grp").agg(F.max("sub").alias("top")).where(F.col("top") > 0).select("grp")
    return members.select("grp", "post_id", "rank").join(several, "grp").join(found, ["grp", "post_id"], "left")


def two_stage_cluster(
    posts: DataFrame,
    first: DensitySetting,
    second: DensitySetting,
    split_min_size: int,
    top_n: int = TOP_N,
    reassign_threshold: float | None = None,
    components: int | None = None,
) -> DataFrame:
    """Density clusters, large ones clustered again inside; a topic is replaced only when it yields several parts.

    ``components`` reduces the vectors for the search for clusters; centroids and scores use the full ones.
    """
    reduced = _reduced(posts, components)
    labels = materialize(_density_labels(reduced, [first]).select("post_id", "topic"), "labels")
    rows = reduced.select("post_id", "embedding").join(labels, "post_id")
    parts = materialize(_split_within(rows, split_min_size, second), "parts")
    keys = parts.where(F.col("sub").isNotNull()).select("grp", "rank", "sub").distinct()
    start = next_topic_id(labels)
    ids = dense_ids(keys.join(F.broadcast(start)), ["rank", "sub"], "new_topic", F.col("next_id")).select("grp", "sub", "new_topic")
    renamed = parts.join(ids, ["grp", "sub"], "left").select("post_id", F.coalesce("new_topic", F.lit(-1)).alias("changed"))
    final = labels.join(renamed, "post_id", "left").select("post_id", F.coalesce("changed", "topic").alias("topic"))
    rows = posts.select("post_id", "embedding").join(materialize(final, "final"), "post_id")
    return finish(rows, top_n, reassign_threshold, recompute_centroids=True)


def sub_topics(posts: DataFrame, clusters: DataFrame, setting: DensitySetting, min_size: int, top_n: int = TOP_N, components: int | None = None) -> DataFrame:
    """The third level: parts of each large topic with consecutive ids; every other post is -1 and keeps its parent."""
    rows = clusters.select("post_id", "topic").join(posts.select("post_id", "embedding"), "post_id")
    near = rows if components is None else clusters.select("post_id", "topic").join(_reduced(posts, components).select("post_id", "embedding"), "post_id")
    parts = materialize(_split_within(near, min_size, setting), "parts")
    keys = parts.where(F.col("sub").isNotNull()).select("grp", "rank", "sub").distinct()
    ids = dense_ids(keys, ["rank", "sub"], "l3").select("grp", "sub", "l3")
    named = parts.join(ids, ["grp", "sub"]).select("post_id", "l3")
    final = rows.join(named, "post_id", "left").select(
        "post_id", "embedding", F.coalesce("l3", F.lit(-1)).alias("topic"), F.col("topic").alias("parent_topic")
    )
    final = materialize(final, "third-level")
    return top_n_topics(final, topic_centroids(final), top_n, ["post_id", "topic", "parent_topic"])


def tune(posts: DataFrame, settings: Sequence[DensitySetting], reassign_threshold: float | None = None, components: int | None = None) -> DataFrame:
    """One row per setting with its cluster metrics, least noise first. The similarities are computed once for all."""
    labels = materialize(_density_labels(_reduced(posts, components), settings), "grid")
    if reassign_threshold is not None:
        labels = materialize(_reassign_runs(posts, labels, settings, reassign_threshold), "grid-reassigned")
    rows = [(s.run, s.min_cluster_size, s.min_samples, s.min_sim if s.min_sim is None else float(s.min_sim)) for s in settings]
    grid = posts.sparkSession.createDataFrame(rows, "run int, min_cluster_size int, min_samples int, min_sim double")
    scored = grid.join(clustering_metrics(labels, ["run"]), "run")
    return scored.drop("run").orderBy("noise_pct", "topics", "min_cluster_size", "min_samples", "min_sim")


def _reassign_runs(posts: DataFrame, labels: DataFrame, settings: Sequence[DensitySetting], threshold: float) -> DataFrame:
    moved = None
    for setting in settings:
        rows = labels.where(F.col("run") == setting.run).join(posts.select("post_id", "embedding"), "post_id")
        one = reassign_noise(rows.select("post_id", "topic", "embedding"), topic_centroids(rows), threshold)
        one = one.select("post_id", F.lit(setting.run).alias("run"), "topic")
        moved = one if moved is None else moved.unionByName(one)
    return moved


def jittered(setting: DensitySetting, jitters: Sequence[int], sim_step: float = 0.01) -> list[DensitySetting]:
    """The settings of a stability study: one jitter per run moves both the neighbour count and the similarity."""
    return [
        replace(setting, run=i, min_samples=max(JITTER_FLOOR_SAMPLES, setting.min_samples + j), min_sim=None if setting.min_sim is None else setting.min_sim + j * sim_step)
        for i, j in enumerate(jitters)
    ]


def combine_runs(runs: DataFrame, jaccard: float = CONSENSUS_JACCARD, votes: int = CONSENSUS_VOTES) -> DataFrame:
    """``post_id, topic`` agreed on by runs 0 (the base), 1, 2, …"""
    base = runs.where(F.col("run") == 0).select("post_id", "topic")
    return consensus(base, map_runs(base, runs.where(F.col("run") > 0), jaccard), votes)


def stability_cluster(
    posts: DataFrame,
    settings: Sequence[DensitySetting],
    jaccard: float = CONSENSUS_JACCARD,
    votes: int = CONSENSUS_VOTES,
    top_n: int = TOP_N,
    components: int | None = None,
) -> DataFrame:
    """Several density runs, mapped to the first one and voted on per post."""
    runs = materialize(_density_labels(_reduced(posts, components), settings), "runs")
    return with_assignments(posts, materialize(combine_runs(runs, jaccard, votes), "consensus"), top_n)


__all__ = [
    "COMPONENTS",
    "combine_runs",
    "density_cluster",
    "finish",
    "graph_cluster",
    "jittered",
    "stability_cluster",
    "sub_topics",
    "tune",
    "two_stage_cluster",
]
