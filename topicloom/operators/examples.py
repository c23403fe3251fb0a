"""Representative posts per topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import numeric_score, title_and_body
from topicloom.functions.vectors import as_vector
from topicloom.operators.centroids import own_similarity, topic_centroids
from topicloom.operators.ranking import collect_ranked, top_per_group


def central_posts(posts: DataFrame, limit: int, group: Sequence[str] = ("topic",), keep: Sequence[str] = ("text",)):
    """Per group the ``limit`` posts nearest the mean of the whole group, with rank and similarity.

    All groups are served by one aggregate, and centroids go to the posts: neither vectors nor texts are shuffled by
    group. Noise has no group.
    """
    rows = posts.select(*group, "post_id", as_vector(F.col("embedding")).alias("embedding"), *keep)
    scored = own_similarity(rows, topic_centroids(rows, group), group)
    return top_per_group(scored.drop("embedding"), list(group), [F.desc("sim"), F.asc("post_id")], limit)


def central_examples(posts: DataFrame, limit: int, max_chars: int, group: Sequence[str] = ("topic",)) -> DataFrame:
    """Per group the texts of its central posts, best first, cut to ``max_chars``."""
    ranked = central_posts(posts, limit, group).withColumn("text", F.substring("text", 1, max_chars))
    return collect_ranked(ranked, group, "text")


def top_scored_posts(posts: DataFrame, limit: int, group: Sequence[str] = ("topic",)) -> DataFrame:
    """Per group the ``limit`` posts with the highest score, with rank; ids break ties."""
    return top_per_group(posts, list(group), [F.desc("score"), F.asc("post_id")], limit)


def scored_examples(posts: DataFrame, limit: int, max_chars: int, group: Sequence[str] = ("topic",)) -> DataFrame:
    """Per group the texts of its highest-scored posts; posts without text are dropped after the cut."""
    rows = posts.select(*group, "post_id", numeric_score(F.col("score")).alias("score"), "title", "body")
    best = top_scored_posts(rows, limit, group)
    text = F.nullif(F.substring(title_and_body(F.col("title"), F.col("body")), 1, max_chars), F.lit(""))
    return collect_ranked(best.withColumn("text", text), group, "text")
