"""Review tables: labelled hierarchy with top posts, and growth with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import SITE_PREFIX, build_permalink, make_excerpt, numeric_score, reply_value
from topicloom.operators.examples import top_scored_posts
from topicloom.operators.growth import (
    REPORT_LIMIT,
    REPORT_WINDOWS,
    dated_topics,
    growth_counts,
    monthly_series,
    ranked_growth,
    topic_growth,
)
from topicloom.operators.labels import default_label, first_of
from topicloom.operators.ranking import topic_sizes
from topicloom.session import materialize
from topicloom.sources.readers import project_existing

# The post columns of a review and the rows shown per group.
POST_COLUMNS = ("post_id", "title", "body", "score", "subreddit", "permalink", "date")
SHOWN_POSTS = 20


def grouped_posts(posts: DataFrame, clusters: DataFrame, topic_to_l1: DataFrame) -> DataFrame:
    """Posts with ``topic``, ``l2_id`` and ``l1_id``; posts of topics without a mapping drop out.

    ``topic_to_l1``: ``l2_topic, l1_id``. With a ``parent_topic`` column the parent decides the group.
    """
    wanted = ["post_id", "topic"] + (["parent_topic"] if "parent_topic" in clusters.columns else [])
    rows = posts.join(clusters.select(*wanted), "post_id").withColumn("l2_id", F.col(wanted[-1]))
    mapping = topic_to_l1.where(F.col("l2_topic").isNotNull() & F.col("l1_id").isNotNull())
    return rows.join(mapping.select(F.col("l2_topic").alias("l2_id"), "l1_id"), "l2_id")


def _score(df: DataFrame):
    return numeric_score(F.col("score")) if "score" in df.columns else F.lit(0.0)


def with_previews(rows: DataFrame, prefix: str = SITE_PREFIX) -> DataFrame:
    """Posts with score as a number, absolute link and excerpt; absent columns count as empty."""
    text = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("title", "body", "permalink")}
    return rows.withColumns(
        {"score": _score(rows), "permalink": build_permalink(text["permalink"], prefix), "excerpt": make_excerpt(text["title"], text["body"])}
    )


def prepare_posts(canonical: DataFrame, clusters: DataFrame, topic_to_l1: DataFrame, prefix: str = SITE_PREFIX) -> DataFrame:
    """Clustered posts of mapped topics with score, link and excerpt; an absent score counts as 0."""
    return with_previews(grouped_posts(project_existing(canonical, POST_COLUMNS), clusters, topic_to_l1), prefix)


def clean_hierarchy(hierarchy: DataFrame) -> DataFrame:
    """The hierarchy with labels and summaries taken out of their replies."""
    return hierarchy.withColumns({c: reply_value(F.coalesce(c, F.lit("")), c) for c in ("label", "summary")})


def ordered_hierarchy(hierarchy: DataFrame, l2_labels: DataFrame | None = None) -> DataFrame:
    """``l1_rank, l2_rank`` and the shown label and summary of every group and topic, groups by size.

    A topic's own label comes first, then the hierarchy's, then its number. One row per group or topic.
    """
    by_size = Window.orderBy(F.desc("size"), F.asc("l1_id"))
    l1 = hierarchy.where(F.col("level") == "L1").withColumn("l1_rank", F.row_number().over(by_size))
    l1 = l1.withColumn("label", first_of(F.col("label"), default_label("L1", F.col("l1_id"))))
    inside = Window.partitionBy("l1_id").orderBy(F.desc("size"), F.asc("l2_topic"))
    l2 = hierarchy.where(F.col("level") == "L2").withColumn("l2_rank", F.row_number().over(inside))
    l2 = l2.join(l1.select("l1_id", "l1_rank"), "l1_id")
    if l2_labels is not None:
        own = l2_labels.select(F.col("topic").alias("l2_topic"), F.col("label").alias("own_label"), F.col("summary").alias("own_summary"))
        l2 = l2.join(own, "l2_topic", "left")
    else:
        l2 = l2.withColumns({"own_label": F.lit(None).cast("string"), "own_summary": F.lit(None).cast("string")})
    l2 = l2.withColumns(
        {
            "label": first_of(F.col("own_label"), F.col("label"), default_label("Topic", F.col("l2_topic"))),
            "summary": F.coalesce(first_of(F.col("own_summary"), F.col("summary")), F.lit("")),
        }
    ).drop("own_label", "own_summary")
    return l1.withColumn("l2_rank", F.lit(0)).unionByName(l2)


def label_review(
    canonical: DataFrame,
    clusters: DataFrame,
    hierarchy: DataFrame,
    l2_labels: DataFrame | None = None,
    l3_clusters: DataFrame | None = None,
    l3_labels: DataFrame | None = None,
    shown: int = SHOWN_POSTS,
) -> DataFrame:
    """Every group, topic and subtopic with its label and its top posts, one row per post.

    ``level, l1_rank, l2_rank, l1_id, l2_topic, l3_topic, size, label, summary, rank, post_id, score, excerpt,
    permalink`` and ``subreddit``; groups without posts keep one row without a post.
    """
    tree = materialize(ordered_hierarchy(clean_hierarchy(hierarchy), l2_labels), "review-tree")
    mapping = tree.where(F.col("level") == "L2").select("l2_topic", "l1_id")
    # Ids and scores are ranked first; text is read and cut only for the posts that are shown.
    scored = canonical.select("post_id", _score(canonical).alias("score"))
    posts = grouped_posts(scored, clusters, mapping)
    entry = lambda level, group, sub: F.struct(F.lit(level).alias("level"), group.alias("group"), sub.alias("sub"))
    none = F.lit(-1)
    parts = posts.select("post_id", "score", F.explode(F.array(entry("L1", F.col("l1_id"), none), entry("L2", F.col("l2_id"), none))).alias("g"))
    if l3_clusters is not None:
        below = grouped_posts(scored, l3_clusters, mapping)
        parts = parts.union(below.select("post_id", "score", entry("L3", F.col("l2_id"), F.col("topic")).alias("g")))
    # One ranking serves every level.
    best = top_scored_posts(parts.select("post_id", "score", "g.*"), shown, ["level", "group", "sub"])
    keyed = tree.withColumn("group", F.coalesce("l2_topic", "l1_id"))
    out = keyed.join(best.where(F.col("level") != "L3"), ["level", "group"], "left").withColumn("l3_topic", F.lit(None).cast("int"))
    out = out.drop("group", "sub")
    if l3_clusters is not None:
        out = out.unionByName(_third_level(tree, best.where(F.col("level") == "L3"), l3_clusters, l3_labels))
    kept = ["level", "l1_rank", "l2_rank", "l1_id", "l2_topic", "l3_topic", "size", "label", "summary", "rank", "post_id", "score"]
    details = project_existing(canonical, [c for c in POST_COLUMNS if c not in ("score", "date")])
    seen = [c for c in ("subreddit",) if c in details.columns]
    # The posts on show are few (groups times ``shown``): the canonical table keeps only theirs before the left join.
    out = materialize(out.select(*kept), "review-ranks")
    ids = out.where(F.col("post_id").isNotNull()).select("post_id").distinct()
    previews = with_previews(details.join(ids, "post_id", "left_semi")).select("post_id", "excerpt", "permalink", *seen)
    return out.join(previews, "post_id", "left").select(*kept, "excerpt", "permalink", *seen)


def _third_level(tree: DataFrame, best: DataFrame, l3_clusters: DataFrame, l3_labels: DataFrame | None) -> DataFrame:
    sizes = topic_sizes(l3_clusters).select(F.col("topic").alias("l3_topic"), F.col("size").alias("l3_size"))
    best = best.select(F.col("group").alias("l2_topic"), F.col("sub").alias("l3_topic"), "post_id", "score", "rank")
    l3 = tree.where(F.col("level") == "L2").select("l1_rank", "l2_rank", "l1_id", "l2_topic").join(best, "l2_topic")
    l3 = l3.join(sizes, "l3_topic", "left").withColumn("size", F.coalesce("l3_size", F.lit(0))).drop("l3_size")
    if l3_labels is not None:
        l3 = l3.join(l3_labels.select(F.col("topic").alias("l3_topic"), "label", "summary"), "l3_topic", "left")
    else:
        l3 = l3.withColumns({"label": F.lit(None).cast("string"), "summary": F.lit(None).cast("string")})
    named = {
        "level": F.lit("L3"),
        "label": first_of(F.col("label"), default_label("L3", F.col("l3_topic"))),
        "summary": F.coalesce("summary", F.lit("")),
    }
    return l3.withColumns(named)


def growth_review(
    canonical: DataFrame,
    clusters: DataFrame,
    labels: DataFrame | None = None,
    windows: Sequence[int] = REPORT_WINDOWS,
    limit: int = REPORT_LIMIT,
) -> DataFrame:
    """Growth per window with labels, the fastest growing topics first. ``labels``: ``topic, label``."""
    rows = dated_topics(clusters, canonical.select("post_id", "date"))
    ranked = ranked_growth(growth_counts(rows, windows), limit)
    fallback = default_label("L3", F.col("topic"))
    if labels is None:
        return ranked.withColumn("label", fallback)
    return ranked.join(labels.select("topic", "label"), "topic", "left").withColumn("label", F.coalesce("label", fallback))


def growing_posts(canonical: DataFrame, clusters: DataFrame, topics: DataFrame, shown: int = SHOWN_POSTS) -> DataFrame:
    """Top posts of the chosen topics among their dated posts."""
    rows = dated_topics(clusters, canonical.select("post_id", "date", _score(canonical).alias("score")))
    mine = rows.join(topics.select("topic").distinct(), "topic", "left_semi")
    best = top_scored_posts(mine.select("topic", "post_id", "score"), shown)
    details = project_existing(canonical, [c for c in POST_COLUMNS if c != "score"])
    return with_previews(best.join(details, "post_id"))


def keyword_growth(canonical: DataFrame, l3_clusters: DataFrame, keywords: DataFrame, window_days: int = 90) -> tuple[DataFrame, DataFrame]:
    """Monthly series per subtopic, and growth per subtopic with its keyword ideas (one key column)."""
    rows = dated_topics(l3_clusters.select("post_id", "topic", "parent_topic"), canonical.select("post_id", "date"))
    growth = topic_growth(rows, window_days).withColumnRenamed("topic", "l3_topic")
    return monthly_series(rows), growth.join(keywords, "l3_topic", "left")
