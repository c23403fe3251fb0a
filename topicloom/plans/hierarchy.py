"""Topics grouped into a first level, with a prompt and a label per group and topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import GROUP_PROMPT, fill_prompt, join_examples, reply_label, reply_summary
from topicloom.operators.centroids import topic_centroids
from topicloom.operators.examples import central_examples
from topicloom.operators.labels import Labeller, default_label, run_labeller
from topicloom.operators.ranking import topic_sizes
from topicloom.operators.ward import ward_groups
from topicloom.session import materialize

# Defaults of the hierarchy job.
L1_COUNT = 20
SAMPLE_SIZE = 30
MAX_CHARS = 400
L1_LABEL_LIMIT = 10
L2_LABEL_LIMIT = 20


def group_sizes(sizes: DataFrame, groups: DataFrame) -> DataFrame:
    """``l1_id, size``: posts per group, from posts per topic."""
    return sizes.join(groups, "topic").groupBy("l1_id").agg(F.sum("size").alias("size"))


def hierarchy_levels(
    sizes: DataFrame, groups: DataFrame, l1_limit: int = L1_LABEL_LIMIT, l2_limit: int = L2_LABEL_LIMIT
) -> DataFrame:
    """``level, l1_id, l2_topic, size``: the largest topics, and the largest groups that hold one of them.

    A group's size counts all of its topics.
    """
    by_size = Window.orderBy(F.desc("size"), F.asc("topic"))
    top = sizes.join(groups, "topic").withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= l2_limit)
    by_group = Window.orderBy(F.desc("size"), F.asc("l1_id"))
    l1 = group_sizes(sizes, groups).withColumn("rank", F.row_number().over(by_group)).where(F.col("rank") <= l1_limit)
    l1 = l1.join(top.select("l1_id"), "l1_id", "left_semi")
    none = F.lit(None).cast(sizes.schema["topic"].dataType)
    return l1.select(F.lit("L1").alias("level"), "l1_id", none.alias("l2_topic"), "size").unionByName(
        top.select(F.lit("L2").alias("level"), "l1_id", F.col("topic").alias("l2_topic"), "size")
    )


def hierarchy_prompts(posts: DataFrame, levels: DataFrame, sample_size: int = SAMPLE_SIZE, max_chars: int = MAX_CHARS) -> DataFrame:
    """The levels with a prompt each; a group's examples come from its listed topics taken together."""
    listed = levels.where(F.col("level") == "L2").select(F.col("l2_topic").alias("topic"), F.col("l1_id").alias("g"))
    shown = levels.where(F.col("level") == "L1").select(F.col("l1_id").alias("g"))
    rows = posts.join(F.broadcast(listed), "topic")
    of_topics = central_examples(rows, sample_size, max_chars).select(F.col("topic").alias("l2_topic"), "examples")
    of_groups = central_examples(rows.join(F.broadcast(shown), "g", "left_semi").drop("topic"), sample_size, max_chars, ["g"])
    l1 = levels.where(F.col("level") == "L1").join(of_groups.withColumnRenamed("g", "l1_id"), "l1_id")
    l2 = levels.where(F.col("level") == "L2").join(of_topics, "l2_topic")
    both = l1.unionByName(l2)
    known = F.when(F.col("level") == "L1", default_label("L1", F.col("l1_id"))).otherwise(default_label("Topic", F.col("l2_topic")))
    prompt = fill_prompt(GROUP_PROMPT, level=F.col("level"), label=known, examples=join_examples(F.col("examples")))
    return both.select("level", "l1_id", "l2_topic", "size", prompt.alias("prompt"))


def build_hierarchy(
    posts: DataFrame,
    clusters: DataFrame,
    labeller: Labeller,
    l1_count: int = L1_COUNT,
    l1_limit: int = L1_LABEL_LIMIT,
    l2_limit: int = L2_LABEL_LIMIT,
    sample_size: int = SAMPLE_SIZE,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """``level, l1_id, l2_topic, size, label, summary`` for the largest groups and topics."""
    rows = clusters.select("post_id", "topic").join(posts.select("post_id", "text", "embedding"), "post_id")
    groups = materialize(ward_groups(topic_centroids(rows), l1_count), "groups")
    levels = materialize(hierarchy_levels(topic_sizes(rows), groups, l1_limit, l2_limit), "levels")
    prompts = materialize(hierarchy_prompts(rows, levels, sample_size, max_chars), "hierarchy-prompts")
    replies = run_labeller(prompts, labeller)
    return replies.select(
        "level", "l1_id", "l2_topic", "size", reply_label(F.col("reply")).alias("label"), reply_summary(F.col("reply")).alias("summary")
    )
