"""Jobs that ask a model about topics: labels, keywords, anchors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import (
    ANCHOR_PROMPT,
    KEYWORD_PROMPT,
    TOPIC_PROMPT,
    fill_prompt,
    join_examples,
    keyword_list,
    numeric_score,
    parse_keywords,
    reply_label,
    reply_summary,
)
from topicloom.operators.anchors import MIN_SIMILARITY, anchors_from_replies, assign_anchors
from topicloom.operators.embed import ModelFactory, embed_with_model
from topicloom.operators.examples import central_posts, scored_examples
from topicloom.operators.labels import Labeller, default_label, run_labeller
from topicloom.operators.ranking import collect_ranked, largest_topics, topic_sizes
from topicloom.session import materialize
from topicloom.sources.sinks import LABEL_KEYS, unseen

# Defaults of the labelling, keyword and anchor jobs.
SAMPLE_SIZE = 30
MAX_CHARS = 400
L3_THRESHOLD = 500
L2_THRESHOLD = 500
ANCHORS_PER_TOPIC = 8


def topic_prompts(posts: DataFrame, sample_sizes: Sequence[int], max_chars: int = MAX_CHARS, topic_limit: int | None = None) -> DataFrame:
    """``topic, sample_size, prompt`` for every topic and sample size, from one ranking of the posts."""
    rows = posts
    if topic_limit is not None:
        rows = posts.join(F.broadcast(largest_topics(posts, topic_limit).select("topic")), "topic", "left_semi")
    ranked = central_posts(rows, max(sample_sizes)).withColumn("text", F.substring("text", 1, max_chars))
    sized = ranked.withColumn("sample_size", F.explode(F.array(*[F.lit(n) for n in sample_sizes]))).where(F.col("rank") <= F.col("sample_size"))
    examples = collect_ranked(sized, ["topic", "sample_size"], "text")
    prompt = fill_prompt(TOPIC_PROMPT, topic=F.col("topic"), examples=join_examples(F.col("examples")))
    return examples.select("topic", "sample_size", prompt.alias("prompt"))


def label_topics(
    posts: DataFrame,
    labellers: dict[str, tuple[str, Labeller]],
    sample_sizes: Sequence[int],
    existing: DataFrame | None = None,
    max_chars: int = MAX_CHARS,
    topic_limit: int | None = None,
) -> DataFrame:
    """``topic, sample_size, backend, model, label, summary``; rows already in ``existing`` are not asked for again.

    ``labellers`` maps a backend name to its model name and function.
    """
    prompts = materialize(topic_prompts(posts, sample_sizes, max_chars, topic_limit), "topic-prompts")
    out = None
    for backend, (model, labeller) in labellers.items():
        todo = prompts.withColumn("backend", F.lit(backend))
        if existing is not None:
            todo = unseen(todo, existing, LABEL_KEYS)
        replies = run_labeller(todo, labeller).select(
            "topic",
            "sample_size",
            "backend",
            F.lit(model).alias("model"),
            reply_label(F.col("reply")).alias("label"),
            reply_summary(F.col("reply")).alias("summary"),
        )
        out = replies if out is None else out.unionByName(replies)
    return out


def parent_mode(posts: DataFrame) -> DataFrame:
    """``topic, parent_topic``: the parent most posts of a topic have, the smallest on a tie. Counted before ranking."""
    counts = posts.where(F.col("parent_topic").isNotNull()).groupBy("topic", "parent_topic").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("topic").agg(F.min(F.struct((-F.col("n")).alias("minus"), "parent_topic")).alias("b"))
    return best.select("topic", F.col("b.parent_topic").alias("parent_topic"))


def _labelled(df: DataFrame, labels: DataFrame | None, topic: str, prefix: str, name: str) -> DataFrame:
    fallback = default_label(prefix, F.col(topic))
    if labels is None:
        return df.withColumn(name, fallback)
    named = labels.select(F.col("topic").alias(topic), F.col("label").alias("__label"))
    return df.join(named, topic, "left").withColumn(name, F.coalesce("__label", fallback)).drop("__label")


def keyword_prompts(
    posts: DataFrame,
    min_size: int = L3_THRESHOLD,
    sample_size: int = SAMPLE_SIZE,
    max_chars: int = MAX_CHARS,
    l2_labels: DataFrame | None = None,
    l3_labels: DataFrame | None = None,
) -> DataFrame:
    """``l2_topic, l3_topic, l2_label, l3_label, sample_size, post_count, prompt`` for large enough subtopics.

    ``posts``: ``post_id, topic, parent_topic, title, body, score``.
    """
    sizes = topic_sizes(posts).where(F.col("size") >= min_size)
    rows = posts.join(sizes.select("topic"), "topic", "left_semi")
    examples = scored_examples(rows, sample_size, max_chars).where(F.size("examples") > 0)
    base = sizes.join(parent_mode(rows), "topic").join(examples, "topic").select(
        F.col("parent_topic").alias("l2_topic"), F.col("topic").alias("l3_topic"), F.col("size").alias("post_count"), "examples"
    )
    base = _labelled(_labelled(base, l2_labels, "l2_topic", "L2", "l2_label"), l3_labels, "l3_topic", "L3", "l3_label")
    prompt = fill_prompt(
        KEYWORD_PROMPT, l2_label=F.col("l2_label"), l3_label=F.col("l3_label"), examples=join_examples(F.col("examples"))
    )
    return base.select(
        "l2_topic", "l3_topic", "l2_label", "l3_label", F.lit(sample_size).alias("sample_size"), "post_count", prompt.alias("prompt")
    )


def keyword_ideas(posts: DataFrame, labeller: Labeller, **options) -> DataFrame:
    """``l2_topic, l3_topic, l2_label, l3_label, keywords, sample_size, post_count``."""
    replies = run_labeller(keyword_prompts(posts, **options), labeller)
    return replies.select(
        "l2_topic", "l3_topic", "l2_label", "l3_label", keyword_list(parse_keywords(F.col("reply"))).alias("keywords"), "sample_size", "post_count"
    )


@dataclass(frozen=True)
class AnchorTables:
    """Everything the anchor job produces."""

    clusters: DataFrame
    anchors: DataFrame
    keywords: DataFrame
    labels: DataFrame


def anchor_prompts(
    posts: DataFrame,
    min_size: int = L2_THRESHOLD,
    l2_limit: int | None = None,
    sample_size: int = SAMPLE_SIZE,
    max_chars: int = MAX_CHARS,
    anchors_per_topic: int = ANCHORS_PER_TOPIC,
    l2_labels: DataFrame | None = None,
) -> DataFrame:
    """``l2_topic, l2_rank, l2_label, post_count, prompt`` for large enough topics, largest first."""
    order = Window.orderBy(F.desc("size"), F.asc("topic"))
    large = largest_topics(posts, l2_limit, min_size).withColumn("l2_rank", F.row_number().over(order))
    rows = posts.join(large.select("topic"), "topic", "left_semi")
    examples = scored_examples(rows, sample_size, max_chars).where(F.size("examples") > 0)
    base = large.join(examples, "topic").select(F.col("topic").alias("l2_topic"), "l2_rank", F.col("size").alias("post_count"), "examples")
    base = _labelled(base, l2_labels, "l2_topic", "L2", "l2_label")
    prompt = fill_prompt(
        ANCHOR_PROMPT, l2_label=F.col("l2_label"), max_anchors=F.lit(anchors_per_topic), examples=join_examples(F.col("examples"))
    )
    return base.select("l2_topic", "l2_rank", "l2_label", "post_count", prompt.alias("prompt"))


def anchor_posts(clusters: DataFrame, posts: DataFrame, canonical: DataFrame) -> DataFrame:
    """Clustered posts with vectors and, where there is one, their canonical row; an absent score counts as 0."""
    joined = clusters.select("post_id", "topic").join(posts.select("post_id", "embedding"), "post_id")
    joined = joined.join(canonical.select("post_id", "title", "body", "score"), "post_id", "left")
    return joined.withColumn("score", numeric_score(F.col("score")))


def group_by_anchors(
    rows: DataFrame,
    labeller: Labeller,
    model: ModelFactory,
    backend: str,
    model_name: str,
    sample_size: int = SAMPLE_SIZE,
    min_similarity: float = MIN_SIMILARITY,
    **options,
) -> AnchorTables:
    """Third-level topics from anchors a model proposes: clusters, anchors, keywords and labels.

    Only posts of topics that got anchors are in the result; the post count of an anchor is that of its topic, and
    ``assigned_count`` counts its own posts.
    """
    asked = materialize(run_labeller(anchor_prompts(rows, sample_size=sample_size, **options), labeller), "anchor-replies")
    anchors = materialize(anchors_from_replies(asked), "anchors")
    vectors = embed_with_model(anchors.select(F.col("l3_topic").alias("post_id"), "text"), model)
    placed = anchors.join(vectors.select(F.col("post_id").alias("l3_topic"), "embedding"), "l3_topic")
    clusters = materialize(assign_anchors(rows, placed.select("l2_topic", "l3_topic", "embedding"), min_similarity), "anchor-clusters")
    named = anchors.join(asked.select("l2_topic", "l2_label", "post_count"), "l2_topic")
    counts = topic_sizes(clusters).select(F.col("topic").alias("l3_topic"), F.col("size").alias("assigned_count"))
    base = ["l2_topic", "l3_topic", "l2_label", "l3_label", "keywords"]
    keywords = named.join(counts, "l3_topic", "left").select(
        *base, F.lit(sample_size).alias("sample_size"), "post_count", F.coalesce("assigned_count", F.lit(0)).alias("assigned_count")
    )
    labels = named.select(
        F.col("l3_topic").alias("topic"),
        F.lit(sample_size).alias("sample_size"),
        F.lit(backend).alias("backend"),
        F.lit(model_name).alias("model"),
        F.col("l3_label").alias("label"),
        F.col("keywords").alias("summary"),
    )
    return AnchorTables(clusters, named.select(*base), keywords, labels)
