"""Splitting and merging topics by decisions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicloom.functions.text import MERGE_PROMPT, SPLIT_PROMPT, fill_prompt, join_examples, merge_decision, split_decision
from topicloom.operators.centroids import topic_centroids, top_n_topics
from topicloom.operators.components import connected_components
from topicloom.operators.forest import climbed, merge_tree, spanning_forest
from topicloom.operators.examples import central_examples
from topicloom.operators.neighbors import similar_pairs
from topicloom.operators.ranking import dense_ids, largest_topics, next_topic_id
from topicloom.operators.split import MIN_ROWS, new_split_ids, split_topics
from topicloom.session import materialize

# Defaults of the refinement job.
SAMPLE_SIZE = 30
MAX_CHARS = 400
SPLIT_MIN_SIZE = 800
SPLIT_LIMIT = 20
MERGE_SIMILARITY = 0.9
MERGE_LIMIT = 30
TOP_N = 3

# Decisions come as a table or as a function from the prompt table to that table.
Decider = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Refined:
    """The refined clustering and the report of what was asked and done."""

    clusters: DataFrame
    report: DataFrame


def split_candidates(clusters: DataFrame, min_size: int = SPLIT_MIN_SIZE, limit: int = SPLIT_LIMIT) -> DataFrame:
    """``topic, size, rank`` of the topics large enough to be asked about."""
    order = Window.orderBy(F.desc("size"), F.asc("topic"))
    return largest_topics(clusters, limit, min_size).withColumn("rank", F.row_number().over(order))


def split_prompts(posts: DataFrame, candidates: DataFrame, sample_size: int = SAMPLE_SIZE, max_chars: int = MAX_CHARS) -> DataFrame:
    """``topic, rank, prompt``: one question per candidate."""
    mine = posts.join(F.broadcast(candidates.select("topic")), "topic", "left_semi")
    examples = central_examples(mine, sample_size, max_chars)
    prompt = fill_prompt(SPLIT_PROMPT, topic=F.col("topic"), examples=join_examples(F.col("examples")))
    return candidates.join(examples, "topic").select("topic", "rank", prompt.alias("prompt"))


def merge_candidates(posts: DataFrame, min_sim: float = MERGE_SIMILARITY, limit: int = MERGE_LIMIT) -> DataFrame:
    """``topic_a, topic_b, similarity, rank``: the most similar pairs of topics."""
    pairs = similar_pairs(topic_centroids(posts).select("topic", "centroid"), min_sim, limit)
    order = Window.orderBy(F.desc("sim"), F.asc("a"), F.asc("b"))
    return pairs.select(
        F.col("a").alias("topic_a"), F.col("b").alias("topic_b"), F.col("sim").alias("similarity"), F.row_number().over(order).alias("rank")
    )


def merge_prompts(posts: DataFrame, pairs: DataFrame, sample_size: int = SAMPLE_SIZE, max_chars: int = MAX_CHARS) -> DataFrame:
    """The pairs with one question each."""
    named = pairs.select(F.explode(F.array("topic_a", "topic_b")).alias("topic")).distinct()
    examples = central_examples(posts.join(named, "topic", "left_semi"), sample_size, max_chars)
    side = {s: examples.select(F.col("topic").alias(f"topic_{s}"), join_examples(F.col("examples")).alias(f"ex_{s}")) for s in "ab"}
    prompt = fill_prompt(
        MERGE_PROMPT, topic_a=F.col("topic_a"), examples_a=F.col("ex_a"), topic_b=F.col("topic_b"), examples_b=F.col("ex_b")
    )
    return pairs.join(side["a"], "topic_a").join(side["b"], "topic_b").select(*pairs.columns, prompt.alias("prompt"))


def _decide(decider: Decider, prompts: Callable[[], DataFrame]) -> DataFrame:
    return decider if isinstance(decider, DataFrame) else decider(prompts())


def asked_pairs(decided: DataFrame) -> DataFrame:
    """The pairs that are really asked: not yet connected through earlier approved pairs.

    The forest of the approved pairs in the order of their rank tells which topics were one when a pair came up.
    """
    forest = materialize(spanning_forest(decided.where("merge").selectExpr("topic_a AS a", "topic_b AS b", "rank AS w")), "approved-forest")
    topics = forest.selectExpr("a AS leaf").union(forest.selectExpr("b AS leaf")).distinct()
    tree = merge_tree(forest.selectExpr("a AS leaf_a", "b AS leaf_b", "w", "a", "b"), topics)
    key = "struct(rank AS w, topic_a AS a, topic_b AS b) AS key"
    homes = [climbed(decided.selectExpr("rank AS id", key, f"topic_{s} AS leaf"), tree).selectExpr("id AS rank", f"c AS home_{s}") for s in "ab"]
    met = decided.join(homes[0], "rank", "left").join(homes[1], "rank", "left")
    return met.where("NOT coalesce(home_a = home_b, false)").select(*decided.columns)


def refine(
    posts: DataFrame,
    clusters: DataFrame,
    split_decisions: Decider,
    merge_decisions: Decider,
    split_min_size: int = SPLIT_MIN_SIZE,
    split_limit: int = SPLIT_LIMIT,
    merge_similarity: float = MERGE_SIMILARITY,
    merge_limit: int = MERGE_LIMIT,
    top_n: int = TOP_N,
    sample_size: int = SAMPLE_SIZE,
    max_chars: int = MAX_CHARS,
    relabel_always: bool = True,
) -> Refined:
    """Split approved large topics in two, merge approved similar topics, renumber, and score top topics.

    ``split_decisions``: ``topic, action, reason``. ``merge_decisions``: ``topic_a, topic_b, merge, reason``. Without
    ``relabel_always`` ids become dense only when there were pairs to decide about.
    """
    rows = materialize(clusters.select("post_id", "topic").join(posts.select("post_id", "text", "embedding"), "post_id"), "refine-rows")
    candidates = materialize(split_candidates(rows, split_min_size, split_limit), "split-candidates")
    answers = _decide(split_decisions, lambda: split_prompts(rows, candidates, sample_size, max_chars))
    checked = candidates.join(
        answers.select("topic", split_decision(F.col("action")).alias("decision"), "reason"), "topic"
    )
    checked = materialize(checked, "split-checked")
    chosen = checked.where((F.col("decision") == "split") & (F.col("size") >= MIN_ROWS))
    rows, ids = _apply_splits(rows, chosen)

    pairs = materialize(merge_candidates(rows, merge_similarity, merge_limit), "merge-pairs")
    had_pairs = not pairs.isEmpty()
    answers = _decide(merge_decisions, lambda: merge_prompts(rows, pairs, sample_size, max_chars))
    decided = pairs.join(
        answers.select("topic_a", "topic_b", merge_decision(F.col("merge")).alias("merge"), "reason"), ["topic_a", "topic_b"]
    )
    decided = materialize(decided, "merge-decided")
    asked = materialize(asked_pairs(decided), "merge-asked")
    roots = connected_components(
        asked.where("merge").select(F.lit(0).alias("part"), F.col("topic_a").alias("src"), F.col("topic_b").alias("dst"))
    ).select(F.col("id").alias("topic"), "root")
    final = rows.join(roots, "topic", "left").withColumn("topic", F.coalesce("root", "topic")).drop("root")
    if relabel_always or had_pairs:
        final = relabel(final)
    final = materialize(final.select("post_id", "topic", "embedding"), "refined")
    scored = top_n_topics(final, topic_centroids(final), top_n, ["post_id", "topic"])
    return Refined(scored, refinement_report(checked, ids, asked, had_pairs))


def _apply_splits(rows: DataFrame, chosen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with approved topics cut in two, and the table ``topic, side, new_topic``."""
    if chosen.isEmpty():
        return rows, rows.select("topic", F.lit(0).alias("side"), F.lit(0).alias("new_topic")).limit(0)
    sides = materialize(split_topics(rows.select("post_id", "topic", "embedding"), chosen), "split-sides")
    halves = sides.select("topic", "side").distinct().join(chosen.select("topic", "rank"), "topic")
    ids = materialize(new_split_ids(halves, next_topic_id(rows, empty=0)), "split-ids")
    moved = sides.join(ids, ["topic", "side"]).select("post_id", "new_topic")
    cut = rows.join(moved, "post_id", "left").withColumn("topic", F.coalesce("new_topic", "topic")).drop("new_topic")
    return materialize(cut, "refine-split"), ids


def relabel(rows: DataFrame) -> DataFrame:
    """Topics renumbered from 0 by their smallest post id; noise stays."""
    firsts = rows.where(F.col("topic") != -1).groupBy("topic").agg(F.min("post_id").alias("first_post"))
    ids = dense_ids(firsts, ["first_post"], "dense").select("topic", "dense")
    return rows.join(ids, "topic", "left").withColumn("topic", F.coalesce("dense", F.lit(-1))).drop("dense")


def refinement_report(checked: DataFrame, ids: DataFrame, asked: DataFrame, had_pairs: bool) -> DataFrame:
    """What was asked and applied, as rows with only the columns each action has."""
    spark = checked.sparkSession
    parts = [
        checked.select(F.lit("split_check").alias("action"), "topic", "decision", "reason"),
        ids.select(F.lit("split_apply").alias("action"), "topic", "new_topic"),
        asked.select(
            F.lit("merge_check").alias("action"), "topic_a", "topic_b", "similarity", F.col("merge").cast("string").alias("decision"), "reason"
        ),
    ]
    if had_pairs:
        parts.append(spark.range(1).select(F.lit("merge_apply").alias("action"), F.lit("Applied union-find merges.").alias("notes")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part, allowMissingColumns=True)
    return report
