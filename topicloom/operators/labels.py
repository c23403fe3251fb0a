"""Which label a topic carries, and the model calls that make labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import clean_label, reply_value
from topicloom.operators.ranking import top_per_group
from topicloom.session import materialize

# A labeller takes prompts and returns replies, one per prompt.
Labeller = Callable[[list[str]], list[str]]

# The label source the review shows by default.
REVIEW_BACKEND = "openai"
REVIEW_SAMPLE_SIZE = 20


def last_labels(labels: DataFrame, order: str) -> DataFrame:
    """``topic, label``: the cleaned label of the last row per topic that has one, by the ``order`` column."""
    cleaned = labels.where(F.col("topic").isNotNull()).select("topic", order, clean_label(F.col("label")).alias("label"))
    usable = cleaned.where(F.col("label").isNotNull() & (F.col("label") != ""))
    return usable.groupBy("topic").agg(F.max_by("label", F.struct(order, "label")).alias("label"))


def _from_replies(labels: DataFrame, backend: str | None) -> DataFrame:
    rows = labels.where(F.col("topic").isNotNull())
    if backend is not None and "backend" in labels.columns:
        rows = rows.where(F.col("backend") == backend)
    return rows.withColumns({c: reply_value(F.coalesce(c, F.lit("")), c) for c in ("label", "summary")})


def review_labels(
    labels: DataFrame, backend: str | None = REVIEW_BACKEND, sample_size: int | None = REVIEW_SAMPLE_SIZE, order: str = "label_no"
) -> DataFrame:
    """``topic, label, summary`` from the rows of one backend and sample size; the last row per topic counts."""
    rows = _from_replies(labels, backend)
    if sample_size is not None and "sample_size" in labels.columns:
        rows = rows.where(F.col("sample_size") == sample_size)
    last = rows.groupBy("topic").agg(F.max(F.struct(order, "label", "summary")).alias("r"))
    return last.select("topic", "r.label", "r.summary")


def widest_labels(labels: DataFrame, backend: str | None = REVIEW_BACKEND, order: str = "label_no") -> DataFrame:
    """``topic, label, summary`` from the row with the largest sample size; the earliest such row counts."""
    rows = _from_replies(labels, backend)
    first = rows.groupBy("topic").agg(
        F.min(F.struct((-F.col("sample_size")).alias("minus"), F.col(order), "label", "summary")).alias("r")
    )
    return first.select("topic", "r.label", "r.summary")


def first_of(*choices: Column) -> Column:
    """The first choice that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def default_label(prefix: str, topic: Column) -> Column:
    """``Topic 7`` and the like."""
    return F.concat(F.lit(f"{prefix} "), topic.cast("string"))


def run_labeller(prompts: DataFrame, labeller: Labeller) -> DataFrame:
    """The prompt table with a ``reply`` column; ``labeller`` runs in the tasks, once per Arrow batch.

    Prompts are dealt over all tasks, and the replies are written at once: a model is asked a single time, whatever is
    done with the result.
    """
    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(reply=labeller(batch["prompt"].tolist()))

    from pyspark.sql import types as T

    schema = T.StructType([*prompts.schema.fields, T.StructField("reply", T.StringType())])
    spread = prompts.repartition(prompts.sparkSession.sparkContext.defaultParallelism)
    return materialize(spread.mapInPandas(call, schema), "replies")


# Fixed value: what counts as a word.
WORD = r"[\p{L}\p{N}]+"


def topic_terms(posts: DataFrame, terms: int, text: str = "text") -> DataFrame:
    """``topic, rank, term, weight``: words frequent in a topic and rare across topics.

    Weight is the word's share of the topic's words times ln(1 + average words per topic / uses of the word). All
    counts are combined before the shuffle, so a topic or word with most of the text is no hot spot.
    """
    words = posts.where(F.col("topic") != -1).select(
        "topic", F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))).alias("term")
    )
    counts = words.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("n"))
    per_topic = counts.groupBy("topic").agg(F.sum("n").alias("topic_words"))
    per_term = counts.groupBy("term").agg(F.sum("n").alias("uses"))
    average = per_topic.agg(F.avg("topic_words").alias("average"))
    weight = F.col("n") / F.col("topic_words") * F.log(1 + F.col("average") / F.col("uses"))
    scored = counts.join(per_term, "term").join(per_topic, "topic").join(F.broadcast(average)).withColumn("weight", weight)
    ranked = top_per_group(scored, ["topic"], [F.desc("weight"), F.asc("term")], terms, spread_on="term")
    return ranked.select("topic", "rank", "term", "weight")


def term_labels(posts: DataFrame, terms: int = 6) -> DataFrame:
    """``topic, label, summary`` without any model: the strongest terms of each topic."""
    ranked = topic_terms(posts, terms)
    words = F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda p: p["term"])
    return ranked.groupBy("topic").agg(F.array_join(words, " ").alias("label"), F.array_join(words, ", ").alias("summary"))
