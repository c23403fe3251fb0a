"""Posts of a large topic assigned to the anchors that divide it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.functions.text import anchor_text, clean_label, keyword_list, parse_anchors
from topicloom.functions.vectors import cosine_each

# Fixed value: posts less similar than this to every anchor are noise.
MIN_SIMILARITY = 0.2


def anchors_from_replies(replies: DataFrame) -> DataFrame:
    """``l2_topic, l2_rank, reply`` -> one row per usable anchor with cleaned label, keywords and a running id.

    Ids follow the order of the topics and of the anchors in the reply. One row per anchor, never per post.
    """
    from topicloom.operators.ranking import dense_ids

    listed = replies.select("l2_topic", "l2_rank", F.posexplode(parse_anchors(F.col("reply"))).alias("anchor_no", "anchor"))
    keywords = F.coalesce(F.col("anchor.keywords"), F.array().cast("array<string>"))
    named = F.filter(keywords, lambda k: k.isNotNull() & (F.trim(k) != ""))
    cleaned = listed.select(
        "l2_topic",
        "l2_rank",
        "anchor_no",
        clean_label(F.coalesce(F.col("anchor.label"), F.lit(""))).alias("l3_label"),
        F.transform(named, clean_label).alias("keyword_array"),
    ).where(F.col("l3_label") != "")
    numbered = dense_ids(cleaned, ["l2_rank", "anchor_no"], "l3_topic")
    return numbered.withColumns(
        {"keywords": keyword_list(F.col("keyword_array")), "text": anchor_text(F.col("l3_label"), F.col("keyword_array"))}
    )


def assign_anchors(posts: DataFrame, anchors: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``post_id, topic, parent_topic, top_n_topics, top_n_scores`` for the posts of topics that have anchors.

    ``posts``: ``post_id, topic, embedding``. ``anchors``: ``l2_topic, l3_topic, embedding``. A post meets only the
    anchors of its own topic, packed in one row per topic; scores stay in anchor order and the earliest anchor wins a
    tie. A post below ``min_similarity`` is noise.
    """
    listed = F.sort_array(F.collect_list(F.struct("l3_topic", "embedding")))
    packed = anchors.groupBy(F.col("l2_topic").alias("parent_topic")).agg(listed.alias("anchors"))
    own = posts.where(F.col("topic") != -1).select("post_id", F.col("topic").alias("parent_topic"), F.col("embedding").alias("vector"))
    scored = own.join(packed, "parent_topic").select(
        "post_id",
        "parent_topic",
        F.col("anchors.l3_topic").cast("array<int>").alias("top_n_topics"),
        cosine_each(F.col("vector"), F.col("anchors.embedding")).alias("top_n_scores"),
    )
    best = F.array_max("top_n_scores")
    first = F.get("top_n_topics", (F.array_position("top_n_scores", best) - 1).cast("int"))
    topic = F.when(best < min_similarity, F.lit(-1)).otherwise(first).cast("int")
    return scored.select("post_id", topic.alias("topic"), "parent_topic", "top_n_topics", "top_n_scores")
