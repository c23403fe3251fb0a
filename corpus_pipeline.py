"""From raw documents to packed sequences: five stages, each over all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicloom.llm import mixing, near_dup, packing, suffix_dedup, toxicity
from topicloom.llm.common import read
from topicloom.session import materialize

# A passage has this many words; as many bytes are the least that so many very short words take.
PASSAGE_WORDS = 50
PASSAGE_BYTES = 125


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic."""
    return toxicity.reject_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_dup.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that stand elsewhere too."""
    return suffix_dedup.without_repeats(docs, PASSAGE_BYTES, PASSAGE_WORDS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents that make up sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("mix", mix),
    ("pack", pack),
]

# Near-duplicates, the toxicity model and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
