"""Posts to vectors, and what that would cost."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.text import build_text
from topicloom.functions.vectors import to_lists
from topicloom.operators.labels import WORD
from topicloom.operators.ranking import sample_exact
from topicloom.session import materialize

# A model factory runs once per task and returns a function from texts to a matrix.
ModelFactory = Callable[[], Callable[[list[str]], np.ndarray]]

# Batch size, sample size, seed, rates, prices, model names and texts of the cost estimate.
BATCH_ROWS = 128
SAMPLE_ROWS = 2000
SEED = 7
HOSTED_TOKENS_PER_SECOND = 4000.0
HOSTED_PRICE_PER_MILLION = 0.02
CHARS_PER_TOKEN = 4.0
LOCAL_MODEL = "sentence-transformers/all-MiniLM-L6-v2"
HOSTED_MODEL = "text-embedding-3-small"
LOCAL_NOTE = "estimated from sample run"
LOCAL_MISSING_NOTE = "set local_rows_per_second to estimate time"


def text_table(posts: DataFrame, id_column: str = "post_id", title: str = "title", body: str = "body") -> DataFrame:
    """``post_id, text`` whatever the id column was called."""
    return posts.select(F.col(id_column).alias("post_id"), build_text(F.col(title), F.col(body)).alias("text"))


def embed_hashed(texts: DataFrame, dims: int = 256, inverse_frequency: bool = True) -> DataFrame:
    """``post_id, text, embedding`` of unit length from hashed words, without any model file.

    With ``inverse_frequency`` rare words count more, which takes one aggregate of ``dims`` numbers over the texts; term
    counts are written once, so that texts are cut into words a single time.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    counted = HashingTF(numFeatures=dims, inputCol="words", outputCol="tf").transform(texts.withColumn("words", words)).drop("words")
    column = "tf"
    if inverse_frequency:
        counted = materialize(counted.select("post_id", "text", "tf"), "term-counts")
        counted, column = IDF(inputCol="tf", outputCol="tfidf").fit(counted).transform(counted), "tfidf"
    scaled = Normalizer(inputCol=column, outputCol="unit").transform(counted)
    return scaled.select("post_id", "text", vector_to_array("unit", "float32").alias("embedding"))


def embed_with_model(texts: DataFrame, factory: ModelFactory, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``post_id, text, embedding`` from a user model loaded once per task and called on small batches."""
    schema = T.StructType([texts.schema["post_id"], texts.schema["text"], T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                matrix = np.asarray(model(part.column("text").to_pylist()), dtype=np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("post_id"), part.column("text"), to_lists(matrix, pa.float32())], names=["post_id", "text", "embedding"]
                )

    return texts.select("post_id", "text").mapInArrow(run, schema)


def estimate_tokens(texts: DataFrame) -> DataFrame:
    """One row: rows and estimated tokens."""
    return texts.agg(
        F.count(F.lit(1)).alias("rows"), (F.coalesce(F.sum(F.char_length("text")), F.lit(0)) / CHARS_PER_TOKEN).alias("tokens")
    )


def embedding_costs(
    texts: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
    local_rows_per_second: float | None = None,
    tokens_per_second: float = HOSTED_TOKENS_PER_SECOND,
    price_per_million: float = HOSTED_PRICE_PER_MILLION,
    local_model: str = LOCAL_MODEL,
    hosted_model: str = HOSTED_MODEL,
) -> DataFrame:
    """Two rows, local and hosted: tokens scaled from a sample to all posts, hours and cost."""
    sampled = estimate_tokens(sample_exact(texts, sample_rows, seed)).withColumnsRenamed({"rows": "sample_rows", "tokens": "sample_tokens"})
    total = texts.agg(F.count(F.lit(1)).alias("rows_total"))
    base = total.join(F.broadcast(sampled)).withColumn(
        "tokens", F.col("sample_tokens") * (F.col("rows_total") / F.greatest("sample_rows", F.lit(1)))
    )
    tokens = F.round("tokens").cast("bigint")
    local_hours = F.round(F.col("rows_total") / local_rows_per_second / 3600, 2) if local_rows_per_second else F.lit(None).cast("double")
    hosted_hours = F.round(F.col("tokens") / max(tokens_per_second, 1.0) / 3600, 2)
    hosted_note = f"assumes {tokens_per_second:.0f} tokens/sec and ${price_per_million:.2f}/1M tokens"

    def option(name: str, model: str, hours, cost, note: str):
        return F.struct(
            F.lit(name).alias("option"),
            F.lit(model).alias("model"),
            F.col("rows_total"),
            F.col("sample_rows"),
            tokens.alias("est_total_tokens"),
            hours.alias("est_time_hours"),
            cost.alias("est_cost_usd"),
            F.lit(note).alias("notes"),
        )

    return base.select(
        F.inline(
            F.array(
                option("local", local_model, local_hours, F.lit(0.0), LOCAL_NOTE if local_rows_per_second else LOCAL_MISSING_NOTE),
                option("openai", hosted_model, hosted_hours, F.round(F.col("tokens") / 1e6 * price_per_million, 2), hosted_note),
            )
        )
    )


def measured_rows_per_second(texts: DataFrame, factory: ModelFactory, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> float:
    """Throughput of a model on the sample, all tasks together."""
    import time

    sample = sample_exact(texts, sample_rows, seed)
    start = time.monotonic()
    rows = embed_with_model(sample, factory).agg(F.count("embedding").alias("n")).first()["n"]
    return rows / max(time.monotonic() - start, 1e-6)
