"""The incremental twins of the batch jobs, as Structured Streaming queries over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.contract import DataContract
from topicloom.operators.embed import ModelFactory, embed_with_model, text_table
from topicloom.operators.quality import canonical, enforce, long_metrics, metric_columns, stringify_extras, validation_metrics
from topicloom.sources.readers import read_jsonl_stream


def _drain(df: DataFrame, path: str, checkpoint: str) -> None:
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stream_canonical(
    spark: SparkSession, folder: str, schema: T.StructType | str, contract: DataContract, output: str, checkpoint: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Canonical export of every file that arrived, exactly once, in micro-batches of bounded size; returns the metrics.

    When the files that are there have been written, all that was exported so far is held against the contract: a
    required column that is absent or a limit that is broken is an error. A required column that is absent counts
    as null in every row.
    """
    rows = stringify_extras(canonical(read_jsonl_stream(spark, folder, schema, files_per_trigger), contract), contract)
    _drain(rows, output, checkpoint)
    metrics = validation_metrics(spark.read.schema(rows.schema).parquet(output), contract, absent_is_null=True)
    enforce(metrics, contract)
    return metrics


def stream_metrics(
    spark: SparkSession, folder: str, schema: T.StructType | str, contract: DataContract, output: str, checkpoint: str, files_per_trigger: int | None = None
) -> DataFrame:
    """Validation metrics kept per micro-batch and summed; a batch that is replayed overwrites its own row."""
    raw = canonical(read_jsonl_stream(spark, folder, schema, files_per_trigger), contract)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.agg(*metric_columns(batch, contract, absent_is_null=True)).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")

    query = raw.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stored_metrics(spark, output, contract)


def stored_metrics(spark: SparkSession, output: str, contract: DataContract) -> DataFrame:
    """The metrics over all batches so far, in the form of the batch check."""
    stored = spark.read.parquet(output).drop("batch_id")
    return long_metrics(stored.agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in stored.columns]), contract)


def check_stream(spark: SparkSession, output: str, contract: DataContract) -> None:
    """Raise when the batches taken together break the contract's limits."""
    enforce(stored_metrics(spark, output, contract), contract)


def stream_embeddings(
    spark: SparkSession, folder: str, schema: T.StructType | str, factory: ModelFactory, output: str, checkpoint: str, files_per_trigger: int | None = None
) -> None:
    """Vectors for every canonical file that arrives, appended to the stage table."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    _drain(embed_with_model(text_table(reader.parquet(folder)), factory), output, checkpoint)
