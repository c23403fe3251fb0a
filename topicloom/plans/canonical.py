"""From raw input to the canonical table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicloom.contract import DataContract
from topicloom.operators.quality import canonical, enforce, require_columns, stringify_extras, validation_metrics
from topicloom.sources.readers import read_tabular
from topicloom.sources.sinks import write_stage


def canonicalize(spark: SparkSession, path: str, contract: DataContract, schema=None) -> DataFrame:
    """Read, rename, parse dates, and check that every required column is there."""
    return require_columns(canonical(read_tabular(spark, path, schema), contract), contract)


def export_canonical(spark: SparkSession, path: str, output: str, contract: DataContract, schema=None) -> DataFrame:
    """Validate the whole input, then write it; nothing is written when a limit is broken. Returns the metrics."""
    rows = canonical(read_tabular(spark, path, schema), contract)
    metrics = validation_metrics(rows, contract)
    enforce(metrics, contract)
    write_stage(stringify_extras(rows, contract), output)
    return metrics
