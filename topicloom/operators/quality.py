"""Contract checks: renames, required columns, null and date counts, limits, canonical types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.contract import DataContract
from topicloom.functions.dates import parse_date


def apply_mapping(df: DataFrame, contract: DataContract) -> DataFrame:
    """Raw column names to canonical ones; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(contract.column_mapping))


def missing_columns(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    """Required names that are absent, in contract order. No job runs."""
    have = set(columns)
    return [c for c in required if c not in have]


def require_columns(df: DataFrame, contract: DataContract) -> DataFrame:
    """The table itself, or an error naming what it lacks."""
    absent = missing_columns(df.columns, contract.required_columns)
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    return df


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN for floating columns."""
    value = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    return (value.isNull() | F.isnan(value)) if isinstance(kind, (T.DoubleType, T.FloatType)) else value.isNull()


def metric_columns(df: DataFrame, contract: DataContract, absent_is_null: bool = False) -> list[Column]:
    """Aggregates of one pass: rows, nulls per required column, unreadable dates.

    With ``absent_is_null`` (tables that arrive in parts) a column that is not there counts as null in every row and
    is reported as missing too.
    """
    out = [F.count(F.lit(1)).alias("total_rows")]
    for c in contract.required_columns:
        if c in df.columns:
            out.append(F.count_if(is_missing(df, c)).alias(f"null:{c}"))
        elif absent_is_null:
            out.append(F.count(F.lit(1)).alias(f"null:{c}"))
            out.append(F.lit(1).cast("bigint").alias(f"missing:{c}"))
    d = contract.date_column
    bad = F.count_if(F.col(d).isNull()) if d in df.columns else F.lit(0).cast("bigint")
    out.append(bad.alias("invalid_dates"))
    return out


def long_metrics(wide: DataFrame, contract: DataContract) -> DataFrame:
    """One wide row of metrics -> rows ``metric, column_name, value``; absent required columns included."""
    items = [F.struct(F.lit("total_rows").alias("metric"), F.lit("").alias("column_name"), F.col("total_rows").alias("value"))]
    for c in contract.required_columns:
        if f"null:{c}" in wide.columns:
            items.append(F.struct(F.lit("null_count").alias("metric"), F.lit(c).alias("column_name"), F.col(f"`null:{c}`").alias("value")))
        if f"null:{c}" not in wide.columns or f"missing:{c}" in wide.columns:
            items.append(
                F.struct(F.lit("missing_column").alias("metric"), F.lit(c).alias("column_name"), F.lit(1).cast("bigint").alias("value"))
            )
    items.append(
        F.struct(F.lit("invalid_dates").alias("metric"), F.lit(contract.date_column).alias("column_name"), F.col("invalid_dates").alias("value"))
    )
    return wide.select(F.inline(F.array(*items)))


def validation_metrics(df: DataFrame, contract: DataContract, absent_is_null: bool = False) -> DataFrame:
    """Validation metrics in long form, from a single pass over the table."""
    return long_metrics(df.agg(*metric_columns(df, contract, absent_is_null)), contract)


def violations(metrics: DataFrame, contract: DataContract) -> DataFrame:
    """The metrics that break the contract's limits (strictly above), with a message each."""
    message = (
        F.when(F.col("metric") == "missing_column", F.concat(F.lit("Missing required columns: "), F.col("column_name")))
        .when(
            (F.col("metric") == "null_count") & (F.col("value") > contract.max_null_count),
            F.concat(
                F.lit(f"Null counts exceed limit (max {contract.max_null_count}): "), F.col("column_name"), F.lit("="), F.col("value")
            ),
        )
        .when(
            (F.col("metric") == "invalid_dates") & (F.col("value") > contract.max_invalid_date_count),
            F.concat(F.lit(f"Invalid date count exceeds limit (max {contract.max_invalid_date_count}): "), F.col("value")),
        )
    )
    return metrics.withColumn("message", message).where(F.col("message").isNotNull())


def enforce(metrics: DataFrame, contract: DataContract) -> None:
    """Raise with every violation; the metrics table has one row per required column plus two."""
    found = [r["message"] for r in violations(metrics, contract).orderBy("metric", "column_name").collect()]
    if found:
        raise ValueError("\n".join(found))


def stringify_extras(df: DataFrame, contract: DataContract) -> DataFrame:
    """Columns outside the contract as text: containers as JSON, NaN and null as null, scalars by cast."""
    keep = set(contract.required_columns)
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name in keep:
            out.append(value.cast("string").alias(field.name) if isinstance(field.dataType, T.NullType) else value)
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(value).alias(field.name))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(~F.isnan(value), value).cast("string").alias(field.name))
        else:
            out.append(value.cast("string").alias(field.name))
    return df.select(*out)


def align_columns(parts: list[DataFrame]) -> DataFrame:
    """Tables with different columns as one: absent columns null, columns without a type as text."""
    def typed(df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`") for f in df.schema.fields]
        )

    whole = typed(parts[0])
    for part in parts[1:]:
        whole = whole.unionByName(typed(part), allowMissingColumns=True)
    return whole


def canonical(df: DataFrame, contract: DataContract) -> DataFrame:
    """Mapped names and parsed dates, without any check."""
    return parse_date(apply_mapping(df, contract), contract.date_column, contract.date_format, contract.date_unit)
