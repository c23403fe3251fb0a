"""Dates from epoch numbers or text, without a session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Units per second, the seconds a nanosecond clock can hold, and the point beyond which an epoch
# column is taken to be in milliseconds.
UNITS_PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}
MAX_EPOCH_SECONDS = 9_223_372_036
MILLISECOND_GUESS = 1_000_000_000_000

# Strftime letters and the datetime pattern letters they stand for.
STRFTIME = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%I": "hh",
    "%M": "mm",
    "%S": "ss",
    "%f": "SSSSSS",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%a": "EEE",
    "%A": "EEEE",
    "%j": "DDD",
    "%z": "xx",
}

DATE_TYPES = (T.TimestampNTZType, T.TimestampType, T.DateType)


def spark_pattern(strftime: str) -> str:
    """``%Y-%m-%d`` -> ``yyyy-MM-dd``; other letters are quoted as literals."""
    out, i = [], 0
    while i < len(strftime):
        code = strftime[i : i + 2]
        if code in STRFTIME:
            out.append(STRFTIME[code])
            i += 2
        else:
            ch = strftime[i]
            out.append(f"'{ch}'" if ch.isalpha() else "''" if ch == "'" else ch)
            i += 1
    return "".join(out)


def from_epoch(value: Column, unit: str = "s") -> Column:
    """Epoch number -> timestamp without zone; out of range or unreadable -> null."""
    number = value.try_cast("decimal(28,6)")
    seconds = (number / F.lit(UNITS_PER_SECOND[unit]).cast("decimal(10,0)")).cast("decimal(28,6)")
    safe = F.when(F.abs(seconds) <= MAX_EPOCH_SECONDS, seconds.cast("decimal(18,6)"))
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return origin + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), safe)


def parse_date(df: DataFrame, column: str, date_format: str | None = None, date_unit: str | None = None):
    """Replace ``column``, if present, by a timestamp; values that cannot be read become null."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType
    value = F.col(column)
    if date_unit:
        parsed = value.cast("timestamp_ntz") if isinstance(kind, DATE_TYPES) else from_epoch(value, date_unit)
    elif isinstance(kind, T.NumericType):
        raise ValueError(f"numeric {column!r} needs date_unit in the contract")
    elif date_format and isinstance(kind, T.StringType):
        parsed = F.try_to_timestamp(value, F.lit(spark_pattern(date_format))).cast("timestamp_ntz")
    else:
        parsed = value.try_cast("timestamp_ntz")
    return df.withColumn(column, parsed)


def coerce_dates(df: DataFrame, column: str) -> DataFrame:
    """Dates as they are, epoch numbers by the size of the column maximum, text as ISO; the rest null."""
    kind = df.schema[column].dataType
    if isinstance(kind, DATE_TYPES):
        return df
    if not isinstance(kind, T.NumericType):
        return df.withColumn(column, F.col(column).try_cast("timestamp_ntz"))
    top = df.agg(F.max(F.when(~F.isnan(F.col(column).cast("double")), F.col(column))).alias("top")).first()["top"]
    unit = "ms" if top is not None and top > MILLISECOND_GUESS else "s"
    return df.withColumn(column, from_epoch(F.col(column), unit))
