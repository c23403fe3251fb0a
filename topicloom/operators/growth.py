"""Recent-versus-prior growth and monthly series per topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicloom.functions.dates import coerce_dates

# The windows and the row limit of the growth report.
REPORT_WINDOWS = (90, 180, 360)
REPORT_LIMIT = 200


def summary(df: DataFrame) -> DataFrame:
    """Rows, first and last date, and total value; a column the table lacks gives null, no values sum to 0."""
    has = set(df.columns)
    dates = [F.min("date").alias("min_date"), F.max("date").alias("max_date")] if "date" in has else [
        F.lit(None).cast("timestamp_ntz").alias("min_date"),
        F.lit(None).cast("timestamp_ntz").alias("max_date"),
    ]
    total = F.coalesce(F.sum("value"), F.lit(0)) if "value" in has else F.lit(None).cast("double")
    return df.agg(F.count(F.lit(1)).alias("rows"), *dates, total.alias("total_value"))


def growth_counts(df: DataFrame, windows: Sequence[int], topic: str = "topic", date: str = "date") -> DataFrame:
    """``window_days``, topic, recent and prior counts, absolute and relative change, for every window.

    The last date is read first and enters the second pass as a constant, so that the scan skips everything older
    than the longest window. Counts of all windows are taken side by side and combined on the map side; a topic with
    most of the posts costs no more than another.
    """
    valid = df.where(F.col(date).isNotNull())
    last = _constant(valid.agg(F.max(date).alias("last")), "last", df.schema[date].dataType)
    back = lambda days: last - F.make_interval(days=F.lit(int(days)))
    when = F.col(date)
    counts = []
    for w in windows:
        counts.append(F.count_if(when >= back(w)).alias(f"recent_{w}"))
        counts.append(F.count_if((when >= back(2 * w)) & (when < back(w))).alias(f"prior_{w}"))
    recent = valid.where(F.col(topic).isNotNull() & (when >= back(2 * max(windows))))
    wide = recent.groupBy(topic).agg(*counts)
    rows = [
        F.struct(F.lit(int(w)).alias("window_days"), F.col(f"recent_{w}").alias("recent_count"), F.col(f"prior_{w}").alias("prior_count"))
        for w in dict.fromkeys(windows)
    ]
    counted = wide.select(topic, F.inline(F.array(*rows))).where(F.col("recent_count") + F.col("prior_count") > 0)
    change = F.col("recent_count") - F.col("prior_count")
    share = F.when(F.col("prior_count") > 0, change / F.col("prior_count"))
    return counted.select("window_days", topic, "recent_count", "prior_count").withColumn("growth_abs", change).withColumn("growth_pct", share)


def _constant(one_row: DataFrame, column: str, kind: T.DataType) -> Column:
    """The single value of a one-row aggregate as a literal of its type."""
    value = one_row.select(F.col(column).cast("string")).first()[0]
    return F.lit(value).cast(kind)


def topic_growth(df: DataFrame, window_days: int, topic: str = "topic", date: str = "date") -> DataFrame:
    """Growth for one window."""
    return growth_counts(df, [window_days], topic, date).drop("window_days")


def growth_by_outer_join(df: DataFrame, window_days: int) -> DataFrame:
    """The same counts as two tables met by a full outer join, absent counts as 0."""
    spanned = df.where(F.col("date").isNotNull() & F.col("topic").isNotNull())
    last = _constant(df.agg(F.max("date").alias("last")), "last", df.schema["date"].dataType)
    recent_from = last - F.make_interval(days=F.lit(window_days))
    prior_from = last - F.make_interval(days=F.lit(2 * window_days))
    recent = spanned.where(F.col("date") >= recent_from).groupBy("topic").agg(F.count(F.lit(1)).alias("recent_count"))
    prior = (
        spanned.where((F.col("date") >= prior_from) & (F.col("date") < recent_from))
        .groupBy("topic")
        .agg(F.count(F.lit(1)).alias("prior_count"))
    )
    return recent.join(prior, "topic", "full_outer").na.fill(0, ["recent_count", "prior_count"])


def ranked_growth(growth: DataFrame, limit: int = REPORT_LIMIT, topic: str = "topic") -> DataFrame:
    """The topics that grew most, per window, with their rank. The input has one row per topic and window."""
    order = Window.partitionBy("window_days").orderBy(F.desc("growth_abs"), F.asc(topic))
    return growth.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def monthly_series(posts: DataFrame, date: str = "date") -> DataFrame:
    """Posts per topic, parent topic and month; rows without any of the three are left out."""
    rows = posts.where(F.col("topic").isNotNull() & F.col("parent_topic").isNotNull() & F.col(date).isNotNull())
    month = F.date_trunc("month", F.col(date)).cast("timestamp_ntz").alias("month")
    return rows.groupBy("topic", "parent_topic", month).agg(F.count(F.lit(1)).alias("post_count"))


def dated_topics(clusters: DataFrame, posts: DataFrame) -> DataFrame:
    """Clustered posts with their dates: the whole date column is read first, then noise and undated rows go."""
    joined = coerce_dates(clusters.join(posts, "post_id"), "date")
    return joined.where(F.col("date").isNotNull() & (F.col("topic") != -1))


def value_series(df: DataFrame) -> DataFrame:
    """Dated values in date order."""
    return df.where(F.col("date").isNotNull() & F.col("value").isNotNull()).orderBy("date")
