"""Writers of stage tables, small exports and label tables that grow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LABEL_KEYS = ("topic", "sample_size", "backend")


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A stage table as Parquet."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, order: Sequence[str] = (), files: int | None = None) -> None:
    """A table as CSV with a header, in as many files as it has partitions.

    ``files`` deals the finished rows anew (1: the one file of a small report), so that what computes them keeps all of
    its tasks; ``order`` sorts the rows of each file.
    """
    table = df if files is None else df.repartition(files)
    table = table.sortWithinPartitions(*order) if order else table
    writer = table.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """A table as JSON Lines."""
    df.write.mode("overwrite").json(path)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def unseen(new: DataFrame, existing: DataFrame, keys: Sequence[str] = LABEL_KEYS) -> DataFrame:
    """Rows of ``new`` whose keys the stored table does not hold."""
    return new.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def append_new(new: DataFrame, path: str, keys: Sequence[str] = LABEL_KEYS, resume: bool = True) -> None:
    """Append rows whose keys are not stored yet; without ``resume`` replace the table."""
    existing = read_if_present(new.sparkSession, path) if resume else None
    if existing is None:
        new.write.mode("overwrite").parquet(path)
    else:
        unseen(new, existing, keys).write.mode("append").parquet(path)


def save_centroids(centroids: DataFrame, path: str) -> None:
    """A fitted clustering as its centroid table."""
    centroids.write.mode("overwrite").parquet(path)


def load_centroids(spark: SparkSession, path: str) -> DataFrame:
    """A stored clustering, ready to assign new posts."""
    return spark.read.parquet(path).select(F.col("topic"), F.col("centroid"), F.col("size"))
