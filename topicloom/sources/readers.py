"""Scans of posts, stage tables and label files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffixes understood and the texts that mean "no value" in CSV files.
CSV_SUFFIXES = (".csv",)
PARQUET_SUFFIXES = (".parquet", ".pq")
JSON_SUFFIXES = (".jsonl", ".json")
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
LINEAGE = "source_file"


def suffix_of(path: str) -> str:
    """The lower-case suffix of the last path element."""
    name = str(path).rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[1].lower() if "." in name else ""


def read_tabular(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """A CSV, Parquet or JSON Lines table by the suffix of its path; anything else is an error."""
    suffix = suffix_of(path)
    if suffix in CSV_SUFFIXES:
        return read_csv(spark, path, schema, multi_line)
    if suffix in PARQUET_SUFFIXES:
        return spark.read.parquet(str(path))
    if suffix in JSON_SUFFIXES:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.json(str(path))
    raise ValueError(f"Unsupported file type: {suffix}. Supported: .csv, .parquet, .jsonl")


def _csv(spark: SparkSession, multi_line: bool):
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """A CSV table with a header; the usual spellings of a missing value become null if they are the whole text.

    A file whose quoted fields may span lines is read by one task. With ``multi_line=False`` (the choice for large plain
    files) it is split among many.

    With ``schema`` (the choice for large inputs) the file is read once; without it a column takes the narrowest of
    long, double, boolean and string that fits all of its values, which costs one extra pass.
    """
    text = _csv(spark, multi_line).csv(str(path))
    blank = [F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in text.columns]
    cleaned = text.select(*blank)
    if schema is not None:
        fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        kinds = {f.name: f.dataType for f in fields}
        return cleaned.select(*[F.col(f"`{c}`").try_cast(kinds.get(c, T.StringType())).alias(c) for c in cleaned.columns])
    return _narrow(cleaned)


def _narrow(text: DataFrame) -> DataFrame:
    kinds = ["bigint", "double", "boolean"]
    fits = [
        F.coalesce(F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(k).isNotNull()), F.lit(True)).alias(f"{i}_{k}")
        for i, c in enumerate(text.columns)
        for k in kinds
    ]
    some = [F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(text.columns)]
    seen = text.agg(*fits, *some).first()
    chosen = []
    for i, c in enumerate(text.columns):
        kind = next((k for k in kinds if seen[f"{i}_{k}"]), "string") if seen[f"{i}_n"] else "string"
        chosen.append(F.col(f"`{c}`").try_cast(kind).alias(c))
    return text.select(*chosen)


def read_labels(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A label, keyword or hierarchy CSV; quoted fields may span lines."""
    return read_csv(spark, path, schema, multi_line=True)


def read_raw_folder(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All ``*.jsonl`` files of a folder, else all ``*.json`` files, with the file each row came from.

    The files are read in place; nothing is concatenated, and an empty folder is an error.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    for pattern in ("*.jsonl", "*.json"):
        present = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(str(folder)).select("path")
        if not present.isEmpty():
            rows = reader.option("pathGlobFilter", pattern).json(str(folder))
            return rows.select("*", F.col("_metadata.file_name").alias(LINEAGE))
    raise FileNotFoundError(f"no .jsonl or .json files in {folder}")


def read_jsonl_stream(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_trigger: int | None = None):
    """JSON Lines files as a stream of micro-batches of bounded size."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(str(folder))


def project_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that the table has."""
    return df.select(*[c for c in wanted if c in df.columns])
