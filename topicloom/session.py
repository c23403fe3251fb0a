"""Session settings and durable round tables for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEST_FOLDER: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, name: str = "topicloom", shuffle_partitions: int | None = None):
    """A session with the settings the engine expects; on a cluster ``master`` comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Round tables must be readable from every executor, so a missing setting is an error on a cluster; only a
    local session (tests) falls back to a scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _TEST_FOLDER:
        _TEST_FOLDER[app] = tempfile.mkdtemp(prefix="topicloom-")
    return _TEST_FOLDER[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder, never one that was used before."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage of iterative jobs with data that outlives any executor, runs the plan once, and gives
    the optimizer real sizes for its join choices. With ``tidy`` what the plan has shuffled is deleted once it is
    written, where Spark can do that (4.1); else it stays until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    usual = spark.conf.get(_CLEANUP, None) if tidy else None
    if usual is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if usual is not None:
            spark.conf.set(_CLEANUP, usual)
    table = spark.read.schema(df.schema).parquet(path)
    table._round_path = path
    return table


def merged(side: DataFrame) -> DataFrame:
    """``side`` of a join that is to shuffle both sides.

    In jobs of many rounds every broadcast passes the driver again, and their sum grows with the table.
    """
    return side.hint("merge")


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing is going to be read from it any more."""
    path = getattr(table, "_round_path", None)
    if path is None:
        return
    spark = table.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
