"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int | str = "*", app: str = "dealerlake", **conf: str) -> SparkSession:
    """Single-machine session for tests and the bench. On a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DEALERLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # The virtual machine never compiles a method beyond this size; wide loads would run interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="dealerlake-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` written once as a table in the shared folder, so that later uses read it back.

    This runs ``df``: a query that calls it does part of its work while it is being built.

    For small results that a query uses several times, and for rows whose placement must not change
    between uses. Losing executors loses nothing of it. ``by`` names a column of few values; each task writes a file for each
    of them, in which its rows keep their order, and nothing is sorted for it.
    """
    path = new_folder(df.sparkSession)
    if by is None:
        df.write.parquet(path)
    else:
        with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "16"):
            df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a table that is held by the driver rather than written.
FEW = 2000


def noted(df: DataFrame, *order: str) -> DataFrame:
    """``df`` computed once, for rows about files and tasks rather than data: held by the driver if they are FEW at most, written if there are more."""
    rows = df.orderBy(*order).limit(FEW + 1).collect()
    return df.sparkSession.createDataFrame(rows, df.schema) if len(rows) <= FEW else written(df)


def few(rows: int) -> bool:
    return rows <= FEW


def met(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of so many rows about files and tasks, to be joined to data: with FEW at most every task gets it, so the data is not shuffled for it and
    keeps its order. Left to itself Spark shuffles the data first, as it does not know the size of what the driver holds."""
    return F.broadcast(df) if few(rows) else df


#: The virtual machine never compiles a method beyond this size, and Spark's own limit is higher: wide projections would run interpreted.
COMPILED = ("spark.sql.codegen.hugeMethodLimit", "8000")


def new_folder(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/dealerlake/{spark.sparkContext.applicationId}"


def drop_written(spark: SparkSession) -> None:
    """Removes this application's intermediate tables in the shared folder; those of others stay.

    Only for when no query built on them will run again.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
