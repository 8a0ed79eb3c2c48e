"""Tables in and out of the jobs of this folder."""

from __future__ import annotations

import os
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.session import new_folder, setting

#: Once a write has ended, nothing reads its shuffle files any more.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes and rows of texts that a Python worker gets at once. Spark's defaults suit short rows.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def importable(job):
    """``job(spark, ...)`` whose Python workers find this package where the driver has it, and get texts in small batches.

    A cluster without that path on its machines needs the package in ``--py-files``. The batch settings stay in
    the session, as the result may be computed later.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @wraps(job)
    def run(spark: SparkSession, *args):
        environment = spark.sparkContext.environment
        paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
        for key, value in BATCH.items():
            spark.conf.set(key, value)
        return job(spark, *args)

    return run


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def saved(df: DataFrame, by: str | None = None, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; lineage ends there, so a lost executor costs no more than its tasks.

    ``by`` lays the files out in a folder per value of that column. ``path`` names the folder; it is a new one otherwise.
    """
    spark = df.sparkSession
    path = path or new_folder(spark)
    writer = df.write.partitionBy(by) if by else df.write
    with setting(spark, _CLEANUP, "true"):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's digits modulo ``divisor``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)).cast("int")
