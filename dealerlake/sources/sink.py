"""Append sink of the bronze tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.schemas import MONTH_PARTITION, TABLES
from dealerlake.session import FEW, setting
from dealerlake.sources.bronze import LINES, day_sums
from dealerlake.sources.manifest import BUCKET, FILES, LOAD, Log, bucket_of, names, new_load, publish


@dataclass(frozen=True)
class Target:
    """Where bronze rows go: a folder of parquet tables, a catalog database, or a database over JDBC."""

    path: str | None = None
    database: str | None = None
    jdbc: dict[str, str] = field(default_factory=dict)


#: Connections a database sink opens at most, unless its options say otherwise.
JDBC_CONNECTIONS = "8"


#: Tables whose loads bring sums per day and branch, by their line of business.
SUMMED = {line.table: line for line in LINES.values()}
#: Hash buckets of a table's unique column. A load reads only the buckets that its keys fall into.
KEY_BUCKETS = 256
#: Lets a reader skip row groups without the values it looks for.
_BLOOM = {"parquet.bloom.filter.enabled#{}": "true", "parquet.bloom.filter.expected.ndv#{}": "200000", "parquet.bloom.filter.max.bytes": "262144"}


def _laid_out(rows: DataFrame, table: str) -> DataFrame:
    """Rows in the order of the table's files.

    Dated tables are laid out by month, with rows sorted by branch and day inside each file so that
    a branch or day filter skips row groups. Rebalancing by month keeps a file per month from
    becoming a file per task, and splits a month that holds most of the rows.
    """
    spec = TABLES[table]
    order = ["COD_CONCESSIONARIA", "COD_FILIAL"]
    if spec.date:
        rows = rows.withColumn(MONTH_PARTITION, F.year(spec.date) * 100 + F.month(spec.date)).hint("rebalance", MONTH_PARTITION)
        order = [MONTH_PARTITION, *order, spec.date]
    return rows.sortWithinPartitions(*order)


#: Bytes of the staged rows that a task reads at most, as it may sort what it reads: they are packed some thirty times closer than in memory.
_SORTED_BYTES = 16 << 20


def _sorted_bytes(spark: SparkSession) -> str:
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return str(min(size, _SORTED_BYTES))


def append_bronze(
    df: DataFrame, table: str, target: Target, *, count: int | None = None, files: DataFrame | None = None, next_id: int | None = None, log: Log | None = None
) -> None:
    """Appends rows to a table; see ``_laid_out``.

    In a folder the rows, their sums per day and branch, the files they came from and the table's unique keys count at once, when the load's entry is published, and not at all if
    it dies before; see ``manifest``. ``log`` is the log that the load started from, ``count`` the number of rows, ``next_id`` the
    first key that is left unused.

    In a catalog the record of loads is written last. A database makes its
    own row keys, and takes a bounded number of connections; there a task that runs again inserts its rows again, unless
    the table has a unique key.
    """
    spec, spark = TABLES[table], df.sparkSession
    rows = df.select(*spec.schema.fieldNames())
    if target.jdbc:
        rows.drop(spec.id).write.format("jdbc").options(**jdbc_options(table, target)).mode("append").save()
        return
    count = rows.count() if count is None else count
    if target.database is not None:
        if count:
            _laid_out(rows, table).write.mode("append").format("parquet").insertInto(f"{target.database}.{table}")
        if files is not None:
            record = files.select("path", "bytes", "modified", F.lit(next_id or 0).cast("long").alias("next_id"))
            record.write.mode("append").saveAsTable(f"{target.database}.{table}_LOADS")
        return
    root, load = target.path.rstrip("/"), new_load()
    log = log or Log.of(spark, root, table)
    if log is None and any(not n.startswith((".", "_", f"{LOAD}=")) for n in names(spark, f"{root}/{table}")):
        raise ValueError(f"{root}/{table} holds rows that no load wrote")
    buckets: list[int] = []
    if count:
        with setting(spark, "spark.sql.files.maxPartitionBytes", _sorted_bytes(spark)):
            writer = _laid_out(rows, table).write
            (writer.partitionBy(MONTH_PARTITION) if spec.date else writer).parquet(f"{root}/{table}/{LOAD}={load}")
        if spec.unique is not None:
            buckets = _write_keys(spark, root, table, load)
        if table in SUMMED:
            written = spark.read.schema(spec.schema).parquet(f"{root}/{table}/{LOAD}={load}")
            day_sums(written, SUMMED[table]).sortWithinPartitions("DT").write.parquet(f"{root}/_sums/{table}/{LOAD}={load}")
    log = log or Log(root, table, ())
    read = (spark.createDataFrame([], FILES) if files is None else files).select("path", "bytes", F.unix_micros("modified").alias("modified"))
    few = [r.asDict() for r in read.orderBy("path").limit(FEW + 1).collect()]
    if len(few) > FEW:
        few = None
        files.select("path", "bytes", "modified").write.parquet(f"{root}/_loads/{table}/files/{LOAD}={load}")
    publish(spark, root, table, load, log.version + 1, log.next_id if next_id is None else next_id, count, buckets, table in SUMMED, few)


def _write_keys(spark: SparkSession, root: str, table: str, load: str) -> list[int]:
    """Adds the unique keys of a load's rows to the index, and returns the buckets they are in."""
    key = TABLES[table].unique
    keys = spark.read.schema(TABLES[table].schema).parquet(f"{root}/{table}/{LOAD}={load}").select(key).where(F.col(key).isNotNull())
    keys = keys.withColumn(BUCKET, bucket_of(key, KEY_BUCKETS))
    used = sorted(r[0] for r in keys.select(BUCKET).distinct().collect())
    laid = keys.withColumn(LOAD, F.lit(load)).repartition(BUCKET).sortWithinPartitions(BUCKET, key)
    options = {name.format(key): value for name, value in _BLOOM.items()}
    laid.write.options(**options).mode("append").partitionBy(BUCKET, LOAD).parquet(f"{root}/_keys/{table}")
    return used


def jdbc_options(table: str, target: Target) -> dict[str, str]:
    return {"dbtable": table, "batchsize": "1000", "numPartitions": JDBC_CONNECTIONS} | target.jdbc


def log_of(spark: SparkSession, table: str, target: Target) -> Log | None:
    """The log of a table in a folder; None for catalogs and databases, and before the first load."""
    return Log.of(spark, target.path, table) if target.path is not None else None


def loaded_files(spark: SparkSession, table: str, target: Target, log: Log | None) -> DataFrame | None:
    """The files loaded before: path, bytes, modified. None for databases and before the first load."""
    if log is not None:
        return log.files(spark)
    name = f"{target.database}.{table}_LOADS"
    return spark.table(name) if target.database is not None and spark.catalog.tableExists(name) else None


def next_id(spark: SparkSession, table: str, target: Target, log: Log | None) -> int:
    """First unused row key of a table, from the record of loads; the table itself is read only if it has rows but no record."""
    if target.jdbc:
        return 0
    if log is not None:
        return log.next_id
    known = loaded_files(spark, table, target, log)
    if known is not None:
        return known.agg(F.coalesce(F.max("next_id"), F.lit(0))).first()[0]
    rows = stored(spark, table, target)
    return 0 if rows is None else rows.agg(F.coalesce(F.max(TABLES[table].id) + 1, F.lit(0))).first()[0]


def stored(spark: SparkSession, table: str, target: Target) -> DataFrame | None:
    """The table as it stands, None when its folder does not exist yet, or for a database."""
    if target.jdbc:
        return None
    if target.database is not None:
        return spark.table(f"{target.database}.{table}")
    log = log_of(spark, table, target)
    if log is not None:
        return log.rows(spark, TABLES[table].schema)
    folder = f"{target.path.rstrip('/')}/{table}"
    return spark.read.schema(TABLES[table].schema).parquet(folder) if names(spark, folder) else None


def stored_keys(keys: DataFrame, table: str, target: Target, log: Log | None) -> DataFrame | None:
    """Stored values of the table's unique column among which all of ``keys`` that are stored can be found.

    In a folder these are the index's buckets that the keys fall into; only the numbers of buckets come to the driver. Elsewhere they are the column.
    """
    spark, key = keys.sparkSession, TABLES[table].unique
    if log is not None:
        hit = {r[0] for r in keys.select(bucket_of(F.col(key), KEY_BUCKETS)).distinct().collect()}
        return log.keys(spark, key, hit)
    rows = stored(spark, table, target)
    return None if rows is None else rows.select(key).where(F.col(key).isNotNull())
