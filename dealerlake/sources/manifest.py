"""The log of loads of a table in a folder: what a load wrote counts once its entry has been published, by one rename.

Under ``root`` a load's rows lie in ``<table>/LOAD=<id>``, the files it read, if they are many, in ``_loads/<table>/files/LOAD=<id>``, its unique keys in
``_keys/<table>/BUCKET=<n>/LOAD=<id>``, the sums of its rows per day and branch in ``_sums/<table>/LOAD=<id>``. Its entry is ``_loads/<table>/<version>.json``, versions counting up from 0. Readers go by the
entries, so folders of a load that died are never read. A version is published once: the second of two loads that started from the same version
fails, and leaves nothing behind that counts.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOAD, BUCKET = "LOAD", "BUCKET"
_ENTRY = "version long, load string, next_id long, rows long, buckets array<int>, sums boolean, files array<struct<path: string, bytes: long, modified: long>>"


@dataclass(frozen=True)
class Log:
    """The published loads of a table, oldest first: (version, load, next_id, rows, buckets with keys, whether it has sums). One entry per load."""

    root: str
    table: str
    entries: tuple

    @classmethod
    def of(cls, spark: SparkSession, root: str, table: str) -> Log | None:
        """None when the table has no log."""
        root = root.rstrip("/")
        folder = f"{root}/_loads/{table}"
        if not any(n.endswith(".json") for n in names(spark, folder)):
            return None
        found = spark.read.schema(_ENTRY).json(f"{folder}/*.json").orderBy("version").collect()
        return cls(root, table, tuple(found))

    @property
    def version(self) -> int:
        return self.entries[-1]["version"] if self.entries else -1

    @property
    def next_id(self) -> int:
        return max((e["next_id"] for e in self.entries), default=0)

    def rows(self, spark: SparkSession, schema, summed: bool | None = None) -> DataFrame:
        """The table's rows, with the load and other folder columns behind those of ``schema``; of all loads, or of those with or without sums."""
        paths = [f"{self.root}/{self.table}/{LOAD}={e['load']}" for e in self.entries if e["rows"] and summed in (None, bool(e["sums"]))]
        return _read(spark, schema, f"{self.root}/{self.table}", paths)

    def sums(self, spark: SparkSession, schema) -> DataFrame:
        """Sums per load, day and branch, of the loads that have them."""
        base = f"{self.root}/_sums/{self.table}"
        return _read(spark, schema, base, [f"{base}/{LOAD}={e['load']}" for e in self.entries if e["rows"] and e["sums"]])

    def files(self, spark: SparkSession) -> DataFrame:
        """The files that have been loaded: path, bytes, modified."""
        base = f"{self.root}/_loads/{self.table}/files"
        many = _read(spark, FILES, base, [f"{base}/{LOAD}={e['load']}" for e in self.entries if e["files"] is None])
        noted = spark.createDataFrame([tuple(f) for e in self.entries for f in e["files"] or ()], "path string, bytes long, micros long")
        return many.select("path", "bytes", "modified").union(noted.select("path", "bytes", F.timestamp_micros("micros")))

    def keys(self, spark: SparkSession, key: str, buckets: set[int]) -> DataFrame:
        """Stored values of a unique column whose hash falls into some of the buckets; the files of others are not opened."""
        base = f"{self.root}/_keys/{self.table}"
        paths = [f"{base}/{BUCKET}={b}/{LOAD}={e['load']}" for e in self.entries for b in e["buckets"] or () if b in buckets]
        return _read(spark, f"{key} string", base, paths).select(key)


#: What is kept of each file that was loaded.
FILES = "path string, bytes long, modified timestamp"


def _read(spark: SparkSession, schema, base: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def new_load() -> str:
    return uuid.uuid4().hex


def publish(spark: SparkSession, root: str, table: str, load: str, version: int, next_id: int, rows: int, buckets: list[int], sums: bool, files: list | None) -> None:
    """Makes a load count, as the given version; ``files`` (path, bytes, modified in microseconds) are None if they were written. Raises FileExistsError if another load has become that version."""
    entry = {"version": version, "load": load, "next_id": next_id, "rows": rows, "buckets": buckets, "sums": sums, "files": files}
    folder = f"{root.rstrip('/')}/_loads/{table}"
    jvm = spark._jvm
    final, draft = (_path(spark, f"{folder}/{name}") for name in (f"{version:012d}.json", f".{load}.draft"))
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    kinds = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(final), kinds)
    except Exception as error:
        if files.exists(final):
            files.delete(draft, False)
            raise FileExistsError(f"another load of {table} was published as version {version}; run this one again") from error
        raise


def bucket_of(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none when there is none."""
    path = _path(spark, folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
