"""Row numbers over a whole table without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealerlake.session import written


def row_numbers(df: DataFrame, key: str, metrics: dict[str, str]) -> DataFrame:
    """``df`` plus, per metric, the place of the row by (metric, key) as ``<name>_PLACE``, and ``n``.

    ``key`` is unique, nulls allowed. The rows of all metrics are cut into ranges of
    (metric, value, key) in one shuffle, so that equal values spread over ranges too. Cut points are
    sampled and may differ from one run of the shuffle to the next, so the ranges are written to the
    shared folder before anything is counted on them. A place is then the row number inside the
    range plus the sizes of the ranges before it, of which there are at most one per shuffle
    partition and metric.
    """
    names = list(metrics)
    first = names[0]
    entries = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(c).cast("decimal(38,4)").alias("value")) for n, c in metrics.items()]
    )
    # The other columns of the row ride along with its first metric only.
    payload = [c for c in df.columns if c != key]
    long = df.select(F.col(key).alias("key"), *payload, F.explode(entries).alias("e")).select(
        "key", "e.metric", "e.value", *[F.when(F.col("e.metric") == first, F.col(c)).alias(c) for c in payload]
    )
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = written(
        long.repartitionByRange(partitions, "metric", "value", "key").withColumn("range", F.spark_partition_id())
    )
    sizes = ranges.groupBy("metric", "range").agg(F.count("*").alias("size"))
    ahead = Window.partitionBy("metric").orderBy("range")
    starts = sizes.select(
        "metric",
        "range",
        (F.sum("size").over(ahead) - F.col("size")).alias("start"),
        F.sum("size").over(Window.partitionBy("metric")).alias("n"),
    )
    inside = Window.partitionBy("metric", "range").orderBy("value", "key")
    return (
        ranges.withColumn("inside", F.row_number().over(inside))
        .join(starts, ["metric", "range"])
        .groupBy(F.col("key").alias(key))
        .agg(
            *[F.max(c).alias(c) for c in payload],
            F.max("n").alias("n"),
            *[F.max(F.when(F.col("metric") == m, F.col("start") + F.col("inside"))).alias(f"{m}_PLACE") for m in names],
        )
    )
