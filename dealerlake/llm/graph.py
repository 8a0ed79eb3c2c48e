"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealerlake.llm.store import saved


def _stars(links: DataFrame, keep_smaller: bool) -> DataFrame:
    """Every node's neighbours tied to the smallest of them and the node.

    ``keep_smaller`` looks at the neighbours below the node and the node itself (small star), else
    only the neighbours above are tied (large star). Both keep what is connected.
    """
    if keep_smaller:
        near = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        tied = near.join(least, "u")
        return (
            tied.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
    near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row (node, component) per node of ``links``; component is the smallest node it reaches.

    Alternates large and small stars until the table stays the same, which takes a number of rounds
    that grows with the logarithm of the nodes. A node's neighbours are never gathered: both steps
    are a minimum per node and a join. Every round is written to the shared folder. Rows with a null
    end or equal ends are no links. An empty table gives an empty one.
    """
    links = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    before = None
    while True:
        links = saved(_stars(_stars(links, False), True))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
