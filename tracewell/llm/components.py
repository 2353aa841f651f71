"""Connected components of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracewell.plans.workspace import drop_stage, stage_path


def _least(edges: DataFrame, of: str, among: str) -> DataFrame:
    return edges.groupBy(of).agg(F.min(among).alias("least"))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest node around it."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = _least(both, "u", "v").select("u", F.least("u", "least").alias("least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("least").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    least = _least(edges, "hi", "lo")
    moved = edges.join(least, "hi").filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.union(least.select("hi", F.col("least").alias("lo"))).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    spark, path = edges.sparkSession, stage_path(edges.sparkSession, "llm-links")
    edges.write.parquet(path)
    table = spark.read.schema("hi bigint, lo bigint").parquet(path)
    return table, path, tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b), named by its smallest node.

    Nodes without links have no row.  Each round is a table; a hub's join is split by skew, and
    its minimum is combined before the shuffle.
    """
    spark = links.sparkSession
    start = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    edges, path, state = _written(start)
    while True:
        after, new_path, new_state = _written(small_star(large_star(edges)))
        drop_stage(spark, path)
        edges, path = after, new_path
        if new_state == state:
            break
        state = new_state
    roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
