"""Exact top-k search of binary codes by incremental multi-index hashing.

A code is cut into segments, and indexed under the value of each.  Two codes within distance
m * (r + 1) - 1 differ by r bits at most in one of m segments, so segments are probed with all
values at distance 0, then 1, and so on, until the k-th verified distance is below what is covered.
The join of a round keeps only pairs that are not farther than the k-th of the rounds before.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stage, table

#: Bits of a segment, near the logarithm of the number of codes.
SEGMENT = 16


def sign_code(vector: str, dims: int) -> Column:
    """The signs of a vector as segments of SEGMENT bits; missing, null and NaN elements count as not positive."""
    def segment(start: int) -> Column:
        bits = [F.when((F.get(vector, F.lit(i)) > 0) & ~F.isnan(F.get(vector, F.lit(i))), 1 << (i - start)).otherwise(0) for i in range(start, min(start + SEGMENT, dims))]
        total = bits[0]
        for b in bits[1:]:
            total = total + b
        return total.cast("int")

    return F.array(*[segment(s) for s in range(0, dims, SEGMENT)])


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "first")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def met_pairs(asked: DataFrame, index: DataFrame, radius: int, segments: int) -> DataFrame:
    """Pairs (query, code, first, distance) whose nearest segments differ by ``radius`` bits.

    ``asked`` has each query with the distance (``most``) beyond which nothing is wanted of it; pairs farther
    apart don't leave the join.  Each pair is met once: in the first of its nearest segments.
    """
    masks = [m for m in range(1 << SEGMENT) if m.bit_count() == radius]
    probes = asked.select("query", "most", F.posexplode("query").alias("segment", "own")).select(
        "query", "most", "segment", F.explode(F.transform(F.lit(np.array(masks, np.int32)), lambda m: m.bitwiseXOR(F.col("own")))).alias("value"))
    weights = [F.bit_count(F.col("query")[i].bitwiseXOR(F.col("code")[i])).cast("int") for i in range(segments)]
    distance = sum(weights[1:], weights[0])
    once = [w >= F.when(F.col("segment") > i, radius + 1).otherwise(radius) for i, w in enumerate(weights)]
    # the probes are many more than the queries they come from, which their estimate doesn't show: never broadcast them
    met = probes.join(index.hint("shuffle_hash"), ["segment", "value"]).filter(reduce(Column.__and__, once, distance <= F.col("most")))
    return met.select("query", "code", "first", distance.alias("distance"))


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int, segments: int) -> DataFrame:
    """For each code of ``queries`` (code) the k nearest of ``codes`` (code, first): query, code, first, distance.

    Both hold each code once.  Ties go to the smaller ``first``.
    """
    codes, remaining = stage(codes, "codes"), stage(queries.select(F.col("code").alias("query"), F.lit(segments * SEGMENT).alias("most")), "queries")
    least = min(k, codes.count())
    index = codes.select("code", "first", F.posexplode("code").alias("segment", "value"))
    done: DataFrame | None = None
    found: DataFrame | None = None
    for radius in range(SEGMENT + 1):
        new = met_pairs(remaining, index, radius, segments)
        found = stage(_best(new if found is None else found.unionByName(new), k), "found")
        covered = segments * (radius + 1) - 1
        state = found.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("last")).filter(F.col("n") >= least)
        closed = state.filter((F.col("last") <= covered) | F.lit(radius == SEGMENT)).select("query")
        finished = found.join(closed, "query", "left_semi")
        done = finished if done is None else done.unionByName(finished)
        remaining = remaining.join(closed, "query", "left_anti").join(state, "query", "left").select("query", F.coalesce("last", "most").alias("most"))
        remaining = stage(remaining, "queries")
        found = found.join(closed, "query", "left_anti")
        if remaining.isEmpty():
            break
    return done


def top_k(rows: DataFrame, key: str, vector: str, k: int, is_query: Column, dims: int | None = None) -> DataFrame:
    """query_id, rank (from 1), neighbor_id and distance: the k rows nearest to each row that ``is_query`` chooses.

    Distances are Hamming distances of sign codes, ties go to the smaller id, a row isn't its own
    neighbour.  Rows without an id or a vector are neither asked nor found; of rows that repeat an
    id each asks, and the id is left out for all of them.  Rows of equal codes are one entry of the
    index, with their k + 1 smallest ids, so a code that holds a third of the rows is one row.
    """
    if dims is None:
        dims = rows.select(F.max(F.size(vector))).first()[0] or 0
    segments = -(-dims // SEGMENT)
    if segments < 1:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, neighbor_id bigint, distance int")
    known = rows.filter(F.col(key).isNotNull() & F.col(vector).isNotNull())
    coded = stage(known.select(F.col(key).cast("bigint").alias("id"), sign_code(vector, dims).alias("code"), F.coalesce(is_query, F.lit(False)).alias("asks")), "coded")
    each = coded.groupBy("code", "id").agg(F.max("asks").alias("asks"))
    smallest = Window.partitionBy("code").orderBy("id")
    members = each.select("code", "id").withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1).groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    members = stage(members, "members")
    near = nearest_codes(members.select("code", F.col("ids")[0].alias("first")), coded.filter("asks").select("code").distinct(), k + 1, segments)
    lists = near.join(members, "code").select("query", F.explode("ids").alias("id"), "distance")
    lists = lists.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "id"))), 1, (k + 1) * (k + 1)).alias("near"))
    asked = coded.filter("asks").select(F.col("id").alias("query_id"), F.col("code").alias("query"))
    own = asked.join(lists, "query").select("query_id", F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("neighbor_id"), F.col("x.distance").cast("int").alias("distance"))


def query(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, "vec_id", "embedding", 10, F.col("vec_id") % 20 == 0)


SQL = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0 AND NOT isnan(x), false)) AS b FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), p AS (
  SELECT q.vec_id AS query_id, n.vec_id AS neighbor_id, len(list_filter(list_zip(q.b, n.b), lambda z: z[1] <> z[2]))::INT AS distance
  FROM c q JOIN c n ON q.vec_id <> n.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank, neighbor_id, distance FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) <= 10
"""
