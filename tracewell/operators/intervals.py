"""Which interval, of those covering a point, began last?

An interval join emits one row per covering pair, which is quadratic where long
intervals overlap.  Here every interval is cut into aligned blocks (a 16-ary
segment tree), each block keeps only its latest interval, and a point looks up
the one block per level it lies in: an equi-join against unique keys, exact for
any nesting, with a bounded number of rows per point and per interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .running import shuffled

FANOUT = 16
LEVELS = 9
OPEN_END = FANOUT**LEVELS
# Upper blocks cover many points of one key: spread those over salts.
SALTED_FROM = 3
SALTS = 16


def _blocks(start: Column, stop: Column, count: int) -> Column:
    """Array of (level, block): the coarsest aligned blocks of ``count`` levels inside [start, stop)."""
    low_end = start.cast("bigint")
    high_end = F.least(stop.cast("bigint"), F.lit(FANOUT**count))
    none = F.array().cast("array<bigint>")

    def at_level(level: Column) -> Column:
        size = F.pow(F.lit(float(FANOUT)), level).cast("bigint")
        bounds = F.struct(
            F.ceil(low_end / size).alias("low"),
            F.floor(high_end / size).alias("high"),
            (F.ceil(low_end / (size * FANOUT)) * FANOUT).alias("up_low"),
            (F.floor(high_end / (size * FANOUT)) * FANOUT).alias("up_high"),
        )

        def pieces(b: Column) -> Column:
            nested = (b["up_low"] < b["up_high"]) & (level < count - 1)
            left_end = F.when(nested, b["up_low"]).otherwise(b["high"])
            left = F.when(b["low"] < left_end, F.sequence(b["low"], left_end - 1)).otherwise(none)
            right = F.when(
                nested & (b["up_high"] < b["high"]), F.sequence(b["up_high"], b["high"] - 1)
            ).otherwise(none)
            return F.transform(
                F.concat(left, right),
                lambda block: F.struct(level.alias("level"), block.alias("block")),
            )

        return F.transform(F.array(bounds), pieces)[0]

    levels = F.array(*[F.lit(level) for level in range(count)])
    return F.flatten(F.transform(levels, at_level))


def latest_covering(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    stop: str,
    payload: Sequence[str],
    last: int | None = None,
) -> DataFrame:
    """``points`` plus the ``payload`` of the interval [start, stop) over ``at`` with the
    greatest start, null if none; a null stop is open.  (keys, at) must be unique, and below
    OPEN_END; a point beyond raises.  Where no point is beyond ``last``, the tree ends there:
    fewer levels to look up, and fewer blocks of open intervals."""
    count = next(n for n in range(1, LEVELS + 1) if n == LEVELS or (last is not None and last < FANOUT**n))
    end = FANOUT**count
    salts = F.when(
        F.col("level") >= SALTED_FROM, F.sequence(F.lit(0), F.lit(SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    tree = (
        intervals.select(
            *keys,
            F.struct(F.col(start).cast("bigint").alias("start"), *payload).alias("hit"),
            F.explode(
                _blocks(F.col(start), F.coalesce(F.col(stop), F.lit(end)), count)
            ).alias("b"),
        )
        .select(*keys, "hit", "b.level", "b.block")
        .groupBy(*keys, "level", "block")
        .agg(F.max_by("hit", "hit.start").alias("hit"))
        .withColumn("salt", F.explode(salts))
    )
    beyond = F.raise_error(F.concat(F.lit(f"{at} is beyond {end}: "), F.col(at).cast("string")))
    point_key = points.select(*keys, F.when(F.col(at) >= end, beyond.cast("bigint")).otherwise(F.col(at)).alias(at))
    probes = point_key.withColumn(
        "level", F.explode(F.array(*[F.lit(level) for level in range(count)]))
    ).select(
        *keys,
        at,
        "level",
        F.floor(F.col(at) / F.pow(F.lit(FANOUT), F.col("level"))).cast("bigint").alias("block"),
        F.when(F.col("level") >= SALTED_FROM, F.pmod(F.hash(at), F.lit(SALTS)))
        .otherwise(0)
        .alias("salt"),
    )
    hits = (
        probes.join(shuffled(tree), [*keys, "level", "block", "salt"])
        .groupBy(*keys, at)
        .agg(F.max_by("hit", "hit.start").alias("__hit"))
    )
    return points.join(shuffled(hits), [*keys, at], "left").select(
        *points.columns, *[F.col(f"__hit.{p}").alias(p) for p in payload]
    )
