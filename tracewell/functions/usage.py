"""Token usage and cost: maps that keep what is set, null when nothing is."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

USAGE = (
    "struct<input:bigint,output:bigint,cacheRead:bigint,cacheWrite:bigint,"
    "totalTokens:bigint,cost:struct<input:double,output:double,total:double>>"
)


def _kept(pairs: list[tuple[str, Column]], type_: str) -> Column:
    entries = F.array_compact(
        F.array(
            *[
                F.when(v.isNotNull(), F.struct(F.lit(k).alias("key"), v.cast(type_).alias("value")))
                for k, v in pairs
            ]
        )
    )
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def _non_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0).cast("bigint"))


def usage_details(usage: Column) -> Column:
    return _kept(
        [
            ("input", _non_zero(usage["input"])),
            ("output", _non_zero(usage["output"])),
            ("input_cached_read", _non_zero(usage["cacheRead"])),
            ("input_cached_write", _non_zero(usage["cacheWrite"])),
            ("total", _non_zero(usage["totalTokens"])),
        ],
        "bigint",
    )


def standard_usage(usage: Column) -> Column:
    """Input, output and total; a missing total is input plus output."""
    given, taken = _non_zero(usage["input"]), _non_zero(usage["output"])
    added = F.when(
        given.isNotNull() | taken.isNotNull(),
        F.coalesce(given, F.lit(0)) + F.coalesce(taken, F.lit(0)),
    )
    total = F.coalesce(_non_zero(usage["totalTokens"]), added)
    return _kept([("input", given), ("output", taken), ("total", total)], "bigint")


def cost_details(cost: Column) -> Column:
    """Costs given as numbers, zeros kept unless all of them are zero."""
    parts = [cost["input"], cost["output"], cost["total"]]
    some = F.greatest(*[F.abs(F.coalesce(p, F.lit(0.0))) for p in parts]) > 0
    return F.when(
        some, _kept([("input", parts[0]), ("output", parts[1]), ("total", parts[2])], "double")
    )


def tokens_in(usage: Column) -> Column:
    return (
        F.coalesce(usage["input"], F.lit(0))
        + F.coalesce(usage["cacheRead"], F.lit(0))
        + F.coalesce(usage["cacheWrite"], F.lit(0))
    )


def tool_success_rate(calls: Column, errors: Column) -> Column:
    return F.when(
        calls > 0, F.greatest(F.lit(0.0), (calls - errors) / calls)
    ).otherwise(F.lit(1.0))
