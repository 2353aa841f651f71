"""Order-preserving aggregates that combine in two steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .running import ROWS_PER_CHUNK, shuffled


def concat_in_order(
    df: DataFrame, keys: Sequence[str], order: str, values: dict[str, Column]
) -> DataFrame:
    """Concatenate texts per key along ``order``; nulls add nothing.

    Stretches of a key are joined first, so a hot key is read by many tasks and
    only its finished pieces meet in one.
    """
    named = df.select(
        *keys,
        F.col(order).alias("__at"),
        F.floor(F.col(order) / ROWS_PER_CHUNK).alias("__stretch"),
        *[value.alias(name) for name, value in values.items()],
    )

    def joined(name: str, by: str) -> Column:
        return F.expr(f"listagg({name}, '') WITHIN GROUP (ORDER BY {by})").alias(name)

    stretches = named.groupBy(*keys, "__stretch").agg(*[joined(n, "__at") for n in values])
    return stretches.groupBy(*keys).agg(*[joined(n, "__stretch") for n in values])


def merge_maps(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]
) -> DataFrame:
    """Merge map columns per key; of equal map keys the one latest in order wins.

    The merge goes by (key, map key) before the maps are put together, so it
    combines map-side and never holds the history of a key.
    """
    entries = None
    for column in columns:
        part = df.select(
            *keys, order, F.lit(column).alias("__map"),
            F.explode(column).alias("__key", "__value"),
        ).withColumn("__value", F.col("__value").cast("string"))
        entries = part if entries is None else entries.unionByName(part)
    latest = entries.groupBy(*keys, "__map", "__key").agg(
        F.max_by("__value", order).alias("__value")
    )
    types = {f.name: f.dataType for f in df.schema.fields}
    return latest.groupBy(*keys).agg(
        *[
            F.map_from_entries(
                F.array_sort(
                    F.collect_list(
                        F.when(F.col("__map") == column, F.struct("__key", "__value"))
                    )
                )
            ).cast(types[column]).alias(column)
            for column in columns
        ]
    )


def fold_updates(
    updates: DataFrame,
    keys: Sequence[str],
    order: str,
    scalars: Sequence[str],
    maps: Sequence[str],
) -> DataFrame:
    """Fold a stream of partial records per key: the later non-null scalar wins, maps
    merge with the later entry winning."""
    latest = updates.groupBy(*keys).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
            for c in scalars
        ]
    )
    if not maps:
        return latest
    return latest.join(shuffled(merge_maps(updates, keys, order, maps)), list(keys), "left")
