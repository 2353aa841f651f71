"""What several of the operators share: texts, stage tables, gapless numbers, mapped Arrow batches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable, Iterator, Sequence
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tracewell.plans.workspace import materialize

#: Chunks that one key is cut into when its rows are numbered.
CHUNKS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder."""
    return materialize(df, f"llm-{label}")


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return df.mapInArrow(function, schema)


def by_place(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by their places, so that added ones clash with none, and these names."""
    names = {name: f"c{i}" for i, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def by_name(df: DataFrame, names: dict[str, str], **replaced: Column) -> DataFrame:
    """The columns that ``by_place`` renamed under their own names again, some with other values."""
    return df.select(*[replaced.get(name, F.col(place)).alias(name) for name, place in names.items()])


Held = TypeVar("Held")


def once_per_worker(key: Hashable, make: Callable[[], Held]) -> Held:
    """The object of this key, made at its first use in a worker process; of several keys the last one's is kept.

    A package that travels by value has new globals in every task, so the object is kept beside
    the interpreter's modules.
    """
    held = sys.modules.setdefault("_held_by_worker", types.SimpleNamespace(objects={})).objects
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def id_remainder(column: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; -1 for a null id, which belongs to no fold."""
    return F.coalesce(F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string")) % modulus, F.lit(-1))


def number_from_zero(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str, narrow: DataFrame | None = None) -> DataFrame:
    """A gapless number from 0 within ``keys``, in the order of ``chunk`` and then ``order``.

    A key may hold any share of the rows: each is cut into chunks (at most CHUNKS of them),
    numbered by chunk, and lifted by the rows in the chunks before.  ``narrow`` is the same
    rows where they come cheaper, for the counts.
    """
    rows = df.withColumn("__chunk", chunk)
    counts = (df if narrow is None else narrow).withColumn("__chunk", chunk).groupBy(*keys, "__chunk").count()
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__chunk").alias("__c"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"),
    )
    within = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    ranked = rows.withColumn("__rank", F.row_number().over(within).cast("bigint") - 1)
    same = [ranked[k].eqNullSafe(bases[f"__k{i}"]) for i, k in enumerate(keys)] + [ranked["__chunk"] == bases["__c"]]
    joined = ranked.join(bases, same)
    return joined.withColumn(name, F.col("__base") + F.col("__rank")).select(*[c for c in df.columns if c != name], name)
