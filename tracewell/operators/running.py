"""Running (prefix) computations that survive a hot key.

A plain window over a session sorts the whole session in one task.  Here each
session is cut into chunks along its order: chunk totals are combined map-side,
a window over the (few) chunks of a session gives what each chunk starts with,
and the rows of a chunk continue from there.  The rows are shuffled once, by
(key, chunk), so one session holding a third of all rows spreads over as many
tasks as it has chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

ROWS_PER_CHUNK = 1 << 16
_CHUNK = "__chunk"


@dataclass(frozen=True)
class Running:
    """``kind`` is sum, max or last (last non-null); exclusive leaves the row itself out."""

    kind: str
    value: Column
    exclusive: bool = False


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data, so never one to broadcast.

    Stage tables are some ten times smaller as files than in memory, and Spark goes by the files.
    """
    return df.hint("merge")


def chunk_of(order: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> Column:
    """Chunk of a dense per-key sequence number."""
    return F.floor(F.col(order) / F.lit(rows_per_chunk)).cast("bigint")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, Running],
    chunk: Column | None = None,
) -> DataFrame:
    """Add running columns along ``order`` within ``keys``.

    ``chunk`` must not decrease along ``order``; by default it is cut from the
    first order column, which then is a dense sequence number.
    """
    inputs = {f"__in_{name}": spec.value for name, spec in outputs.items()}
    rows = df.withColumns(
        {_CHUNK: chunk_of(order[0]) if chunk is None else chunk, **inputs}
    )
    position = F.struct(*order)

    def total(name: str, spec: Running) -> Column:
        value = F.col(f"__in_{name}")
        if spec.kind == "sum":
            return F.sum(value)
        if spec.kind == "max":
            return F.max(value)
        return F.max_by(value, F.when(value.isNotNull(), position))

    by_chunk = rows.groupBy(*keys, _CHUNK).agg(
        *[total(name, spec).alias(f"__sum_{name}") for name, spec in outputs.items()]
    )
    before_chunk = (
        Window.partitionBy(*keys)
        .orderBy(_CHUNK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    def fold(kind: str, value: Column, window) -> Column:
        if kind == "sum":
            return F.sum(value).over(window)
        if kind == "max":
            return F.max(value).over(window)
        return F.last(value, ignorenulls=True).over(window)

    carry = by_chunk.select(
        *keys,
        _CHUNK,
        *[
            fold(spec.kind, F.col(f"__sum_{name}"), before_chunk).alias(f"__carry_{name}")
            for name, spec in outputs.items()
        ],
    )
    in_chunk = Window.partitionBy(*keys, _CHUNK).orderBy(*order)

    def combine(name: str, spec: Running) -> Column:
        frame = in_chunk.rowsBetween(Window.unboundedPreceding, -1 if spec.exclusive else 0)
        here = fold(spec.kind, F.col(f"__in_{name}"), frame)
        carried = F.col(f"__carry_{name}")
        if spec.kind == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(here, F.lit(0))
        if spec.kind == "max":
            return F.greatest(carried, here)
        return F.coalesce(here, carried)

    # hashed: a sort for the join would hold the rows a second time beside the sort of the window
    joined = rows.join(carry.hint("shuffle_hash"), [*keys, _CHUNK], "left")
    return joined.select(
        *[F.col(c) for c in df.columns if c not in outputs],
        *[combine(name, spec).alias(name) for name, spec in outputs.items()],
    )


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, name: str
) -> DataFrame:
    """1-based row number within ``keys``; ``chunk`` is a monotone cut of the first
    order column, for example a time bucket."""
    return running(df, keys, order, {name: Running("sum", F.lit(1))}, chunk)
