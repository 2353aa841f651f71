"""Delivery of traces to a sink: what is due, what is missing, how it is packed."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .running import Running, running

MAX_BATCH_BYTES = 3_500_000
# What a sent batch has around its events, and after each of them.
ENVELOPE_BYTES, SEPARATOR_BYTES = 256, 1
# Batches packed by one fold: bounds the group a task holds, whatever the data size.
BATCHES_PER_SHARD = 64


def candidates(traces: DataFrame, attempts: DataFrame, key: str = "trace_id") -> DataFrame:
    """Completed traces not attempted before: each is delivered at most once."""
    return traces.where("completed").join(attempts.select(key), key, "left_anti")


def missing_at_sink(traces: DataFrame, acknowledged: DataFrame, key: str = "trace_id") -> DataFrame:
    return traces.join(acknowledged.select(key), key, "left_anti")


def retire(attempts: DataFrame, attempted: DataFrame, key: str = "trace_id") -> DataFrame:
    """The attempt log after a run; every candidate is in it, delivered or not."""
    return attempts.select(key).unionByName(attempted.select(key)).distinct()


def _pack_shard(room: int):
    """Next-fit over the traces of one shard in order of their id."""

    def pack(traces: pd.DataFrame) -> pd.DataFrame:
        traces = traces.sort_values("trace_id", kind="stable")
        reach = np.cumsum(traces["bytes"].to_numpy(dtype=np.int64))
        batch = np.empty(len(reach), dtype=np.int64)
        begin, number, used = 0, 0, 0
        while begin < len(reach):
            end = max(int(np.searchsorted(reach, used + room, side="right")), begin + 1)
            batch[begin:end] = number
            used, begin, number = int(reach[end - 1]), end, number + 1
        return pd.DataFrame({"trace_id": traces["trace_id"], "shard": traces["shard"], "number": batch})

    return pack


def pack_batches(
    events: DataFrame,
    shard: Column | None = None,
    order: Sequence[str] = ("seq",),
    limit: int = MAX_BATCH_BYTES,
    envelope_bytes: int = ENVELOPE_BYTES,
    chunk: Column | None = None,
    event_id: str | None = None,
) -> DataFrame:
    """Add ``batch`` to events (trace_id, bytes and the ``order`` columns).

    A batch as sent, with its envelope and the commas between events, stays within ``limit``.
    A trace travels in one batch if it fits into one: traces are packed next-fit in order of
    their id within their ``shard``.  Only trace ids and sizes reach that step; by default
    there are so many shards that each packs a bounded number of batches, which takes one
    pass over the sizes.  A larger trace is cut along its order; an event larger than a batch
    goes alone.  Where ``order`` repeats within a trace, ``event_id`` names a column that
    tells its events apart.
    """
    room = limit - envelope_bytes
    order = [*order, *([event_id] if event_id and event_id not in order else [])]
    sent = F.col("bytes") + SEPARATOR_BYTES
    sizes = events.groupBy("trace_id").agg(F.sum(sent).cast("bigint").alias("bytes"))
    if shard is None:
        total = sizes.agg(F.sum(F.least("bytes", F.lit(room)))).first()[0] or 0
        shard = trace_shard(shards_for(int(total), limit))
    type_ = events.schema["trace_id"].dataType.simpleString()
    placed = (
        sizes.where(F.col("bytes") <= room)
        .select("trace_id", "bytes", shard.cast("bigint").alias("shard"))
        .groupBy("shard")
        .applyInPandas(_pack_shard(room), f"trace_id {type_}, shard bigint, number bigint")
        .select(
            "trace_id",
            F.concat_ws("-", F.lit("s"), F.col("shard").cast("string"), F.col("number").cast("string")).alias("batch"),
        )
    )
    large = sizes.where(F.col("bytes") > room).select("trace_id")
    of_small = events.join(placed, "trace_id")
    of_large = _split_large(events.join(large, "trace_id", "left_semi"), order, room, chunk)
    return of_small.unionByName(of_large)


def _split_large(
    events: DataFrame, order: Sequence[str], room: int, chunk: Column | None
) -> DataFrame:
    """Cut a large trace along its order, without walking it in one task.

    Laid end to end, an event of at most half the room joins the batch of the half
    its first byte falls into: less than a half begins before it and it adds at most
    another, so a batch never passes the room.  An event above half goes alone.
    """
    half = room // 2
    placed = running(
        events,
        ["trace_id"],
        order,
        {"__before": Running("sum", F.col("bytes") + SEPARATOR_BYTES, exclusive=True)},
        chunk,
    )
    trace = F.col("trace_id").cast("string")
    alone = F.concat_ws("-", F.lit("e"), trace, *[F.col(o).cast("string") for o in order])
    stretch = F.floor(F.col("__before") / F.lit(half)).cast("bigint").cast("string")
    together = F.concat_ws("-", F.lit("t"), trace, stretch)
    return placed.withColumn(
        "batch", F.when(F.col("bytes") + SEPARATOR_BYTES > half, alone).otherwise(together)
    ).drop("__before")


def trace_shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("trace_id"), F.lit(shards))


def shards_for(total_bytes: int, limit: int = MAX_BATCH_BYTES) -> int:
    """Shards so that one packs a bounded number of batches."""
    return max(1, -(-total_bytes // (limit * BATCHES_PER_SHARD)))
