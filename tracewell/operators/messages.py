"""Message windows and failure summaries over long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.summaries import RECENT_MESSAGES, failure_message


def recent_message_rows(
    messages: DataFrame, keys: Sequence[str], order: str, keep: int = RECENT_MESSAGES
) -> DataFrame:
    """The last messages of each request and a marker row for the ones left out.

    The limit on the row number is applied before the shuffle as well, so a task
    sends at most ``keep`` rows of a request, however long it is.
    """
    latest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    recent = (
        messages.withColumn("__back", F.row_number().over(latest))
        .where(F.col("__back") <= keep)
        .select(*keys, order, F.coalesce(F.nullif("role", F.lit("")), F.lit("unknown")).alias("role"), "content")
    )
    left_out = F.col("__total") - keep
    marker = (
        messages.groupBy(*keys)
        .agg(F.count("*").alias("__total"))
        .where(left_out > 0)
        .select(
            *keys,
            F.lit(None).cast(messages.schema[order].dataType).alias(order),
            F.lit("system").alias("role"),
            F.concat(F.lit("[truncated "), left_out.cast("string"), F.lit(" earlier message(s)]")).alias("content"),
        )
    )
    return recent.unionByName(marker)


def failure_reasons(
    attempts: DataFrame, keys: Sequence[str], failed: str, reason: str, shown: int = 3
) -> DataFrame:
    """One message per run that had failures: how many of its batches, and why.

    Reasons are made distinct before they meet; only the first few are ever kept.
    """
    totals = attempts.groupBy(*keys).agg(
        F.count("*").alias("__total"), F.count_if(F.col(failed)).alias("__failed")
    )
    distinct = attempts.where(F.col(failed)).select(*keys, reason).distinct()
    first = Window.partitionBy(*keys).orderBy(reason)
    counts = distinct.groupBy(*keys).agg(F.count("*").alias("__kinds"))
    spelt = (
        distinct.withColumn("__n", F.row_number().over(first))
        .where(F.col("__n") <= shown)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(reason)).alias("__reasons"))
    )
    more = F.col("__kinds") - shown
    base = failure_message(F.col("__reasons"), F.col("__failed"), F.col("__total"), shown)
    rest = F.when(
        more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))
    ).otherwise("")
    joined = totals.where(F.col("__failed") > 0).join(counts, list(keys)).join(spelt, list(keys))
    return joined.select(*keys, F.concat(base, rest).alias("message"))
