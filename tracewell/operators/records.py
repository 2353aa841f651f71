"""Raw trace records and ingestion events as rows of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, StructType

from ..functions.summaries import json_bytes, recent_messages

BASE_COLUMNS = (
    "timestamp", "sessionId", "sessionFile", "turnIndex", "provider", "model", "runtime",
)


def envelope(records: DataFrame, base: dict[str, Column], redacted: bool = True) -> DataFrame:
    """Records with the base fields filled in; a field the record has itself wins."""
    added = {
        name: F.coalesce(F.col(name), value) if name in records.columns else value
        for name, value in base.items()
    }
    return records.withColumns(added).withColumn(
        "redaction", F.struct(F.lit(redacted).alias("applied"))
    )


def big_integers_as_text(df: DataFrame) -> DataFrame:
    """Decimal integers beyond a bigint, which JSON readers round, become text."""

    def converted(column: Column, type_) -> Column:
        if isinstance(type_, DecimalType) and type_.scale == 0:
            return column.cast("string")
        if isinstance(type_, StructType):
            return F.struct(
                *[converted(column[f.name], f.dataType).alias(f.name) for f in type_.fields]
            )
        return column

    return df.select(
        *[converted(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def event_timestamp(end: Column, start: Column, timestamp: Column) -> Column:
    return F.coalesce(end, start, timestamp)


def trace_events(trace_rows: DataFrame) -> DataFrame:
    body = F.struct("id", F.col("start_ms").alias("timestamp"), "name", "input", "output")
    return trace_rows.select(
        F.col("id").alias("trace_id"),
        F.lit(0).cast("bigint").alias("seq"),
        F.lit("trace-create").alias("type"),
        F.col("id").alias("id"),
        F.col("start_ms").alias("timestamp"),
        F.to_json(body).alias("body"),
    )


def observation_events(observation_rows: DataFrame) -> DataFrame:
    """span-create or generation-create; the model only for generations."""
    is_generation = F.col("type") == "GENERATION"
    body = F.struct(
        "id",
        F.col("trace_id").alias("traceId"),
        "name",
        F.col("start_ms").alias("startTime"),
        F.col("parent_id").alias("parentObservationId"),
        "input",
        "output",
        "level",
        F.col("status_message").alias("statusMessage"),
        F.col("end_ms").alias("endTime"),
        F.when(is_generation, F.col("model")).alias("model"),
    )
    return observation_rows.select(
        "trace_id",
        F.coalesce("start_ms", F.lit(0).cast("bigint")).alias("seq"),
        F.when(is_generation, "generation-create").otherwise("span-create").alias("type"),
        "id",
        event_timestamp(F.col("end_ms"), F.col("start_ms"), F.lit(None)).alias("timestamp"),
        F.to_json(body).alias("body"),
    )


def ingestion_events(trace_rows: DataFrame, observation_rows: DataFrame) -> DataFrame:
    return trace_events(trace_rows).unionByName(observation_events(observation_rows))


def with_bytes(events: DataFrame) -> DataFrame:
    """Size of each event as it will be sent."""
    sent = F.to_json(F.struct("type", "id", "timestamp", "body"))
    return events.withColumn("bytes", json_bytes(sent).cast("bigint"))


def provider_requests(
    requests: DataFrame, messages: Column, summary: Column, mode: str = "summary", capture_payload: bool = True
) -> DataFrame:
    """The record of each provider request: ``summary`` keeps a window of its messages,
    ``full`` all of them, ``off`` records nothing.  ``messages`` is an array column."""
    if mode == "off":
        return requests.where(F.lit(False))
    json = F.to_json(messages)
    fields = {
        "type": F.lit("provider_request"),
        "messageCount": F.when(messages.isNotNull(), F.size(messages)),
        "estimatedBytes": json_bytes(json),
        "payloadCaptured": F.lit(capture_payload),
        "payloadSummary": summary if capture_payload else F.lit(None).cast("string"),
        "captureMode": F.lit(mode),
    }
    if mode == "full":
        fields["messages"] = json
    else:
        fields["messagesSummary"] = F.to_json(recent_messages(messages))
        fields["fullMessagesOmitted"] = messages.isNotNull()
    return requests.withColumns(fields)
