"""Capture policy: which field class a value belongs to and whether it is kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- fixed values --------------------------------------------------------------
FIELDS = (
    "prompt",
    "systemPrompt",
    "providerInput",
    "assistantOutput",
    "toolInput",
    "toolOutput",
    "metadata",
)
CAPTURED = {
    "metadata-only": ("metadata",),
    "prompts-only": ("prompt", "systemPrompt", "metadata"),
    "conversations": (
        "prompt",
        "systemPrompt",
        "providerInput",
        "assistantOutput",
        "metadata",
    ),
    "full-debug": FIELDS,
}
DEFAULT_POLICY = "full-debug"
CLOSED_POLICY = "metadata-only"
STRUCTURAL_KEYS = (
    "type",
    "timestamp",
    "name",
    "id",
    "traceId",
    "parentObservationId",
    "sessionId",
    "turnIndex",
    "toolCallId",
    "provider",
    "model",
    "runtime",
    "redaction",
    "isError",
    "usage",
    "usageDetails",
    "costDetails",
    "modelParameters",
    "completionStartTime",
    "messageCount",
    "estimatedBytes",
    "payloadCaptured",
    "captureMode",
    "fullMessagesOmitted",
    "contentTruncated",
    "resultTruncated",
    "imgBlocks",
    "compactCount",
    "durationMs",
    "completed",
    "abandoned",
    "failed",
    "stopReason",
    "turns",
    "toolCalls",
    "toolErrors",
    "tokensIn",
    "tokensOut",
    "cacheRead",
    "cacheWrite",
    "messageModel",
    "sessionReason",
)
MESSAGE_ROLE_FIELDS = {
    "system": "systemPrompt",
    "user": "prompt",
    "assistant": "assistantOutput",
    "tool": "toolOutput",
    "tool_result": "toolOutput",
}
METADATA_KEY_FIELDS = {
    "systemPrompt": "systemPrompt",
    "providerPayload": "providerInput",
    "payloadSummary": "providerInput",
    "argsSummary": "toolInput",
    "inputSummary": "toolInput",
    "thinking": "assistantOutput",
    "contentSummary": "toolOutput",
    "resultSummary": "toolOutput",
}
RAW_KEY_FIELDS = {
    "prompt": "prompt",
    "systemPrompt": "systemPrompt",
    "messages": "providerInput",
    "messagesSummary": "providerInput",
    "payloadSummary": "providerInput",
    "inputSummary": "toolInput",
    "text": "assistantOutput",
    "thinking": "assistantOutput",
    "contentSummary": "toolOutput",
    "resultSummary": "toolOutput",
}
RAW_ARGUMENT_KEYS = ("args", "input", "argsSummary")


def _lookup(column: Column, table: Mapping[str, str], default: Column | str | None) -> Column:
    out = None
    for key, field in table.items():
        out = (F if out is None else out).when(column == key, F.lit(field))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def normalize_policy(value: Column) -> Column:
    """A known policy name, else null."""
    name = F.lower(F.trim(value))
    return F.when(name.isin(*CAPTURED), name)


def is_captured(
    field: Column, policy: Column | str | None, override: Column | None = None
) -> Column:
    """Override if there is one, else the policy's preset; unknown policies keep all."""
    name = F.lit(policy) if not isinstance(policy, Column) else policy
    preset = F.lit(True)
    for known, fields in CAPTURED.items():
        preset = F.when(name == known, field.isin(*fields)).otherwise(preset)
    return preset if override is None else F.coalesce(override, preset)


def policy_matrix(spark: SparkSession) -> DataFrame:
    rows = [(p, f, f in kept) for p, kept in CAPTURED.items() for f in FIELDS]
    return spark.createDataFrame(rows, "policy string, field string, captured boolean")


def resolve_policy(candidates: Sequence[Column]) -> Column:
    """First valid candidate; if only invalid ones were given, the closed policy."""
    given = [F.when(F.trim(c) != "", c) for c in candidates]
    none_given = F.coalesce(*given).isNull()
    return F.coalesce(
        *[normalize_policy(c) for c in given],
        F.when(none_given, F.lit(DEFAULT_POLICY)),
        F.lit(CLOSED_POLICY),
    )


UNLIMITED = float("inf")


def parse_limit(value: Column, maximum: float) -> Column:
    """A payload limit from text: a number (rounded, capped), 'unlimited', else null."""
    text = F.lower(F.trim(value))
    number = text.try_cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != UNLIMITED)
    return F.when(text == "unlimited", F.lit(UNLIMITED)).when(
        finite & (number >= 0), F.least(F.lit(float(maximum)), F.floor(number + 0.5).cast("double"))
    )


def resolve_limit(candidates: Sequence[Column], maximum: float) -> Column:
    """First valid candidate; only invalid ones give 0, none gives unlimited."""
    given = [F.when(F.trim(c) != "", c) for c in candidates]
    none_given = F.coalesce(*given).isNull()
    return F.coalesce(
        *[parse_limit(c, maximum) for c in given],
        F.when(none_given, F.lit(UNLIMITED)),
        F.lit(0.0),
    )


def normalize_limit(value: Column, fallback: float = UNLIMITED) -> Column:
    """Whole, not negative; missing or NaN gives the fallback; infinity stays."""
    number = value.cast("double")
    return (
        F.when(number.isNull() | F.isnan(number), F.lit(fallback))
        .when(number == UNLIMITED, number)
        .otherwise(F.greatest(F.lit(0.0), F.floor(number).cast("double")))
    )


def message_field(role: Column, key: Column) -> Column:
    by_role = _lookup(role, MESSAGE_ROLE_FIELDS, "providerInput")
    return (
        F.when(key == "content", by_role)
        .when(key.isin("tool_calls", "arguments"), F.lit("toolInput"))
        .otherwise(F.lit("metadata"))
    )


def metadata_field(key: Column) -> Column:
    return _lookup(key, METADATA_KEY_FIELDS, "metadata")


def trace_field(key: Column) -> Column:
    """Field class of a trace body key; null for structural keys."""
    return (
        F.when(key == "input", F.lit("prompt"))
        .when(key == "output", F.lit("assistantOutput"))
        .when(~key.isin(*STRUCTURAL_KEYS), F.lit("metadata"))
    )


def observation_field(name: Column, key: Column) -> Column:
    """Field class of an observation body key; null for structural keys."""
    is_tool = F.startswith(name, F.lit("tool:"))
    of_input = (
        F.when(is_tool, F.lit("toolInput"))
        .when(name == "llm-response", F.lit("providerInput"))
        .when(name == "agent.prompt", F.lit("prompt"))
        .otherwise(F.lit("metadata"))
    )
    of_output = F.when(is_tool, F.lit("toolOutput")).otherwise(F.lit("assistantOutput"))
    return (
        F.when(key == "input", of_input)
        .when(key == "output", of_output)
        .when(~key.isin(*STRUCTURAL_KEYS), F.lit("metadata"))
    )


def raw_field(type_: Column, key: Column) -> Column:
    """Field class of a raw record key; null for structural keys."""
    of_arguments = F.when(
        F.startswith(type_, F.lit("tool_")), F.lit("toolInput")
    ).otherwise(F.lit("providerInput"))
    other = F.when(key.isin(*RAW_ARGUMENT_KEYS), of_arguments).otherwise(
        F.lit("metadata")
    )
    return F.when(
        ~key.isin(*STRUCTURAL_KEYS), _lookup(key, RAW_KEY_FIELDS, other)
    )


@dataclass(frozen=True)
class Limits:
    """Payload budgets; None is unlimited."""

    string_chars: int | None = None
    tool_chars: int | None = None
    depth: int | None = None
    array_items: int | None = None
    object_keys: int | None = None
    nodes: int | None = None


def bound_string(text: Column, field: Column, limits: Limits) -> Column:
    """Cut a text at the limit of its field class."""

    def cut(limit: int | None) -> Column:
        return text if limit is None else F.substring(text, 1, limit)

    if limits.string_chars is None and limits.tool_chars is None:
        return text
    return F.when(field.isin("toolInput", "toolOutput"), cut(limits.tool_chars)).otherwise(
        cut(limits.string_chars)
    )
