"""Bounded, redactable summaries of texts, messages, tool payloads and headers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .redaction import is_sensitive_key, redact_columns

# --- fixed values --------------------------------------------------------------
RECENT_MESSAGES = 40
TEXT_ITEMS = 20
PAYLOAD_KEYS = 50
DIAGNOSTIC_CHARS = 500
SAFE_HEADERS = (
    "content-type",
    "content-length",
    "date",
    "retry-after",
    "server",
    "x-request-id",
    "request-id",
    "openai-processing-ms",
    "anthropic-ratelimit-requests-remaining",
    "anthropic-ratelimit-tokens-remaining",
)
SAFE_PROVIDER_METADATA = (
    "finishReason",
    "stopReason",
    "requestId",
    "responseId",
    "model",
    "provider",
)
MODEL_PARAMETERS = (
    "temperature",
    "top_p",
    "topP",
    "max_tokens",
    "maxTokens",
    "max_completion_tokens",
    "presence_penalty",
    "frequency_penalty",
    "reasoning_effort",
)
IMAGE_TYPES = ("image", "image_url")


def truncate(text: Column, limit: int = 1200) -> Column:
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))
    ).otherwise(text)


def bound_before_scan(text: Column, limit: int) -> Column:
    """Cut a long text before the regexes see it, with a little room beyond ``limit``."""
    room = max(limit * 2, limit + 500)
    return F.when(
        F.length(text) > room,
        F.concat(
            F.substring(text, 1, room),
            F.lit("…[truncated "),
            (F.length(text) - room).cast("string"),
            F.lit(" chars]"),
        ),
    ).otherwise(text)


def telemetry_text(
    df: DataFrame, column: str, limit: int, secrets: Iterable[tuple[str, str]] = ()
) -> DataFrame:
    """Bound, redact and truncate a text column in place."""
    bounded = df.withColumn(column, bound_before_scan(F.col(column), limit))
    redacted = redact_columns(bounded, column, secrets=secrets)
    return redacted.withColumn(column, truncate(F.col(column), limit))


def safe_json(value: Column) -> Column:
    """Compact JSON of a struct, map, array or variant."""
    return F.to_json(value)


def json_bytes(json: Column) -> Column:
    return F.octet_length(json)


def content_text(items: Column, first: int | None = None) -> Column:
    """Texts of the ``text`` items of a content array, one per line."""
    chosen = items if first is None else F.slice(items, 1, first)
    texts = F.filter(chosen, lambda i: (i["type"] == "text") & (i["text"] != ""))
    return F.coalesce(
        F.array_join(F.transform(texts, lambda i: i["text"]), "\n"), F.lit("")
    )


CONTENT_ITEMS = "array<struct<type:string,text:string>>"


def _json_kind(variant: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(variant), "^[A-Z]+", 0)


def message_content(json: Column) -> Column:
    """One line for a JSON message content: a string, a list of items, or an object
    that nests such a list."""
    variant = F.try_parse_json(json)
    kind = _json_kind(variant)
    nested = F.try_variant_get(variant, "$.content", "variant")

    def of_items(items: Column) -> Column:
        text = content_text(F.from_json(F.to_json(items), CONTENT_ITEMS), TEXT_ITEMS)
        total = F.size(F.try_variant_get(items, "$", "array<variant>"))
        return F.when(text != "", text).otherwise(
            F.concat(F.lit("["), total.cast("string"), F.lit(" content item(s)]"))
        )

    return (
        F.when(variant.isNull() | (kind == "VOID"), F.lit(""))
        .when(kind == "ARRAY", of_items(variant))
        .when((kind == "OBJECT") & (_json_kind(nested) == "ARRAY"), of_items(nested))
        .when(kind == "OBJECT", F.lit("[object content]"))
        .otherwise(F.try_variant_get(variant, "$", "string"))
    )


def tool_arguments(tool: Column, args: Column) -> Column:
    """What a tool was asked to do, from its JSON arguments."""

    def at(path: str) -> Column:
        return F.get_json_object(args, path)

    queries = F.array_join(F.from_json(at("$.queries"), "array<string>"), " | ")
    is_object = F.startswith(F.trim(args), F.lit("{"))
    return (
        F.when(~is_object, args)
        .when(tool == "bash", F.coalesce(at("$.command"), F.lit("")))
        .when(
            tool == "read",
            F.concat(
                F.coalesce(at("$.path"), F.lit("")),
                F.lit("#"),
                F.coalesce(at("$.offset"), F.lit("1")),
                F.lit(":"),
                F.coalesce(at("$.limit"), F.lit("")),
            ),
        )
        .when(tool.isin("write", "edit"), F.coalesce(at("$.path"), F.lit("")))
        .when(tool == "web_search", F.coalesce(at("$.query"), queries, F.lit("")))
        .otherwise(args)
    )


def image_blocks(items: Column) -> Column:
    """Number of image items, null if there are none."""
    return F.nullif(
        F.size(F.filter(items, lambda i: i["type"].isin(*IMAGE_TYPES))), F.lit(0)
    )


def tool_content(items: Column) -> Column:
    """Texts of a tool result plus a note on its image items; whole, not truncated."""
    text = content_text(items)
    images = image_blocks(items)
    note = F.when(
        images.isNotNull(),
        F.concat(
            F.lit("["),
            images.cast("string"),
            F.lit(" image content block(s) from tool result]"),
        ),
    )
    return F.concat_ws("\n", F.nullif(text, F.lit("")), note)


def tool_result(result: Column, items: Column) -> Column:
    """A tool result: its texts, else its JSON."""
    text = content_text(items)
    return F.coalesce(F.nullif(text, F.lit("")), result, F.lit(""))


def recent_messages(messages: Column, keep: int = RECENT_MESSAGES) -> Column:
    """The last messages of an array, led by a marker if earlier ones were left out."""
    role = F.lit("system")
    dropped = F.size(messages) - keep
    marker = F.struct(
        role.alias("role"),
        F.concat(
            F.lit("[truncated "), dropped.cast("string"), F.lit(" earlier message(s)]")
        ).alias("content"),
    )
    shown = F.transform(
        F.slice(messages, -keep, keep),
        lambda m: F.struct(
            F.coalesce(F.nullif(m["role"], F.lit("")), F.lit("unknown")).alias("role"),
            m["content"].alias("content"),
        ),
    )
    all_shown = F.transform(
        messages,
        lambda m: F.struct(
            F.coalesce(F.nullif(m["role"], F.lit("")), F.lit("unknown")).alias("role"),
            m["content"].alias("content"),
        ),
    )
    return F.when(dropped > 0, F.concat(F.array(marker), shown)).otherwise(all_shown)


def payload_keys(json: Column) -> Column:
    return F.slice(F.json_object_keys(json), 1, PAYLOAD_KEYS)


def provider_payload(payload: Column, fallback_model: Column) -> Column:
    """Summary of a provider request: model, number of messages, keys."""
    messages = F.get_json_object(payload, "$.messages")
    return F.struct(
        F.coalesce(F.get_json_object(payload, "$.model"), fallback_model).alias("model"),
        F.json_array_length(messages).alias("messageCount"),
        payload_keys(payload).alias("keys"),
    )


def diagnostic(text: Column, limit: int = DIAGNOSTIC_CHARS) -> Column:
    """One bounded line."""
    line = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.when(
        F.length(line) > limit, F.concat(F.substring(line, 1, limit - 1), F.lit("…"))
    ).otherwise(line)


def error_summary(
    id_: Column, status: Column, message: Column, error: Column
) -> Column:
    def part(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}="), value))

    return F.concat_ws(
        ", ",
        part("id", diagnostic(id_, 120)),
        part("status", status.cast("string")),
        part("message", diagnostic(message)),
        part("error", diagnostic(error)),
    )


def failure_message(reasons: Column, failed: Column, total: Column, shown: int = 3) -> Column:
    """Distinct reasons, the first few of them spelt out."""
    distinct = F.array_distinct(reasons)
    more = F.size(distinct) - shown
    return F.concat(
        F.lit("ingestion failed for "),
        failed.cast("string"),
        F.lit("/"),
        total.cast("string"),
        F.lit(" batch(es): "),
        F.array_join(F.slice(distinct, 1, shown), "; "),
        F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(" more)"))).otherwise(""),
    )


def _null_if_empty(map_column: Column) -> Column:
    return F.when(F.size(map_column) > 0, map_column)


def safe_headers(headers: Column) -> Column:
    """Allowed response headers under lower-case names, short values only."""
    lowered = F.map_from_entries(
        F.transform(
            F.filter(
                F.map_entries(headers),
                lambda e: F.lower(e["key"]).isin(*SAFE_HEADERS)
                & (F.length(e["value"]) <= 200),
            ),
            lambda e: F.struct(F.lower(e["key"]), e["value"]),
        )
    )
    return _null_if_empty(lowered)


def safe_provider_metadata(metadata: Column) -> Column:
    return _null_if_empty(
        F.map_filter(
            metadata,
            lambda k, v: k.isin(*SAFE_PROVIDER_METADATA)
            & ~is_sensitive_key(k)
            & (F.length(v) <= 500),
        )
    )


def model_parameters(payload: Column) -> Column:
    """Allowed model parameters of a JSON payload that are strings or numbers."""
    values = F.from_json(payload, "map<string,string>")
    quoted = F.from_json(payload, "map<string,variant>")
    return _null_if_empty(
        F.map_filter(
            values,
            lambda k, v: k.isin(*MODEL_PARAMETERS)
            & _json_kind(quoted[k]).isin(
                "STRING", "BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT"
            ),
        )
    )


def propagated_metadata(metadata: Column) -> Column:
    """Short scalar metadata as text, the part handed on to child observations."""
    texts = F.transform_values(metadata, lambda _, v: v.cast("string"))
    return _null_if_empty(F.map_filter(texts, lambda _, v: F.length(v) <= 200))


def trace_tags(
    fixed: Sequence[str],
    runtime: Column,
    defaults: Column,
    project: Column,
    provider: Column,
    model: Column,
    reason: Column,
) -> Column:
    """Ordered distinct tags of a trace, the first 20."""

    def tag(prefix: str, value: Column) -> Column:
        return F.when(
            value.isNotNull() & (value != ""), F.concat(F.lit(prefix), value)
        )

    tags = F.concat(
        F.array(*[F.lit(t) for t in fixed], F.concat(F.lit("runtime:"), runtime)),
        F.coalesce(defaults, F.array().cast("array<string>")),
        F.array(
            tag("project:", project),
            tag("provider:", provider),
            tag("model:", model),
            tag("session:", reason),
        ),
    )
    return F.slice(F.array_distinct(F.array_compact(tags)), 1, 20)


def parse_list(text: Column, limit: int) -> Column:
    """Comma-separated list: trimmed, without empties, the first ``limit``."""
    items = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.slice(F.filter(items, lambda x: x != ""), 1, limit)


def observation_attributes(body: DataFrame) -> DataFrame:
    """Level from ``is_error``, and usage merged over usage details."""
    empty = F.create_map().cast("map<string,bigint>")
    merged = F.map_concat(
        F.map_filter(
            F.coalesce(F.col("usage_details"), empty),
            lambda k, _: ~F.coalesce(
                F.map_contains_key(F.col("usage"), k), F.lit(False)
            ),
        ),
        F.coalesce(F.col("usage"), empty),
    )
    return body.withColumns(
        {
            "usage_details": _null_if_empty(merged),
            "level": F.when(F.col("is_error"), F.lit("ERROR")),
        }
    )
