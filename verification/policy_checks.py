"""Capture policy, JSON tree redaction and payload budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import policy as C
from tracewell.functions.policy import Limits
from tracewell.operators import tree as T
from . import fixtures as V
from .registry import check
from .sqltext import blob_mark, chain, mark, q, redaction_steps

_STEPS = redaction_steps()


def obj(*parts: tuple[str, str, str]) -> str:
    """SQL of a JSON object text from (key, value SQL, condition SQL), in key order."""
    items = ", ".join(f"CASE WHEN {when} THEN concat('\"{key}\":', CAST({value} AS VARCHAR)) END" for key, value, when in sorted(parts))
    return f"concat('{{', array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ','), '}}')"


def js(column: str) -> str:
    return f"to_json({column})"


_SOURCE = V.SECRET_TEXT.replace("SELECT doc_id, source,", "SELECT doc_id, source, lang,")
_EXPECTED_TREE = obj(
    ("apiKey", js(mark(q("api-key"), "lang")), "true"), ("count", "doc_id", "true"),
    ("image", js(blob_mark(q("image"), "concat('{\"n\":', CAST(doc_id AS VARCHAR), '}')")), "true"),
    ("items", f"concat('[', {js('lang')}, ',', {js('text')}, ',true]')", "true"),
    ("nested", obj(("authorization", js(mark(q("authorization"), "concat('{\"a\":[', CAST(doc_id AS VARCHAR), ']}')")), "true"), ("note", js("text"), "true")), "true"),
    ("token", "'null'", "true"),
)


@check(chain(_SOURCE, "doc_id, lang", _STEPS) + f" SELECT doc_id, sha256({_EXPECTED_TREE}) AS digest FROM s{len(_STEPS)}")
def tree_redaction(spark, sf):
    rows = V.run(spark, sf, _SOURCE)
    n, text = F.col("doc_id"), F.col("text")
    record = F.to_json(
        F.struct(
            F.lit(None).cast("string").alias("token"), F.col("lang").alias("apiKey"), n.alias("count"),
            F.struct(n.alias("n")).alias("image"),
            F.struct(text.alias("note"), F.struct(F.array(n).alias("a")).alias("authorization")).alias("nested"),
        ),
        {"ignoreNullFields": "false"},
    )
    items = F.to_json(F.struct(F.col("lang").alias("a"), text.alias("b")))
    both = F.concat(F.regexp_replace(record, r"\}$", ',"items":['), F.regexp_replace(F.regexp_replace(items, r'^\{"a":', ""), r',"b":(.*)\}$', ",$1,true]}"))
    shaped = T.shape_export(rows.withColumn("record", both), "record", "out", depth=4)
    return shaped.select("doc_id", F.sha2("out", 256).alias("digest"))


# '{"a":["' and '"]}' add 10 characters to the repeated text.
@check("SELECT conv_id, turn, CASE WHEN 60 * length(text) + 10 > 100000 THEN '[structured-value]' ELSE 'kept' END AS kind FROM conversations")
def oversized_sensitive_value(spark, sf):
    """A structured secret beyond the cap is hashed as a fixed marker when bounded."""
    rows = V.read(spark, sf, "conversations")
    plain = F.regexp_replace("text", r'["\\\x00-\x1f]', "x")
    record = F.to_json(F.struct(F.struct(F.array(F.repeat(plain, 60)).alias("a")).alias("secret")))
    shaped = T.shape_json(rows.withColumn("record", record), "record", "out", limits=Limits(), depth=2)
    fixed = F.concat(F.lit("[REDACTED:secret:"), F.substring(F.sha2(F.lit("[structured-value]"), 256), 1, 10), F.lit("]"))
    marker = F.get_json_object("out", "$.secret") == fixed
    return shaped.select("conv_id", "turn", F.when(marker, "[structured-value]").otherwise("kept").alias("kind"))


_POLICY_OF = "CASE conv_id % 5 WHEN 0 THEN 'metadata-only' WHEN 1 THEN 'prompts-only' WHEN 2 THEN 'conversations' WHEN 3 THEN 'full-debug' ELSE 'unknown' END"


def _policy_column():
    return F.expr(_POLICY_OF)


def _captured_sql(field: str) -> str:
    """SQL of the preset for a field class, policy by conversation."""
    allowed = {
        "metadata": "true", "prompt": "conv_id % 5 > 0", "systemPrompt": "conv_id % 5 > 0",
        "providerInput": "conv_id % 5 > 1", "assistantOutput": "conv_id % 5 > 1", "toolInput": "conv_id % 5 > 2", "toolOutput": "conv_id % 5 > 2",
    }
    return allowed[field]


_FIELD_LIST = ", ".join(f"('{f}')" for f in C.FIELDS)
_CAPTURE = "CASE field " + " ".join(f"WHEN '{f}' THEN {_captured_sql(f)}" for f in C.FIELDS) + " END"


@check(f"SELECT conv_id, field, count(*) AS n FROM conversations CROSS JOIN (VALUES {_FIELD_LIST}) AS f(field) WHERE {_CAPTURE} GROUP BY conv_id, field")
def capture_presets(spark, sf):
    rows = V.read(spark, sf, "conversations").withColumn("policy", _policy_column())
    fields = rows.withColumn("field", F.explode(F.array(*[F.lit(f) for f in C.FIELDS])))
    kept = fields.where(C.is_captured(F.col("field"), F.col("policy")))
    return kept.groupBy("conv_id", "field").agg(F.count("*").alias("n"))


@check(f"""SELECT conv_id, field, captured FROM (SELECT DISTINCT conv_id, field, CASE WHEN conv_id % 3 = 0 THEN field <> 'prompt' WHEN conv_id % 7 = 0 THEN false ELSE {_CAPTURE} END AS captured
  FROM conversations CROSS JOIN (VALUES {_FIELD_LIST}) AS f(field)) AS x""")
def capture_overrides(spark, sf):
    rows = V.read(spark, sf, "conversations").select("conv_id").distinct().withColumn("policy", _policy_column())
    fields = rows.withColumn("field", F.explode(F.array(*[F.lit(f) for f in C.FIELDS])))
    n, field = F.col("conv_id"), F.col("field")
    override = F.when(n % 3 == 0, field != "prompt").when(n % 7 == 0, F.lit(False))
    return fields.select("conv_id", "field", C.is_captured(field, F.col("policy"), override).alias("captured"))


@check(f"SELECT c.conv_id, c.turn, captured FROM conversations AS c JOIN (SELECT 'metadata-only' AS policy, false AS captured UNION ALL SELECT 'prompts-only', true UNION ALL SELECT 'conversations', true UNION ALL SELECT 'full-debug', true) AS m ON m.policy = {_POLICY_OF}")
def policy_matrix_join(spark, sf):
    rows = V.read(spark, sf, "conversations").withColumn("policy", _policy_column())
    matrix = C.policy_matrix(spark).where("field = 'prompt'")
    return rows.join(F.broadcast(matrix), "policy").select("conv_id", "turn", "captured")


@check(f"SELECT conv_id, turn, field, {_CAPTURE} AS captured FROM conversations CROSS JOIN (VALUES {_FIELD_LIST}) AS f(field)")
def policy_matrix_all_fields(spark, sf):
    """As policy_matrix_join, of all fields and rows: a policy that the matrix lacks has is_captured's default."""
    rows = V.read(spark, sf, "conversations").withColumn("policy", _policy_column())
    fields = rows.withColumn("field", F.explode(F.array(*[F.lit(f) for f in C.FIELDS])))
    joined = fields.join(F.broadcast(C.policy_matrix(spark)), ["policy", "field"], "left")
    captured = F.coalesce("captured", C.is_captured(F.col("field"), F.col("policy")))
    return joined.select("conv_id", "turn", "field", captured.alias("captured"))


_OPTIONS = """
SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ' Conversations ' WHEN 1 THEN 'bogus' END AS a, CASE conv_id % 4 WHEN 0 THEN 'prompts-only' WHEN 1 THEN '  ' WHEN 2 THEN 'wrong' END AS b,
  CASE turn % 5 WHEN 0 THEN '12.5' WHEN 1 THEN '-3' WHEN 2 THEN ' Unlimited' WHEN 3 THEN 'x' END AS la, CASE conv_id % 3 WHEN 0 THEN '99999' WHEN 1 THEN '' END AS lb FROM conversations"""


@check(f"""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'conversations' WHEN conv_id % 4 = 0 THEN 'prompts-only' WHEN turn % 3 = 1 OR conv_id % 4 = 2 THEN 'metadata-only' ELSE 'full-debug' END AS policy,
  CASE WHEN turn % 5 = 0 THEN 13.0 WHEN turn % 5 = 2 THEN 1e300 WHEN conv_id % 3 = 0 THEN 5000.0 WHEN turn % 5 IN (1, 3) THEN 0.0 ELSE 1e300 END AS max_chars FROM conversations""")
def resolve_options(spark, sf):
    rows = V.run(spark, sf, _OPTIONS)
    limit = F.least(C.resolve_limit([F.col("la"), F.col("lb")], 5000), F.lit(1e300))
    return rows.select("conv_id", "turn", C.resolve_policy([F.col("a"), F.col("b")]).alias("policy"), limit.alias("max_chars"))


@check("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 1e300 WHEN event_id % 7 = 1 THEN 1e300 ELSE greatest(0.0, floor(value - 40)) END AS max_chars FROM events")
def normalize_limits(spark, sf):
    events = V.read(spark, sf, "events")
    n = F.col("event_id") % 7
    value = F.when(n == 0, F.lit(float("nan"))).when(n == 1, F.lit(float("inf"))).otherwise(F.col("value") - 40)
    return events.select("event_id", F.least(C.normalize_limit(value), F.lit(1e300)).alias("max_chars"))


_KEYS = (
    "content", "role", "tool_calls", "arguments", "name", "systemPrompt", "providerPayload", "payloadSummary", "argsSummary", "inputSummary", "thinking",
    "contentSummary", "resultSummary", "input", "output", "metadata", "statusMessage", "traceId", "model", "prompt", "messages", "messagesSummary", "args", "text", "free",
)
_KEY_LIST = ", ".join(f"('{k}')" for k in _KEYS)
_STRUCTURAL = ", ".join(f"'{k}'" for k in C.STRUCTURAL_KEYS)
_NAMES = "CASE turn % 5 WHEN 0 THEN 'tool:bash' WHEN 1 THEN 'llm-response' WHEN 2 THEN 'agent.prompt' WHEN 3 THEN 'agent.turn' ELSE 'tool_call' END"


def _field_rows(spark, sf):
    rows = V.read(spark, sf, "conversations").withColumn("name", F.expr(_NAMES))
    return rows.withColumn("key", F.explode(F.array(*[F.lit(k) for k in _KEYS])))


@check(f"""SELECT conv_id, turn, key, CASE WHEN key = 'content' THEN CASE role WHEN 'system' THEN 'systemPrompt' WHEN 'user' THEN 'prompt' WHEN 'assistant' THEN 'assistantOutput' ELSE 'providerInput' END
  WHEN key IN ('tool_calls', 'arguments') THEN 'toolInput' ELSE 'metadata' END AS field FROM conversations CROSS JOIN (VALUES {_KEY_LIST}) AS k(key)""")
def message_fields(spark, sf):
    return _field_rows(spark, sf).select("conv_id", "turn", "key", C.message_field(F.col("role"), F.col("key")).alias("field"))


@check(f"""SELECT conv_id, turn, key, CASE WHEN key = 'systemPrompt' THEN key WHEN key IN ('providerPayload', 'payloadSummary') THEN 'providerInput' WHEN key IN ('argsSummary', 'inputSummary') THEN 'toolInput'
  WHEN key = 'thinking' THEN 'assistantOutput' WHEN key IN ('contentSummary', 'resultSummary') THEN 'toolOutput' ELSE 'metadata' END AS field FROM conversations CROSS JOIN (VALUES {_KEY_LIST}) AS k(key)""")
def metadata_fields(spark, sf):
    return _field_rows(spark, sf).select("conv_id", "turn", "key", C.metadata_field(F.col("key")).alias("field"))


@check(f"""SELECT conv_id, turn, key, CASE WHEN key = 'input' THEN CASE WHEN turn % 5 = 0 THEN 'toolInput' WHEN turn % 5 = 1 THEN 'providerInput' WHEN turn % 5 = 2 THEN 'prompt' ELSE 'metadata' END
  WHEN key = 'output' THEN CASE WHEN turn % 5 = 0 THEN 'toolOutput' ELSE 'assistantOutput' END WHEN key IN ({_STRUCTURAL}) THEN NULL ELSE 'metadata' END AS field,
  CASE WHEN key = 'input' THEN 'prompt' WHEN key = 'output' THEN 'assistantOutput' WHEN key IN ({_STRUCTURAL}) THEN NULL ELSE 'metadata' END AS trace_field
  FROM conversations CROSS JOIN (VALUES {_KEY_LIST}) AS k(key)""")
def observation_fields(spark, sf):
    key = F.col("key")
    return _field_rows(spark, sf).select("conv_id", "turn", "key", C.observation_field(F.col("name"), key).alias("field"), C.trace_field(key).alias("trace_field"))


@check(f"""SELECT conv_id, turn, key, CASE WHEN key IN ({_STRUCTURAL}) THEN NULL WHEN key IN ('prompt', 'systemPrompt') THEN key WHEN key IN ('messages', 'messagesSummary', 'payloadSummary') THEN 'providerInput'
  WHEN key IN ('args', 'input', 'argsSummary') THEN CASE WHEN turn % 5 = 4 THEN 'toolInput' ELSE 'providerInput' END WHEN key = 'inputSummary' THEN 'toolInput' WHEN key IN ('text', 'thinking') THEN 'assistantOutput'
  WHEN key IN ('contentSummary', 'resultSummary') THEN 'toolOutput' ELSE 'metadata' END AS field FROM conversations CROSS JOIN (VALUES {_KEY_LIST}) AS k(key)""")
def raw_record_fields(spark, sf):
    return _field_rows(spark, sf).select("conv_id", "turn", "key", C.raw_field(F.col("name"), F.col("key")).alias("field"))


# --- shaping of bodies and records ----------------------------------------------------


def _rows(spark, sf):
    return V.read(spark, sf, "conversations").withColumn("policy", _policy_column())


@check("SELECT conv_id, turn, " + obj(
    ("name", js("role"), "true"), ("input", js("text"), _captured_sql("prompt")), ("output", js("text"), _captured_sql("assistantOutput")), ("extra", "turn", "true"),
    ("metadata", obj(("systemPrompt", js("role"), _captured_sql("systemPrompt")), ("thinking", js("role"), _captured_sql("assistantOutput"))), _captured_sql("systemPrompt")),
) + " AS body FROM conversations")
def shape_trace_body(spark, sf):
    t = F.col("text")
    body = F.to_json(F.struct(F.col("role").alias("name"), t.alias("input"), t.alias("output"), F.col("turn").alias("extra"),
                              F.struct(F.col("role").alias("systemPrompt"), F.col("role").alias("thinking")).alias("metadata")))
    shaped = T.shape_trace(_rows(spark, sf).withColumn("body", body), "body", "out", F.col("policy"), redact=False, depth=3)
    return shaped.select("conv_id", "turn", F.col("out").alias("body"))


_OBS_INPUT = f"CASE turn % 5 WHEN 0 THEN {_captured_sql('toolInput')} WHEN 1 THEN {_captured_sql('providerInput')} WHEN 2 THEN {_captured_sql('prompt')} ELSE true END"
_OBS_OUTPUT = f"CASE turn % 5 WHEN 0 THEN {_captured_sql('toolOutput')} ELSE {_captured_sql('assistantOutput')} END"


@check("SELECT conv_id, turn, " + obj(
    ("id", "conv_id", "true"), ("input", js("text"), _OBS_INPUT), ("output", js("role"), _OBS_OUTPUT), ("statusMessage", js("role"), "true"),
    ("metadata", obj(("argsSummary", js("role"), _captured_sql("toolInput")), ("x", "1", "true")), "true"),
) + " AS body FROM conversations")
def shape_observation_body(spark, sf):
    body = F.to_json(F.struct(F.col("conv_id").alias("id"), F.col("text").alias("input"), F.col("role").alias("output"), F.col("role").alias("statusMessage"),
                              F.struct(F.col("role").alias("argsSummary"), F.lit(1).alias("x")).alias("metadata")))
    rows = _rows(spark, sf).withColumns({"body": body, "name": F.expr(_NAMES)})
    shaped = T.shape_observation(rows, "body", "out", F.col("name"), F.col("policy"), redact=False, depth=3)
    return shaped.select("conv_id", "turn", F.col("out").alias("body"))


_ANY_SIDE = "conv_id % 5 > 0"
_MESSAGE_CONTENT = f"CASE role WHEN 'system' THEN {_captured_sql('systemPrompt')} WHEN 'user' THEN {_captured_sql('prompt')} ELSE {_captured_sql('assistantOutput')} END"
_MESSAGE = obj(("role", js("role"), "true"), ("content", js("text"), _MESSAGE_CONTENT), ("arguments", "turn", _captured_sql("toolInput")), ("n", "turn", "true"))


def _raw_record():
    message = F.struct(F.col("role").alias("role"), F.col("text").alias("content"), F.col("turn").alias("arguments"), F.col("turn").alias("n"))
    return F.to_json(F.struct(
        F.lit("tool_call").alias("type"), F.col("role").alias("prompt"), F.array(message).alias("messages"), F.struct(F.col("turn").alias("a")).alias("args"),
        F.col("role").alias("text"), F.col("role").alias("resultSummary"), F.col("turn").alias("turnIndex"), F.col("turn").alias("other")))


@check("SELECT conv_id, turn, " + obj(
    ("type", "'\"tool_call\"'", "true"), ("turnIndex", "turn", "true"), ("other", "turn", "true"), ("prompt", js("role"), _captured_sql("prompt")),
    ("messages", f"concat('[', {_MESSAGE}, ']')", _ANY_SIDE), ("args", obj(("a", "turn", "true")), _captured_sql("toolInput")),
    ("text", js("role"), _captured_sql("assistantOutput")), ("resultSummary", js("role"), _captured_sql("toolOutput")),
) + " AS record FROM conversations")
def shape_raw_record(spark, sf):
    rows = _rows(spark, sf).withColumn("record", _raw_record())
    shaped = T.shape_raw_record(rows, "record", "out", F.lit("tool_call"), F.col("policy"), redact=False, depth=4)
    return shaped.select("conv_id", "turn", F.col("out").alias("record"))


def _budget_check(name: str, limits: Limits, expected: str):
    def query(spark, sf):
        rows = V.read(spark, sf, "conversations").withColumn("record", _raw_record())
        shaped = T.shape_raw_record(rows, "record", "out", F.lit("tool_call"), "full-debug", redact=False, depth=4, limits=limits)
        return shaped.select("conv_id", "turn", F.col("out").alias("record"))

    query.__name__ = name
    check(f"SELECT conv_id, turn, {expected} AS record FROM conversations")(query)


_T = "true"
_TAIL = [("type", "'\"tool_call\"'", _T), ("turnIndex", "turn", _T)]
_ARGS = ("args", obj(("a", "turn", _T)), _T)
_WHOLE_MESSAGE = obj(("role", js("role"), _T), ("content", js("text"), _T), ("arguments", "turn", _T), ("n", "turn", _T))
_MESSAGES = ("messages", f"concat('[', {_WHOLE_MESSAGE}, ']')", _T)
_CUT = "substr({0}, 1, 6)"
_budget_check("budget_string_chars", Limits(string_chars=6, tool_chars=3), obj(
    *_TAIL, _ARGS, ("messages", f"concat('[', {obj(('role', js('role'), _T), ('content', js(_CUT.format('text')), _T), ('arguments', 'turn', _T), ('n', 'turn', _T))}, ']')", _T),
    ("other", "turn", _T), ("prompt", js(_CUT.format("role")), _T), ("resultSummary", js("substr(role, 1, 3)"), _T), ("text", js(_CUT.format("role")), _T)))
_budget_check("budget_depth", Limits(depth=0), obj(
    *_TAIL, ("args", "'\"[TRUNCATED:depth]\"'", _T), _MESSAGES, ("other", "turn", _T), ("prompt", js("role"), _T), ("resultSummary", js("role"), _T), ("text", js("role"), _T)))
_budget_check("budget_array_items", Limits(array_items=0), obj(
    *_TAIL, _ARGS, ("messages", "'[]'", _T), ("other", "turn", _T), ("prompt", js("role"), _T), ("resultSummary", js("role"), _T), ("text", js("role"), _T)))
_budget_check("budget_object_keys", Limits(object_keys=2), obj(
    *_TAIL, _ARGS, ("messages", f"concat('[', {obj(('role', js('role'), _T), ('content', js('text'), _T), ('arguments', 'turn', _T))}, ']')", _T)))
_budget_check("budget_nodes", Limits(nodes=4), obj(
    *_TAIL, _ARGS, ("messages", f"concat('[', {obj(('role', js('role'), _T), ('arguments', 'turn', _T))}, ']')", _T)))


def _document_check(name: str, limits: Limits, message: str):
    """A budget in document order, on a record whose names aren't sorted and one of which is repeated."""

    def query(spark, sf):
        early = F.concat(F.lit('{"prompt":"early","ratio":1.50,'), F.substring(_raw_record(), 2, 2**31 - 1))
        rows = V.read(spark, sf, "conversations").withColumn("record", early)
        shaped = T.shape_raw_record(rows, "record", "out", F.lit("tool_call"), "full-debug", redact=False, depth=4, limits=limits, by_name=False)
        return shaped.select("conv_id", "turn", F.col("out").alias("record"))

    query.__name__ = name
    whole = f"""concat('{{"prompt":', {js('role')}, ',"ratio":1.50,"type":"tool_call","messages":[{{"role":', {js('role')}, {message}, '}}],"turnIndex":', turn, '}}')"""
    check(f"SELECT conv_id, turn, {whole} AS record FROM conversations")(query)


_CONTENT = f"""',"content":', {js('text')}"""
_document_check("budget_object_keys_document", Limits(object_keys=3), _CONTENT + """, ',"arguments":', turn, ',"n":', turn""")
_document_check("budget_nodes_document", Limits(nodes=4), _CONTENT)
