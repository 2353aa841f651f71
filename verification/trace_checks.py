"""Trace reconstruction from lifecycle events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.operators import generations as G, observations as O, ordered, records, trace as T
from . import fixtures as V
from .registry import check
from .staging import tables

_BOUNDARY = "kind IN ('before_agent_start', 'session_start', 'session_shutdown', 'config_refresh', 'agent_end')"


def prelude(source: str, messages: bool) -> str:
    """CTEs e, assigned, prompts, spans, ends, turns, tools over an event source."""
    columns = "*" if messages else "*, CAST(NULL AS VARCHAR) AS role, CAST(NULL AS VARCHAR) AS model, CAST(NULL AS BIGINT) AS usage_input, CAST(NULL AS BIGINT) AS usage_output, CAST(NULL AS BIGINT) AS usage_cache_read, CAST(NULL AS BIGINT) AS usage_cache_write"
    return f"""WITH e AS MATERIALIZED (SELECT {columns} FROM ({source}) AS src),
b AS (SELECT session_key, seq, kind, CASE WHEN kind = 'before_agent_start' THEN concat('p:', coalesce(prompt, ''), '|', coalesce(system_prompt, ''), '|', coalesce(cwd, '')) ELSE '' END AS sig FROM e WHERE {_BOUNDARY}),
b2 AS (SELECT *, kind = 'before_agent_start' AND (lag(sig) OVER (PARTITION BY session_key ORDER BY seq)) IS NOT DISTINCT FROM sig AS repeats FROM b),
m AS (SELECT session_key, seq, kind = 'before_agent_start' AND NOT repeats AS starts, repeats, CASE WHEN kind <> 'before_agent_start' THEN -1 WHEN NOT repeats THEN seq END AS mark FROM b2),
p AS (SELECT e.*, coalesce(m.starts, false) AS starts, coalesce(m.repeats, false) AS repeats, m.mark,
  last_value(m.mark IGNORE NULLS) OVER (PARTITION BY e.session_key ORDER BY e.seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was_open
  FROM e LEFT JOIN m ON e.session_key = m.session_key AND e.seq = m.seq),
assigned AS MATERIALIZED (SELECT *, CASE WHEN starts THEN seq ELSE nullif(was_open, -1) END AS prompt_seq, CASE WHEN starts OR mark = -1 THEN nullif(was_open, -1) END AS closes FROM p),
prompts AS MATERIALIZED (SELECT s.session_key, s.seq AS prompt_seq, s.prompt, s.event_ms AS start_ms, c.seq AS end_seq, c.event_ms AS end_ms, c.kind AS end_kind,
  CASE c.kind WHEN 'before_agent_start' THEN 'prompt replaced' WHEN 'session_start' THEN 'session replacement' WHEN 'session_shutdown' THEN 'session shutdown' WHEN 'config_refresh' THEN 'config refresh' END AS close_reason
  FROM assigned AS s LEFT JOIN assigned AS c ON c.session_key = s.session_key AND c.closes = s.seq WHERE s.starts),
t0 AS (SELECT session_key, prompt_seq, turn_index, min(seq) FILTER (kind = 'turn_start') AS start_seq, arg_min(event_ms, seq) FILTER (kind = 'turn_start') AS start_ms,
  min(seq) FILTER (kind = 'turn_end') AS x_seq, arg_min(event_ms, seq) FILTER (kind = 'turn_end') AS x_ms,
  arg_min(CASE WHEN stop_reason IN ('error', 'aborted') THEN stop_reason ELSE '-' END, seq) FILTER (kind = 'turn_end') AS x_stop,
  arg_min(coalesce(error_message, '-'), seq) FILTER (kind = 'turn_end') AS x_message
  FROM assigned WHERE prompt_seq IS NOT NULL AND turn_index IS NOT NULL AND kind IN ('turn_start', 'turn_end') GROUP BY ALL),
spans AS MATERIALIZED (SELECT t0.*, row_number() OVER (PARTITION BY t0.session_key, t0.prompt_seq ORDER BY t0.start_seq) AS turn_number, coalesce(x_seq, p.end_seq) AS end_seq, coalesce(x_ms, p.end_ms) AS end_ms,
  x_seq IS NULL AND p.end_seq IS NOT NULL AS abandoned, x_seq IS NULL AND p.end_seq IS NULL AS open
  FROM t0 JOIN prompts AS p ON t0.session_key = p.session_key AND t0.prompt_seq = p.prompt_seq WHERE t0.start_seq IS NOT NULL AND (x_seq IS NULL OR t0.start_seq < x_seq)),
placed AS MATERIALIZED (SELECT a.*, (SELECT arg_max(s.turn_index, s.start_seq) FROM spans AS s WHERE s.session_key = a.session_key AND s.prompt_seq = a.prompt_seq AND s.start_seq <= a.seq AND (s.end_seq IS NULL OR s.end_seq > a.seq)) AS latest_turn
  FROM assigned AS a WHERE a.prompt_seq IS NOT NULL),
ends AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_key, prompt_seq, latest_turn ORDER BY seq) AS n FROM placed WHERE kind = 'message_end' AND role = 'assistant' AND latest_turn IS NOT NULL) AS x WHERE n = 1),
turns AS MATERIALIZED (SELECT s.*, CASE WHEN x_stop <> '-' THEN x_stop WHEN e2.stop_reason IN ('error', 'aborted') THEN e2.stop_reason END AS stop_reason,
  CASE WHEN x_stop <> '-' THEN nullif(x_message, '-') WHEN e2.stop_reason IN ('error', 'aborted') THEN e2.error_message END AS error_message
  FROM spans AS s LEFT JOIN ends AS e2 ON e2.session_key = s.session_key AND e2.prompt_seq = s.prompt_seq AND e2.latest_turn = s.turn_index),
tool_ends AS (SELECT session_key, prompt_seq, tool_call_id, min(seq) AS end_seq, arg_min(event_ms, seq) AS end_ms, arg_min(coalesce(is_error, false), seq) AS end_error, arg_min(coalesce(result, ''), seq) AS end_result
  FROM placed WHERE kind = 'tool_execution_end' GROUP BY ALL),
tool_rows AS (SELECT a.*, x.end_seq AS x_seq, x.end_seq IS NULL OR a.seq < x.end_seq AS before_end FROM placed AS a LEFT JOIN tool_ends AS x ON x.session_key = a.session_key AND x.prompt_seq = a.prompt_seq AND x.tool_call_id = a.tool_call_id WHERE a.kind LIKE 'tool%'),
tool_first AS (SELECT session_key, prompt_seq, tool_call_id, min(seq) AS first_seq, arg_min(event_ms, seq) AS start_ms, arg_min(coalesce(latest_turn, -1), seq) AS turn_index,
  arg_max(args, seq) FILTER (kind IN ('tool_call', 'tool_execution_start')) AS args,
  arg_max(is_error, seq) FILTER (kind = 'tool_result' AND before_end) AS result_error, arg_max(result, seq) FILTER (kind = 'tool_result' AND before_end AND coalesce(result, '') <> '') AS last_result,
  arg_max(result, seq) FILTER (kind = 'tool_execution_update' AND before_end AND coalesce(result, '') <> '') AS partial, count(*) FILTER (kind = 'tool_result' AND before_end) > 0 AS resulted
  FROM tool_rows GROUP BY ALL),
tools AS MATERIALIZED (SELECT f.session_key, f.prompt_seq, f.tool_call_id, first_seq, f.start_ms, coalesce(x.end_ms, p.end_ms) AS end_ms, nullif(turn_index, -1) AS turn_index, args, partial,
  CASE WHEN x.end_seq IS NOT NULL THEN 'completed' WHEN p.end_seq IS NULL THEN 'open' WHEN resulted THEN 'result-only' ELSE 'abandoned' END AS status,
  CASE WHEN x.end_seq IS NOT NULL THEN x.end_error WHEN resulted THEN coalesce(result_error, false) ELSE p.end_seq IS NOT NULL END AS is_error,
  coalesce(nullif(x.end_result, ''), last_result, partial) AS output
  FROM tool_first AS f LEFT JOIN tool_ends AS x ON x.session_key = f.session_key AND x.prompt_seq = f.prompt_seq AND x.tool_call_id = f.tool_call_id
  JOIN prompts AS p ON p.session_key = f.session_key AND p.prompt_seq = f.prompt_seq)
"""


LIFE = prelude(V.LIFECYCLE, True)
RANDOM = prelude(V.RANDOM_SQL, False)
# Generations of the well-formed stream: one per turn, as repeated requests collapse.
GENS = LIFE + """, g0 AS (SELECT *, latest_turn AS t FROM placed WHERE latest_turn IS NOT NULL AND kind IN ('before_provider_request', 'after_provider_response', 'message_start', 'message_update', 'message_end')),
gend AS (SELECT session_key, prompt_seq, latest_turn AS t, seq, event_ms, text, usage_input, usage_output, cost_total, stop_reason, error_message FROM ends),
g1 AS (SELECT g0.*, x.seq IS NULL OR g0.seq <= x.seq AS live FROM g0 LEFT JOIN gend AS x ON x.session_key = g0.session_key AND x.prompt_seq = g0.prompt_seq AND x.t = g0.t),
g2 AS (SELECT session_key, prompt_seq, t AS turn_index, min(seq) AS start_seq, arg_min(event_ms, seq) AS start_ms, count(*) FILTER (kind <> 'before_provider_request') > 0 AS started,
  arg_max(model, seq) FILTER (kind = 'before_provider_request') AS request_model, arg_max(status, seq) FILTER (kind = 'after_provider_response') AS provider_status,
  array_to_string(list(status ORDER BY seq) FILTER (kind = 'after_provider_response'), ',') AS statuses, coalesce(bool_or(status >= 400), false) AS provider_error,
  min(event_ms) FILTER (kind = 'message_update') AS token_ms, string_agg(delta, '' ORDER BY seq) FILTER (delta_kind = 'text_delta') AS stream_text, string_agg(delta, '' ORDER BY seq) FILTER (delta_kind = 'thinking_delta') AS stream_thinking
  FROM g1 WHERE live GROUP BY ALL),
gens AS MATERIALIZED (SELECT g2.*, x.event_ms AS x_ms, x.seq AS x_seq, s.end_ms AS turn_ms, s.end_seq AS turn_end, s.abandoned AS turn_abandoned, x.text, x.usage_input, x.usage_output, x.cost_total, x.stop_reason, x.error_message,
  x.seq IS NULL AND s.end_seq IS NOT NULL AS abandoned FROM g2 LEFT JOIN gend AS x ON x.session_key = g2.session_key AND x.prompt_seq = g2.prompt_seq AND x.t = g2.turn_index
  JOIN spans AS s ON s.session_key = g2.session_key AND s.prompt_seq = g2.prompt_seq AND s.turn_index = g2.turn_index)
"""


def both(name: str, final: str, query):
    """Register a check on the well-formed and on the random event stream."""
    for stream, ctes in (("lifecycle", LIFE), ("random", RANDOM)):

        def run(spark, sf, stream=stream):
            return query(tables(spark, sf, stream))

        run.__name__ = f"{name}_{stream}"
        check(ctes + final)(run)


# --- sessions and prompts ---------------------------------------------------------------

_FILES = "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url END AS session_file, CASE WHEN page_id % 6 = 3 THEN 'x' END AS id, CASE WHEN page_id % 6 > 1 THEN url END AS session_key FROM pages"


@check(f"SELECT 'kept' AS part, count(*) AS n FROM ({_FILES}) AS f WHERE session_key IS NOT NULL UNION ALL SELECT 'ambiguous', count(*) FROM ({_FILES}) AS f WHERE session_key IS NULL")
def split_ambiguous(spark, sf):
    kept, ambiguous = T.split_ambiguous(V.run(spark, sf, _FILES))
    counts = [d.agg(F.count("*").alias("n")).select(F.lit(p).alias("part"), "n") for p, d in (("kept", kept), ("ambiguous", ambiguous))]
    return counts[0].unionByName(counts[1])


@check("SELECT page_id FROM pages WHERE page_id % 3 = 0")
def persisted_sessions(spark, sf):
    return T.persisted_only(V.run(spark, sf, _FILES), True, True, False).select("page_id")


both("prompt_assignment", "SELECT session_key, seq, prompt_seq, starts, repeats, closes FROM assigned",
     lambda t: t.placed.select("session_key", "seq", "prompt_seq", "starts", "repeats", "closes"))
both("prompt_segments", "SELECT session_key, prompt_seq, prompt, start_ms, end_seq, end_ms, end_kind, close_reason FROM prompts",
     lambda t: t.prompts.select("session_key", "prompt_seq", "prompt", "start_ms", "end_seq", "end_ms", "end_kind", "close_reason"))
both("repeated_starts", "SELECT session_key, prompt_seq, count(*) AS n FROM assigned WHERE repeats GROUP BY ALL",
     lambda t: t.placed.where("repeats").groupBy(*T.PROMPT).agg(F.count("*").alias("n")))
both("late_events", f"SELECT session_key, seq, kind FROM assigned WHERE prompt_seq IS NULL AND NOT {_BOUNDARY}",
     lambda t: T.late_events(t.placed).select("session_key", "seq", "kind"))


def _stream_check(name, lifecycle_sql, random_sql, query):
    for stream, source, sql in (("lifecycle", V.lifecycle, lifecycle_sql), ("random", V.random_stream, random_sql)):
        if sql is None:
            continue

        def run(spark, sf, source=source):
            return query(source(spark, sf))

        run.__name__ = f"{name}_{stream}"
        check(sql)(run)


_COMPACT = """WITH e AS (SELECT * FROM ({0}) AS s), g AS (SELECT *, count(*) FILTER (kind = 'session_start') OVER (PARTITION BY session_key ORDER BY seq) AS life FROM e)
SELECT session_key, seq, count(*) FILTER (kind = 'session_compact') OVER (PARTITION BY session_key, life ORDER BY seq) AS compact_count FROM g"""
_stream_check("compaction_counts", _COMPACT.format(V.LIFECYCLE), _COMPACT.format(V.RANDOM_SQL),
              lambda events: T.compaction_counts(events).select("session_key", "seq", "compact_count"))

_MODEL = f"""WITH e AS (SELECT *, CASE WHEN kind = 'model_select' THEN concat(coalesce(model, ''), '/', coalesce(provider, '')) END AS pick FROM ({V.LIFECYCLE}) AS s)
SELECT session_key, seq, coalesce(last_value(pick IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '/') AS chosen FROM e"""
_stream_check("carried_model", _MODEL, None, lambda events: T.carry_model(events).select(
    "session_key", "seq", F.concat("session_model", F.lit("/"), "session_provider").alias("chosen")))


@check("SELECT event_id, CASE WHEN event_type IN ('error', 'aborted') THEN event_type END AS failure FROM events")
def failure_kinds(spark, sf):
    events = V.read(spark, sf, "events")
    return events.select("event_id", T.failure_kind(F.col("event_type")).alias("failure"))


# --- turns ---------------------------------------------------------------------------

both("turn_spans", "SELECT session_key, prompt_seq, turn_index, turn_number, start_seq, end_seq, abandoned, open FROM spans",
     lambda t: t.spans.select("session_key", "prompt_seq", "turn_index", "turn_number", "start_seq", "end_seq", "abandoned", "open"))
both("turn_records", """SELECT session_key, prompt_seq, turn_index, end_ms - start_ms AS duration_ms, stop_reason, error_message, abandoned OR stop_reason IS NOT NULL AS is_error,
  CASE WHEN abandoned THEN 'turn ended during cleanup' WHEN stop_reason IS NOT NULL THEN coalesce(error_message, concat('agent turn ', stop_reason)) END AS status_message FROM turns""",
     lambda t: t.turn_verdicts.select("session_key", "prompt_seq", "turn_index", "duration_ms", "stop_reason", "error_message", "is_error", "status_message"))
both("latest_open_turn", "SELECT session_key, prompt_seq, seq, latest_turn FROM placed",
     lambda t: T.resolve_turns(T.inside(t.placed).select("session_key", "prompt_seq", "seq"), t.spans, last=t.last).select("session_key", "prompt_seq", "seq", "latest_turn"))


@check(LIFE + "SELECT session_key, prompt_seq, latest_turn AS turn_index, seq, text, stop_reason FROM ends")
def message_ends(spark, sf):
    return tables(spark, sf).message_ends.select("session_key", "prompt_seq", "turn_index", "seq", "text", "stop_reason")


# --- tools ----------------------------------------------------------------------------

both("tool_correlation", "SELECT session_key, prompt_seq, tool_call_id, first_seq, turn_index, args, status, is_error, output, end_ms - start_ms AS duration_ms FROM tools",
     lambda t: t.tools.select("session_key", "prompt_seq", "tool_call_id", "first_seq", "turn_index", "args", "status", "is_error", "output", "duration_ms"))
both("tool_progress", "SELECT session_key, prompt_seq, tool_call_id, partial FROM tools WHERE partial IS NOT NULL",
     lambda t: t.tools.where("partial IS NOT NULL").select("session_key", "prompt_seq", "tool_call_id", "partial"))
both("tool_abandonment", "SELECT session_key, prompt_seq, tool_call_id, status FROM tools WHERE status IN ('abandoned', 'result-only')",
     lambda t: t.tools.where("status IN ('abandoned', 'result-only')").select("session_key", "prompt_seq", "tool_call_id", "status"))
both("first_seen_results", """SELECT session_key, prompt_seq, tool_call_id, seq, result, is_error FROM (SELECT *, row_number() OVER (PARTITION BY session_key, prompt_seq, tool_call_id ORDER BY seq) AS n FROM placed WHERE kind = 'tool_result') AS r WHERE n = 1""",
     lambda t: t.first_results.select("session_key", "prompt_seq", "tool_call_id", "seq", "result", "is_error"))
both("tool_error_scores", "SELECT session_key, prompt_seq, tool_call_id, 'tool_is_error' AS name, 1.0 AS value FROM tools WHERE is_error",
     lambda t: T.tool_error_scores(t.tools))


# --- generations -----------------------------------------------------------------------


@check(GENS + "SELECT session_key, prompt_seq, turn_index, concat('turn:', CAST(turn_index AS VARCHAR), ':request:0') AS request_key, start_seq, started FROM gens")
def generation_correlation(spark, sf):
    return tables(spark, sf).generations.select("session_key", "prompt_seq", "turn_index", "request_key", "start_seq", "started")


@check(GENS + "SELECT session_key, prompt_seq, turn_index, stream_text, stream_thinking FROM gens")
def stream_texts(spark, sf):
    return tables(spark, sf).generations.select("session_key", "prompt_seq", "turn_index", "stream_text", "stream_thinking")


@check(GENS + """SELECT session_key, prompt_seq, turn_index, CASE WHEN x_seq IS NOT NULL THEN coalesce(nullif(trim(text), ''), concat(coalesce(stream_thinking, ''), coalesce(stream_text, ''))) END AS output, request_model AS model,
  coalesce(x_ms, turn_ms) - start_ms AS duration_ms, abandoned OR stop_reason IS NOT NULL AS is_error, CASE WHEN abandoned THEN 'generation abandoned during prompt finalization' WHEN stop_reason IS NOT NULL AND error_message IS NOT NULL THEN error_message
  WHEN stop_reason = 'error' THEN CASE WHEN provider_status IS NOT NULL THEN concat('provider response failed (', CAST(provider_status AS VARCHAR), ')') ELSE 'provider response failed' END WHEN stop_reason = 'aborted' THEN 'provider response aborted' END AS status_message FROM gens""")
def generation_ends(spark, sf):
    return tables(spark, sf).generations.select("session_key", "prompt_seq", "turn_index", "output", "model", "duration_ms", "is_error", "status_message")


@check(GENS + "SELECT session_key, prompt_seq, turn_index, abandoned FROM gens WHERE abandoned")
def generation_abandonment(spark, sf):
    return tables(spark, sf).cut_generations.select("session_key", "prompt_seq", "turn_index", "abandoned")


@check(GENS + "SELECT session_key, prompt_seq, turn_index, greatest(0, token_ms - start_ms) AS time_to_first_token_ms FROM gens")
def time_to_first_token(spark, sf):
    return tables(spark, sf).generations.select("session_key", "prompt_seq", "turn_index", "time_to_first_token_ms")


@check(GENS + "SELECT session_key, prompt_seq, turn_index, provider_status, coalesce(statuses, '') AS statuses, provider_error FROM gens")
def provider_statuses(spark, sf):
    g = tables(spark, sf).generations
    return g.select("session_key", "prompt_seq", "turn_index", "provider_status", F.array_join(F.transform("provider_statuses", lambda s: s.cast("string")), ",").alias("statuses"), "provider_error")


@check(GENS + """SELECT session_key, prompt_seq, turn_index, name, value FROM (SELECT session_key, prompt_seq, turn_index, unnest(['input_tokens', 'output_tokens', 'total_cost']) AS name,
  unnest([CAST(nullif(usage_input, 0) AS DOUBLE), CAST(nullif(usage_output, 0) AS DOUBLE), CAST(cost_total AS DOUBLE)]) AS value FROM gens) AS s WHERE value IS NOT NULL""")
def generation_scores(spark, sf):
    return G.generation_scores(tables(spark, sf).generations).select("session_key", "prompt_seq", "turn_index", "name", "value")


def _requests(spark, sf):
    t = tables(spark, sf)
    events = G.generation_events(t.assigned, t.spans, t.last)
    return events.where("step = 'request'")


@check(LIFE + """SELECT session_key, prompt_seq, latest_turn AS turn_index, array_to_string(list(concat(CAST(event_ms AS VARCHAR), ':', CAST(length(payload) AS VARCHAR), ':', model) ORDER BY seq), ',') AS requests
  FROM placed WHERE kind = 'before_provider_request' AND latest_turn IS NOT NULL GROUP BY ALL""")
def requests_per_turn(spark, sf):
    listed = G.requests_per_turn(_requests(spark, sf), F.length("payload"))
    text = F.transform("requests", lambda r: F.concat_ws(":", r["event_ms"].cast("string"), r["payload_size"].cast("string"), r["model"]))
    return listed.select("session_key", "prompt_seq", "turn_index", F.array_join(text, ",").alias("requests"))


@check(LIFE + """SELECT session_key, prompt_seq, turn_index, seq, CAST(sum(fresh) OVER (PARTITION BY session_key, prompt_seq, turn_index ORDER BY seq) - 1 AS INT) AS generation FROM (
  SELECT session_key, prompt_seq, latest_turn AS turn_index, seq, CASE WHEN payload IS DISTINCT FROM lag(payload) OVER (PARTITION BY session_key, prompt_seq, latest_turn ORDER BY seq) THEN 1 ELSE 0 END AS fresh
  FROM placed WHERE kind = 'before_provider_request' AND latest_turn IS NOT NULL) AS r""")
def retry_collapse(spark, sf):
    t = tables(spark, sf)
    requests = G.generation_events(t.placed, t.spans, t.last).where("step = 'request'")
    return G.collapse_retries(requests).select("session_key", "prompt_seq", "turn_index", "seq", "generation")


@check(LIFE + """SELECT session_key, prompt_seq, seq, input FROM (SELECT *, last_value(CASE WHEN kind = 'context' THEN text WHEN starts THEN prompt END IGNORE NULLS) OVER (PARTITION BY session_key, prompt_seq ORDER BY seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS input FROM placed WHERE kind IN ('context', 'before_provider_request') OR starts) AS x WHERE kind = 'before_provider_request'""")
def input_snapshots(spark, sf):
    return G.input_snapshots(tables(spark, sf).assigned)


@check("""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations)
  SELECT conv_id, 'provider_request' AS type, CAST(count(*) AS INT) AS messageCount, 'summary' AS captureMode, true AS fullMessagesOmitted,
  CAST(strlen(concat('[', string_agg(concat('{"role":', to_json(role), ',"content":', to_json(text), '}'), ',' ORDER BY turn), ']')) AS BIGINT) AS estimatedBytes,
  concat('[', CASE WHEN count(*) > 40 THEN concat('{"role":"system","content":"[truncated ', CAST(count(*) - 40 AS VARCHAR), ' earlier message(s)]"},') ELSE '' END,
  string_agg(concat('{"role":', to_json(role), ',"content":', to_json(text), '}'), ',' ORDER BY turn) FILTER (i > total - 40), ']') AS messagesSummary FROM n GROUP BY conv_id""")
def provider_request_records(spark, sf):
    rows = V.read(spark, sf, "conversations")
    requests = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("ms"))
    messages = F.transform("ms", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    record = records.provider_requests(requests.withColumn("m", messages), F.col("m"), F.lit("none"))
    return record.select("conv_id", "type", "messageCount", "captureMode", "fullMessagesOmitted", F.col("estimatedBytes").cast("bigint"), "messagesSummary")


# --- prompts as a whole ------------------------------------------------------------------

_ROLLUP = """, tc AS (SELECT session_key, prompt_seq, count(*) AS turns, count(*) FILTER (abandoned) AS cut FROM spans GROUP BY ALL),
oc AS (SELECT session_key, prompt_seq, count(*) AS calls, count(*) FILTER (is_error AND status IN ('completed', 'result-only')) AS errors, count(*) FILTER (status = 'abandoned') AS cut FROM tools GROUP BY ALL),
uc AS (SELECT session_key, prompt_seq, CAST(sum(coalesce(usage_input, 0) + coalesce(usage_cache_read, 0) + coalesce(usage_cache_write, 0)) AS BIGINT) AS tokens_in, CAST(sum(coalesce(usage_output, 0)) AS BIGINT) AS tokens_out,
  CAST(sum(coalesce(usage_cache_read, 0)) AS BIGINT) AS cache_read, CAST(sum(coalesce(usage_cache_write, 0)) AS BIGINT) AS cache_write FROM ends GROUP BY ALL),
parts AS (SELECT session_key, prompt_seq, seq, false AS last, text, CASE WHEN stop_reason IN ('error', 'aborted') THEN concat(stop_reason, '|', coalesce(error_message, '')) END AS failure FROM ends
  UNION ALL SELECT session_key, prompt_seq, x_seq, false, NULL, concat(x_stop, '|', CASE WHEN x_message = '-' THEN '' ELSE x_message END) FROM spans WHERE x_seq IS NOT NULL AND x_stop <> '-'
  UNION ALL SELECT session_key, closes, seq, true, CASE WHEN trim(coalesce(text, '')) <> '' THEN text END, CASE WHEN stop_reason IN ('error', 'aborted') THEN concat(stop_reason, '|', coalesce(error_message, '')) END FROM assigned WHERE closes IS NOT NULL AND kind = 'agent_end'),
fc AS (SELECT session_key, prompt_seq, arg_max(text, seq) FILTER (text IS NOT NULL) AS output, coalesce(arg_max(failure, seq) FILTER (last AND failure IS NOT NULL), arg_min(failure, seq) FILTER (NOT last AND failure IS NOT NULL)) AS failure FROM parts GROUP BY ALL),
r0 AS (SELECT p.*, coalesce(tc.turns, 0) AS turns, coalesce(calls, 0) AS tool_calls, coalesce(errors, 0) AS tool_errors, coalesce(tokens_in, 0) AS tokens_in, coalesce(tokens_out, 0) AS tokens_out, coalesce(cache_read, 0) AS cache_read,
  coalesce(cache_write, 0) AS cache_write, fc.output, CASE WHEN p.end_seq IS NOT NULL THEN failure END AS failure,
  CASE WHEN p.end_seq IS NOT NULL THEN coalesce(close_reason, CASE WHEN EXISTS (SELECT 1 FROM cut_gens AS c WHERE c.session_key = p.session_key AND c.prompt_seq = p.prompt_seq) THEN 'turn ended before generation completion' END,
  CASE WHEN coalesce(tc.cut, 0) + coalesce(oc.cut, 0) > 0 THEN 'agent finalization' END) END AS reason
  FROM prompts AS p LEFT JOIN tc ON tc.session_key = p.session_key AND tc.prompt_seq = p.prompt_seq LEFT JOIN oc ON oc.session_key = p.session_key AND oc.prompt_seq = p.prompt_seq
  LEFT JOIN uc ON uc.session_key = p.session_key AND uc.prompt_seq = p.prompt_seq LEFT JOIN fc ON fc.session_key = p.session_key AND fc.prompt_seq = p.prompt_seq),
rolled AS MATERIALIZED (SELECT *, CASE WHEN end_seq IS NULL THEN 'open' WHEN failure IS NOT NULL THEN 'failed' WHEN reason IS NOT NULL THEN 'abandoned' ELSE 'completed' END AS verdict,
  CASE WHEN failure IS NOT NULL THEN concat('agent ', string_split(failure, '|')[1], CASE WHEN failure LIKE '%|' THEN '' ELSE concat(': ', string_split(failure, '|')[2]) END) WHEN reason IS NOT NULL THEN concat('prompt abandoned during ', reason) END AS status_message FROM r0)
"""
LIFE_ROLLUP = GENS + ", cut_gens AS (SELECT * FROM gens WHERE abandoned AND NOT turn_abandoned)" + _ROLLUP
_RANDOM_ROLLUP = RANDOM + ", cut_gens AS (SELECT * FROM spans WHERE false)" + _ROLLUP


def _both_rollups(name, final, query):
    for stream, ctes in (("lifecycle", LIFE_ROLLUP), ("random", _RANDOM_ROLLUP)):

        def run(spark, sf, stream=stream):
            return query(tables(spark, sf, stream))

        run.__name__ = f"{name}_{stream}"
        check(ctes + final)(run)


_both_rollups("prompt_rollup", "SELECT session_key, prompt_seq, end_ms - start_ms AS duration_ms, turns, tool_calls, tool_errors, tokens_in, tokens_out, cache_read, cache_write, output FROM rolled",
              lambda t: t.traces.select("session_key", "prompt_seq", "duration_ms", "turns", "tool_calls", "tool_errors", "tokens_in", "tokens_out", "cache_read", "cache_write", "output"))
_both_rollups("prompt_verdicts", "SELECT session_key, prompt_seq, verdict, reason AS abandonment_reason, status_message, reason IS NOT NULL AS abandoned, failure IS NOT NULL AS failed FROM rolled",
              lambda t: t.traces.select("session_key", "prompt_seq", "verdict", "abandonment_reason", "status_message", "abandoned", "failed"))
_both_rollups("health_scores", """SELECT session_key, prompt_seq, name, value FROM (SELECT session_key, prompt_seq, unnest(['tool_call_count', 'turn_count', 'total_tool_errors', 'tool_success_rate', 'session_had_errors']) AS name,
  unnest([CAST(tool_calls AS DOUBLE), turns, tool_errors, CASE WHEN tool_calls > 0 THEN greatest(0.0, (tool_calls - tool_errors) / tool_calls) ELSE 1.0 END, CASE WHEN tool_errors > 0 OR reason IS NOT NULL OR failure IS NOT NULL THEN 1 ELSE 0 END]) AS value FROM rolled WHERE verdict <> 'open') AS s""",
              lambda t: T.health_scores(t.traces))


# --- traces and observations ------------------------------------------------------------

_TRACE = "substr(sha256(concat(session_key, '|', CAST(prompt_seq AS VARCHAR))), 1, 32)"
_REGISTRY = LIFE_ROLLUP + f""", ids AS (
  SELECT {_TRACE} AS trace_id, 'root' AS part, 'agent.prompt' AS name, 'SPAN' AS type, '' AS parent_part, CASE WHEN verdict IN ('failed', 'abandoned') THEN 'ERROR' ELSE 'DEFAULT' END AS level, start_ms FROM rolled
  UNION ALL SELECT {_TRACE}, concat('turn|', CAST(turn_index AS VARCHAR)), 'agent.turn', 'SPAN', 'root', CASE WHEN abandoned OR stop_reason IS NOT NULL THEN 'ERROR' ELSE 'DEFAULT' END, start_ms FROM turns
  UNION ALL SELECT {_TRACE}, concat('tool|', tool_call_id), NULL, 'SPAN', CASE WHEN turn_index IS NULL THEN 'root' ELSE concat('turn|', CAST(turn_index AS VARCHAR)) END, CASE WHEN is_error THEN 'ERROR' ELSE 'DEFAULT' END, start_ms FROM tools
  UNION ALL SELECT {_TRACE}, concat('generation|', CAST(turn_index AS VARCHAR), '|0'), 'llm-response', 'GENERATION', concat('turn|', CAST(turn_index AS VARCHAR)), CASE WHEN abandoned OR stop_reason IS NOT NULL THEN 'ERROR' ELSE 'DEFAULT' END, start_ms FROM gens WHERE started),
obs AS MATERIALIZED (SELECT *, substr(sha256(concat(trace_id, '|', part)), 1, 16) AS id, CASE WHEN parent_part <> '' THEN substr(sha256(concat(trace_id, '|', parent_part)), 1, 16) END AS parent_id FROM ids)
"""


def _observations(spark, sf):
    t = tables(spark, sf)
    return O.traces(t.traces), O.observations(O.traces(t.traces), t.turns, t.tools, t.generations)


@check(_REGISTRY + "SELECT id, trace_id, type, parent_id, level, start_ms FROM obs")
def observation_registry(spark, sf):
    return _observations(spark, sf)[1].select("id", "trace_id", "type", "parent_id", "level", "start_ms")


@check(_REGISTRY + "SELECT o.id, o.trace_id, t.verdict FROM obs AS o JOIN (SELECT *, " + _TRACE + " AS tid FROM rolled) AS t ON t.tid = o.trace_id WHERE o.part = 'root'")
def prompt_is_root(spark, sf):
    traces, observations = _observations(spark, sf)
    roots = observations.where(F.col("name") == O.ROOT_NAME).select("id", "trace_id")
    return roots.join(traces.select(F.col("id").alias("trace_id"), "verdict"), "trace_id").select("id", "trace_id", "verdict")


@check(_REGISTRY + """, known AS (SELECT DISTINCT trace_id FROM obs WHERE substr(trace_id, 1, 1) <> '0'), have AS (SELECT id FROM obs WHERE substr(id, 1, 1) <> 'f')
  SELECT o.id, CASE WHEN h.id IS NOT NULL THEN o.parent_id WHEN o.part <> 'root' THEN substr(sha256(concat(o.trace_id, '|root')), 1, 16) END AS parent_id, k.trace_id IS NULL AS orphan
  FROM obs AS o LEFT JOIN known AS k ON k.trace_id = o.trace_id LEFT JOIN have AS h ON h.id = o.parent_id WHERE substr(o.id, 1, 1) <> 'f'""".replace("THEN o.parent_id WHEN", "AND k.trace_id IS NOT NULL THEN o.parent_id WHEN k.trace_id IS NULL THEN o.parent_id WHEN"))
def parent_resolution(spark, sf):
    """Some traces and some observations are left out, to give orphans and lost parents."""
    traces, observations = _observations(spark, sf)
    resolved, orphans = O.resolve_parents(observations.where("substr(id, 1, 1) <> 'f'"), traces.where("substr(id, 1, 1) <> '0'"))
    columns = ["id", "parent_id"]
    return resolved.select(*columns, F.lit(False).alias("orphan")).unionByName(orphans.select(*columns, F.lit(True).alias("orphan")))


@check(_REGISTRY + "SELECT o.id, o.trace_id, 'agent' AS trace_name, t.session_key AS session_id FROM obs AS o JOIN (SELECT *, " + _TRACE + " AS tid FROM rolled) AS t ON t.tid = o.trace_id")
def identity_propagation(spark, sf):
    traces, observations = _observations(spark, sf)
    named = traces.withColumnsRenamed({"name": "trace_name", "session_key": "session_id"})
    return O.propagate_identity(observations, named).select("id", "trace_id", "trace_name", "session_id")


_UPDATES = """SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN event_type END AS level, CASE WHEN event_id % 3 > 0 THEN event_type END AS name, concat('k', CAST(event_id % 4 AS STRING)) AS k1, concat('m', CAST(event_id % 5 AS STRING)) AS k2,
  CAST(event_id AS STRING) AS v FROM events"""


@check(f"""WITH u AS ({_UPDATES}), s AS (SELECT user_id, arg_max(level, event_id) FILTER (level IS NOT NULL) AS level, arg_max(name, event_id) FILTER (name IS NOT NULL) AS name FROM u GROUP BY user_id),
  e AS (SELECT user_id, event_id, k1 AS k, v FROM u UNION ALL SELECT user_id, event_id, k2, v FROM u), m AS (SELECT user_id, k, arg_max(v, event_id) AS v FROM e GROUP BY user_id, k)
  SELECT s.user_id, level, name, x.metadata FROM s JOIN (SELECT user_id, string_agg(concat(k, '=', v), ',' ORDER BY k) AS metadata FROM m GROUP BY user_id) AS x ON x.user_id = s.user_id""")
def update_merge(spark, sf):
    updates = V.run(spark, sf, _UPDATES).withColumn("metadata", F.create_map("k1", "v", "k2", "v"))
    merged = ordered.fold_updates(updates, ["user_id"], "event_id", ["level", "name"], ["metadata"])
    text = F.transform(F.array_sort(F.map_entries("metadata")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return merged.select("user_id", "level", "name", F.array_join(text, ",").alias("metadata"))
