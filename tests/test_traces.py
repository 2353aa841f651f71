from pyspark.sql import functions as F

from tracewell.plans.traces import build_traces
from tracewell.streaming import sessions as S


def events(spark, rows):
    """(seq, kind, values) rows of one session."""
    columns = ("session_key string, seq long, event_ms long, kind string, prompt string, turn_index int, "
               "request_key string, payload string, role string, delta_kind string, delta string, text string, "
               "stop_reason string, error_message string, tool_call_id string, tool_name string, args string, "
               "result string, is_error boolean, status int, system_prompt string, cwd string")
    names = [c.split()[0] for c in columns.split(", ")]
    data = [
        tuple({"session_key": "s", "seq": i, "event_ms": 1000 * (i + 1), "kind": kind, **values}.get(n) for n in names)
        for i, (kind, values) in enumerate(rows)
    ]
    return spark.createDataFrame(data, columns)


FLOW = [
    ("before_agent_start", {"prompt": "p"}),
    ("before_agent_start", {"prompt": "p"}),  # repeated: ignored
    ("turn_start", {"turn_index": 0}),
    ("before_provider_request", {"payload": "a"}),
    ("after_provider_response", {"status": 429}),
    ("after_provider_response", {"status": 200}),
    ("message_start", {"role": "assistant"}),
    ("message_update", {"role": "assistant", "delta_kind": "text_delta", "delta": "Hel"}),
    ("message_update", {"role": "assistant", "delta_kind": "text_delta", "delta": "lo"}),
    ("tool_call", {"tool_call_id": "t1", "tool_name": "bash", "args": "ls"}),
    ("tool_execution_end", {"tool_call_id": "t1", "tool_name": "bash", "result": "out", "is_error": False}),
    ("tool_execution_end", {"tool_call_id": "t1", "tool_name": "bash", "result": "late", "is_error": True}),
    ("tool_execution_start", {"tool_call_id": "t2", "tool_name": "read", "args": "f"}),
    ("message_end", {"role": "assistant"}),
    ("turn_end", {"turn_index": 0}),
    ("turn_start", {"turn_index": 0}),  # completed turn: ignored
    ("turn_start", {"turn_index": 1}),
    ("agent_end", {"text": "final answer"}),
    ("turn_start", {"turn_index": 2}),  # after the end: late
]


def test_batch_and_stream_agree_on_a_session(spark):
    source = events(spark, FLOW)
    t = build_traces(source)
    trace = t.traces.first()
    assert (trace.turns, trace.tool_calls, trace.tool_errors) == (2, 2, 0)
    assert (trace.verdict, trace.abandonment_reason, trace.output) == ("abandoned", "agent finalization", "final answer")
    tools = {r.tool_call_id: r for r in t.tools.collect()}
    assert (tools["t1"].status, tools["t1"].output, tools["t1"].turn_index) == ("completed", "out", 0)
    assert (tools["t2"].status, tools["t2"].is_error) == ("abandoned", True)
    generation = t.generations.first()
    assert generation.provider_statuses == [429, 200] and generation.provider_error
    assert (generation.output, generation.time_to_first_token_ms) == ("Hello", 4000)

    closed = S.run_to_table(S.closed_observations(S.as_stream(source, "flow")), "flow").collect()
    got = sorted((r.kind, r.id, r.parent or "", r.status, r.is_error) for r in closed)
    assert got == sorted([
        ("prompt", "0", "", "abandoned", True), ("turn", "0", "", "ended", False), ("turn", "1", "", "abandoned", True),
        ("tool", "t1", "0", "completed", False), ("tool", "t2", "0", "abandoned", True),
        ("generation", "turn:0:request:0", "0", "end", False),
    ])


def test_idle_prompt_closes_on_a_timer(spark):
    rows = [("before_agent_start", {"prompt": "p"}), ("turn_start", {"turn_index": 0})]
    first = events(spark, rows)
    other = events(spark, rows).withColumns({"session_key": F.lit("other"), "event_ms": F.col("event_ms") + 10_000_000})
    stream = S.as_stream(first.unionByName(other), "idle")
    closed = S.run_to_table(S.closed_observations(stream, "1 second", idle_ms=60_000), "idle").collect()
    assert {(r.session_key, r.kind, r.reason) for r in closed if r.kind == "prompt"} == {("s", "prompt", S.IDLE)}
