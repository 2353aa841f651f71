"""How trace tables are built: nothing that grows is broadcast, nothing unread is built."""

from pyspark.sql import functions as F

from tracewell.operators import observations as O, trace as T
from tracewell.operators.running import Running, running
from tracewell.plans import traces
from verification import fixtures as V

SF = "/root/testdata/sf0.001"


def test_tables_that_grow_are_never_broadcast(spark):
    t = traces.build_traces(V.random_stream(spark, SF))
    placed = T.resolve_turns(T.inside(t.assigned), t.spans)
    observed = O.observations(O.traces(t.traces), t.turns, t.tools, t.generations)
    named = O.propagate_identity(observed, O.traces(t.traces).withColumnRenamed("session_key", "session_id"))
    for df in (t.assigned, T.mark_boundaries(t.events), T.prompts(t.assigned), placed, t.turns, t.tools, t.generations, t.traces, named):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "BroadcastHashJoin" not in plan


def test_running_sorts_its_rows_once(spark):
    rows = spark.createDataFrame([("a", i) for i in range(9)], "k string, seq long")
    summed = running(rows, ["k"], ["seq"], {"n": Running("sum", F.lit(1))})
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert [r.n for r in summed.orderBy("seq").collect()] == list(range(1, 10))


def test_a_stage_is_built_when_it_is_read(spark, monkeypatch):
    built, write = [], traces.materialize
    monkeypatch.setattr(traces, "materialize", lambda df, label: built.append((label, df.columns)) or write(df, label))
    t = traces.build_traces(V.lifecycle(spark, SF))
    assert t.assigned.count() > 0
    assert [label for label, _ in built] == ["events", "marks", "placed"]
    assert t.traces.select("verdict").count() > 0
    texts = {"payload", "text", "delta", "args", "result", "output", "system_prompt"}
    assert not [label for label, columns in built if texts & set(columns)]


def test_random_stream_queries_broadcast_nothing(spark):
    """The join of assigned events with prompts, turns and tools is a shuffle, however small its files are."""
    t = traces.build_traces(V.random_stream(spark, SF))
    for df in (T.tool_texts(t._calls, t.events), T.turn_outputs(t.turn_verdicts, t.events), T.prompt_texts(t._prompts, t.events)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Broadcast" not in plan


def test_first_results_meet_no_events_of_other_kinds(spark):
    t = traces.build_traces(V.lifecycle(spark, SF))
    plan = t.first_results._jdf.queryExecution().optimizedPlan().toString()
    sides = plan.split("Join", 1)[1]
    assert sides.count("tool_result)") >= 2 and "Broadcast" not in plan
    wide = T.first_seen_results(t.assigned).select(*t.first_results.columns)
    assert wide.count() > 0 and sorted(map(str, wide.collect())) == sorted(map(str, t.first_results.collect()))
