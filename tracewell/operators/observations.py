"""Traces and observations: ids, parents, identity and updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .running import shuffled

ROOT_NAME = "agent.prompt"
TURN_NAME = "agent.turn"
GENERATION_NAME = "llm-response"
IDENTITY = ("trace_name", "session_id", "user_id", "tags", "version")


def trace_id() -> Column:
    return F.substring(
        F.sha2(F.concat_ws("|", "session_key", F.col("prompt_seq").cast("string")), 256), 1, 32
    )


def observation_id(trace: Column, kind: str, *parts: Column) -> Column:
    """Deterministic, so a rerun or a second engine finds the same observations."""
    texts = [p.cast("string") for p in parts]
    return F.substring(F.sha2(F.concat_ws("|", trace, F.lit(kind), *texts), 256), 1, 16)


def _root(trace: Column) -> Column:
    return observation_id(trace, "root")


def traces(rolled: DataFrame, name: str = "agent") -> DataFrame:
    """One trace per prompt; its root is the prompt observation of the same record."""
    return rolled.select(
        trace_id().alias("id"),
        "session_key",
        "prompt_seq",
        F.lit(name).alias("name"),
        F.col("prompt").alias("input"),
        "output",
        "start_ms",
        "end_ms",
        "verdict",
        "status_message",
        F.col("verdict").isin("failed", "abandoned").alias("is_error"),
    )


def observations(
    trace_rows: DataFrame, turn_rows: DataFrame, tool_rows: DataFrame, generation_rows: DataFrame
) -> DataFrame:
    """All observations of all traces: the prompt root, turns, generations, tools."""
    null_text = F.lit(None).cast("string")

    def shaped(df, id_, name, type_, parent, model=null_text, input_=null_text):
        return df.select(
            id_.alias("id"),
            trace_id().alias("trace_id"),
            F.lit(type_).alias("type"),
            name.alias("name"),
            parent.alias("parent_id"),
            "start_ms",
            "end_ms",
            input_.alias("input"),
            F.col("output").alias("output"),
            model.alias("model"),
            F.when(F.col("is_error"), "ERROR").otherwise("DEFAULT").alias("level"),
            "status_message",
        )

    trace = trace_id()
    turn = observation_id(trace, "turn", F.col("turn_index"))
    root = shaped(trace_rows, _root(trace), F.lit(ROOT_NAME), "SPAN", null_text, input_=F.col("input"))
    of_turns = shaped(turn_rows, turn, F.lit(TURN_NAME), "SPAN", _root(trace))
    of_tools = shaped(
        tool_rows,
        observation_id(trace, "tool", F.col("tool_call_id")),
        F.concat(F.lit("tool:"), F.col("tool_name")),
        "SPAN",
        F.when(F.col("turn_index").isNotNull(), turn).otherwise(_root(trace)),
        input_=F.col("args"),
    )
    of_generations = shaped(
        generation_rows.where("started"),
        observation_id(trace, "generation", F.col("turn_index"), F.col("generation")),
        F.lit(GENERATION_NAME),
        "GENERATION",
        turn,
        model=F.col("model"),
    )
    return root.unionByName(of_turns).unionByName(of_tools).unionByName(of_generations)


def resolve_parents(
    observation_rows: DataFrame, trace_rows: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The given parent if it exists, else the trace's root; and the observations of
    traces nobody registered."""
    known = shuffled(trace_rows.select(F.col("id").alias("trace_id")))
    orphans = observation_rows.join(known, "trace_id", "left_anti")
    parents = observation_rows.select(
        F.col("id").alias("parent_id"), F.lit(True).alias("__found")
    )
    is_root = F.col("name") == ROOT_NAME
    resolved = (
        observation_rows.join(known, "trace_id", "left_semi")
        .join(shuffled(parents), "parent_id", "left")
        .withColumn(
            "parent_id",
            F.when(F.col("__found"), F.col("parent_id")).when(~is_root, _root(F.col("trace_id"))),
        )
        .drop("__found")
    )
    return resolved, orphans


def propagate_identity(observation_rows: DataFrame, trace_rows: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Each observation with the identity columns of its trace.

    Traces are as many as prompts, so this is a shuffle join; a trace holding a large
    share of the observations is split by the adaptive skew join.
    """
    have = [c for c in identity if c in trace_rows.columns]
    side = trace_rows.select(F.col("id").alias("trace_id"), *have)
    return observation_rows.join(shuffled(side), "trace_id")
