"""Traces from a live event stream.

Per-session state follows the open prompt, its turns, generations and tools, and
emits each of them once, when it closes.  A prompt left without events closes on an
event-time timer.  The batch form of the same rules is ``plans.traces``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.generations import TurnRouter
from ..operators.trace import CLOSING_REASONS, FAILURES, OPEN_GENERATION, PENDING, PROMPT_START, REPLACED
from ..plans.workspace import shared_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CLOSED = (
    "session_key string, prompt_seq bigint, kind string, id string, parent string, "
    "start_ms bigint, end_ms bigint, status string, is_error boolean, reason string"
)
_FIELDS = [part.split()[0] for part in CLOSED.split(", ")]
IDLE = "session idle"
_INPUT = (
    "session_key", "seq", "event_ms", "event_time", "kind", "prompt", "system_prompt", "cwd",
    "turn_index", "request_key", "payload", "role", "delta_kind", "stop_reason",
    "tool_call_id", "is_error",
)
_GENERATION_STEPS = {
    "before_provider_request": "request",
    "after_provider_response": "response",
    "message_start": "start",
    "message_update": "delta",
    "message_end": "end",
}


def _text(value) -> str | None:
    return None if value is None or value != value else str(value)


class SessionTracker:
    """The open prompt of one session; ``take`` returns what an event closes."""

    def __init__(self, state: dict | None, tools):
        self.state = state or {}
        self.tools = tools

    def _close(self, kind, id_, parent, start_ms, end_ms, status, is_error, reason=None):
        return (
            self.session_key, self.state["seq"], kind, id_, parent, start_ms, end_ms, status,
            is_error, reason,
        )

    def take(self, row) -> Iterator[tuple]:
        self.session_key = row.session_key
        kind, ms = row.kind, int(row.event_ms)
        if kind == PROMPT_START:
            signature = json.dumps([_text(row.prompt) or "", _text(row.system_prompt) or "", _text(row.cwd) or ""])
            if self.state and self.state["signature"] == signature:
                return
            yield from self.finish(ms, REPLACED)
            self.state = {
                "seq": int(row.seq), "start": ms, "signature": signature, "turns": {},
                "done": [], "failure": None, "cut": False,
            }
        elif kind in CLOSING_REASONS:
            failure = _text(row.stop_reason)
            if kind == "agent_end" and failure in FAILURES and self.state:
                self.state["failure"] = failure
            yield from self.finish(ms, CLOSING_REASONS[kind])
        elif self.state:
            yield from self._inside(row, kind, ms)

    def _inside(self, row, kind, ms) -> Iterator[tuple]:
        turns = self.state["turns"]
        index = None if row.turn_index != row.turn_index or row.turn_index is None else str(int(row.turn_index))
        if kind == "turn_start":
            if index not in turns and index not in self.state["done"]:
                turns[index] = {"start": ms, "router": None, "spans": {}, "failure": None}
        elif kind == "turn_end":
            if index not in turns:
                self.state["done"].append(index)
                return
            turn = turns.pop(index)
            self.state["done"].append(index)
            failure = _text(row.stop_reason)
            failure = failure if failure in FAILURES else turn["failure"]
            if failure:
                self.state["failure"] = self.state["failure"] or failure
            open_left = yield from self._cut_generations(index, turn, ms)
            self.state["cut"] = self.state["cut"] or open_left
            yield self._close("turn", index, None, turn["start"], ms, "ended", bool(failure))
        elif kind in _GENERATION_STEPS and (not kind.startswith("message") or row.role == "assistant"):
            yield from self._generation(row, kind, ms, index)
        elif kind.startswith("tool"):
            yield from self._tool(row, kind, ms)

    def _turn_of(self, key, index):
        turns = self.state["turns"]
        if key:
            for name in reversed(turns):
                router = turns[name]["router"]
                if router and key in router["keys"]:
                    return name
        if index is not None:
            return index if index in turns else None
        return next(reversed(turns), None)

    def _generation(self, row, kind, ms, index) -> Iterator[tuple]:
        key = _text(row.request_key) or ""
        name = self._turn_of(key, index)
        if name is None:
            return
        turn = self.state["turns"][name]
        router = TurnRouter(int(name))
        router.__dict__.update(turn["router"] or {})
        step = "error" if row.delta_kind == "error" and kind == "message_update" else _GENERATION_STEPS[kind]
        first_end = step == "end" and not router.message_ended
        for number, _, effect in router.take(step, key, _text(row.payload), 1):
            if number < 0:
                continue
            span = turn["spans"].setdefault(str(number), {"start": ms, "end": None})
            if effect in ("end", "error"):
                span["end"] = ms
                failed = effect == "error" or _text(row.stop_reason) in FAILURES or row.is_error is True
                yield self._close(
                    "generation", router.keys[number], name, span["start"], ms, effect, bool(failed)
                )
        failure = _text(row.stop_reason)
        if first_end and failure in FAILURES:
            turn["failure"] = failure
            self.state["failure"] = self.state["failure"] or failure
        turn["router"] = dict(router.__dict__)

    def _cut_generations(self, name, turn, ms):
        left = False
        for number, span in turn["spans"].items():
            if span["end"] is None:
                left = True
                if not turn["router"]["started"][int(number)]:
                    continue
                key = turn["router"]["keys"][int(number)]
                yield self._close("generation", key, name, span["start"], ms, "abandoned", True)
        return left

    def _tool(self, row, kind, ms) -> Iterator[tuple]:
        id_ = row.tool_call_id
        tool = self.tools.get(id_) or {
            "start": ms, "turn": next(reversed(self.state["turns"]), None), "result": None, "ended": False,
        }
        is_error = row.is_error is True
        if kind == "tool_result" and not tool["ended"]:
            tool["result"] = is_error
        if kind == "tool_execution_end" and not tool["ended"]:
            tool["ended"] = True
            yield self._close("tool", id_, tool["turn"], tool["start"], ms, "completed", is_error)
        self.tools.put(id_, tool)

    def finish(self, ms, reason) -> Iterator[tuple]:
        """Close the open prompt: its tools, then generations, then turns, then itself."""
        if not self.state:
            return
        pending = False
        for id_, tool in self.tools.items():
            if tool["ended"]:
                continue
            resulted = tool["result"] is not None
            pending = pending or not resulted
            yield self._close(
                "tool", id_, tool["turn"], tool["start"], ms,
                "result-only" if resulted else "abandoned", tool["result"] if resulted else True,
            )
        for name, turn in self.state["turns"].items():
            pending = True
            yield from self._cut_generations(name, turn, ms)
            yield self._close("turn", name, None, turn["start"], ms, "abandoned", True)
        reason = reason or (OPEN_GENERATION if self.state["cut"] else None) or (PENDING if pending else None)
        failure = self.state["failure"]
        status = "failed" if failure else "abandoned" if reason else "completed"
        yield self._close(
            "prompt", str(self.state["seq"]), None, self.state["start"], ms, status,
            bool(failure or reason), reason,
        )
        self.tools.clear()
        self.state = {}


class _ToolState:
    """Tools of the open prompt in a map state: an event touches its own tool only."""

    def __init__(self, state):
        self.state = state

    def get(self, id_):
        return json.loads(self.state.getValue((id_,))[0]) if self.state.containsKey((id_,)) else None

    def put(self, id_, tool):
        self.state.updateValue((id_,), (json.dumps(tool),))

    def items(self):
        for key, value in list(self.state.iterator()):
            yield key[0], json.loads(value[0])

    def clear(self):
        self.state.clear()


class SessionProcessor(StatefulProcessor):
    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.session = handle.getValueState("session", "data string")
        self.tools = _ToolState(handle.getMapState("tools", "id string", "data string"))

    def _tracker(self, key) -> SessionTracker:
        state = json.loads(self.session.get()[0]) if self.session.exists() else None
        tracker = SessionTracker(state, self.tools)
        tracker.session_key = key[0]
        return tracker

    def _leave(self, tracker, closed) -> Iterator[pd.DataFrame]:
        if tracker.state:
            self.session.update((json.dumps(tracker.state),))
        else:
            self.session.clear()
        if closed:
            yield pd.DataFrame(closed, columns=_FIELDS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        tracker, closed = self._tracker(key), []
        events = pd.concat(list(rows)).sort_values("seq")
        events = events.astype(object).where(events.notna(), None)
        for row in events.itertuples(index=False):
            closed.extend(tracker.take(row))
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if tracker.state:
                self.handle.registerTimer(int(events["event_ms"].iloc[-1]) + self.idle_ms)
        yield from self._leave(tracker, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        tracker = self._tracker(key)
        closed = list(tracker.finish(int(expiredTimerInfo.getExpiryTimeInMs()), IDLE))
        yield from self._leave(tracker, closed)

    def close(self) -> None:
        pass


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", F.timestamp_millis("event_ms"))


def closed_observations(
    events: DataFrame, watermark: str = "1 hour", idle_ms: int | None = None
) -> DataFrame:
    """Observations of a streaming event table, each emitted when it closes."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        events.withWatermark("event_time", watermark)
        .select(*_INPUT)
        .groupBy("session_key")
        .transformWithStateInPandas(
            SessionProcessor(idle_ms), CLOSED, outputMode="Append", timeMode="EventTime"
        )
    )


def first_results(events: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """The first result of each tool call; repeats within the watermark are dropped."""
    return (
        events.where("kind = 'tool_result' AND tool_call_id IS NOT NULL")
        .withWatermark("event_time", watermark)
        .dropDuplicatesWithinWatermark(["session_key", "tool_call_id"])
    )


def as_stream(events: DataFrame, label: str) -> DataFrame:
    """A table replayed as a stream: written to shared storage, read as it comes."""
    spark = events.sparkSession
    folder = f"{shared_folder(spark)}/{label}-in-{uuid.uuid4().hex}"
    timed = with_event_time(events)
    timed.write.parquet(folder)
    return spark.readStream.schema(timed.schema).parquet(folder)


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is available and return the table it wrote."""
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/{label}-out-{uuid.uuid4().hex}"
    query = (
        stream.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", f"{folder}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(folder)
