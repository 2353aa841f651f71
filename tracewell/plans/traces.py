"""From lifecycle events to finished trace tables, stage by stage."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..operators import generations as G, trace as T
from .workspace import materialize


class TraceTables:
    """The trace tables of an event table, each built when it is first read.

    What is kept as a stage is narrow: keys, times, verdicts, and of texts the numbers of the events
    that hold them.  The texts are joined to a table where they are read, so a table that nobody
    reads, or a text that nobody selects, is neither built, shuffled nor written.
    """

    def __init__(self, events: DataFrame):
        self.events = event_defaults(events)

    @cached_property
    def placed(self) -> DataFrame:
        """``assigned`` with the short columns only."""
        slim = materialize(T.slim_events(self.events), "events")
        marks = materialize(T.mark_boundaries(slim), "marks")
        return materialize(T.assign_prompts(slim, marks), "placed")

    @cached_property
    def last(self) -> int:
        """The greatest ``seq``, to which the tree of open turns goes."""
        return self.placed.agg(F.max("seq")).first()[0] or 0

    @cached_property
    def assigned(self) -> DataFrame:
        return T.with_prompts(self.events, self.placed)

    @cached_property
    def _prompts(self) -> DataFrame:
        return materialize(T.prompt_spans(self.placed), "prompts")

    @cached_property
    def prompts(self) -> DataFrame:
        return T.prompt_texts(self._prompts, self.events)

    @cached_property
    def spans(self) -> DataFrame:
        return materialize(T.turn_spans(self.placed, self._prompts), "turns")

    @cached_property
    def _first_ends(self) -> DataFrame:
        return materialize(T.first_message_ends(self.placed, self.spans, self.last), "message-ends")

    @cached_property
    def message_ends(self) -> DataFrame:
        return T.message_texts(self._first_ends, self.events)

    @cached_property
    def turn_verdicts(self) -> DataFrame:
        """``turns`` without output and usage."""
        return T.turn_records(self.spans, self._first_ends)

    @cached_property
    def turns(self) -> DataFrame:
        return T.turn_outputs(self.turn_verdicts, self.events)

    @cached_property
    def _calls(self) -> DataFrame:
        return materialize(T.tool_calls(self.placed, self._prompts, self.spans, last=self.last), "tools")

    @cached_property
    def tools(self) -> DataFrame:
        return T.tool_texts(self._calls, self.events)

    @cached_property
    def first_results(self) -> DataFrame:
        return T.first_results(self.placed, self.events)

    @cached_property
    def _routed(self) -> DataFrame:
        routed = G.route(G.generation_events(self.placed, self.spans, self.last))
        return materialize(routed.select(*G.ROUTED), "routed")

    @cached_property
    def _generations(self) -> DataFrame:
        return materialize(G.generation_spans(self._routed, self.spans), "generations")

    @cached_property
    def generations(self) -> DataFrame:
        return G.generation_texts(self._generations, self._routed, self.events)

    @cached_property
    def cut_generations(self) -> DataFrame:
        """The abandoned ones of ``generations``, without texts and usage."""
        return self._generations.where("abandoned")

    @cached_property
    def traces(self) -> DataFrame:
        unfinished = G.unfinished_turns(self._generations, self.spans)
        return T.rollup(self.assigned, self.prompts, self.spans, self._calls, self.message_ends, unfinished)


def build_traces(events: DataFrame) -> TraceTables:
    """All trace tables of an event table; (session_key, seq) tells its events apart."""
    return TraceTables(events)


def event_defaults(events: DataFrame) -> DataFrame:
    """Events with every column of the event model, missing ones as null."""
    missing = {
        name: F.lit(None).cast(type_)
        for name, type_ in T.EVENT_COLUMNS.items()
        if name not in events.columns
    }
    return events.withColumns(missing) if missing else events
