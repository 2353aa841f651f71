"""Model generations of a turn: which request, answer and deltas belong together.

Which generation an event joins depends on what the earlier events of its turn did,
so that one step is a fold.  The fold sees control events only: the text deltas
between two of them, the bulk of the stream, are first counted as one run, and are
joined back to their generation afterwards.  Everything else is aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .ordered import concat_in_order
from .running import Running, running, shuffled
from .trace import EVENT, PROMPT, TURN, failure_kind, fingerprint, in_open_turn, inside

GENERATION = [*TURN, "generation"]
_KINDS = {
    "before_provider_request": "request",
    "after_provider_response": "response",
    "message_start": "start",
    "message_update": "delta",
    "message_end": "end",
}
TOKEN_DELTAS = ("text_delta", "thinking_delta")
#: What :func:`generation_spans` reads of routed events; texts stay with the events.
ROUTED = [
    *TURN, "seq", "event_ms", "step", "delta_kind", "status", "model", "is_error", "stop_reason",
    "error_message", "generation", "generation_key", "effect",
]
NO_KEY = ""


def generation_events(assigned: DataFrame, turn_rows: DataFrame, last: int | None = None) -> DataFrame:
    """Events about generations with the turn they belong to and their role in it."""
    kind = F.col("kind")
    about = kind.isin(*_KINDS) & (
        ~kind.startswith("message") | (F.col("role") == "assistant")
    )
    events = _with_fingerprint(inside(assigned).where(about))
    placed = in_open_turn(events, turn_rows, last)
    step = F.when((kind == "message_update") & (F.col("delta_kind") == "error"), F.lit("error"))
    for name, short in _KINDS.items():
        step = step.when(kind == name, F.lit(short))
    return _follow_request_key(placed, turn_rows).withColumns(
        {"step": step, "request_key": F.coalesce(F.col("request_key"), F.lit(NO_KEY))}
    )


def _with_fingerprint(events: DataFrame) -> DataFrame:
    """Payloads stay behind: what tells them apart is a digest."""
    return events if "fingerprint" in events.columns else events.withColumn("fingerprint", fingerprint(F.col("payload")))


def _follow_request_key(placed: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """A request key leads to the turn it was first seen in, as long as that is open."""
    keyed = placed.where(F.col("request_key").isNotNull() & (F.col("request_key") != ""))
    homes = (
        keyed.groupBy(*PROMPT, "request_key")
        .agg(F.min_by("turn_index", "seq").alias("turn_index"))
        .join(shuffled(turn_rows.select(*TURN, F.col("end_seq").alias("__home_end"))), TURN)
        .withColumnRenamed("turn_index", "__home")
    )
    joined = placed.join(shuffled(homes), [*PROMPT, "request_key"], "left")
    open_home = F.col("__home").isNotNull() & (
        F.col("__home_end").isNull() | (F.col("seq") < F.col("__home_end"))
    )
    return joined.withColumn(
        "turn_index", F.when(open_home, F.col("__home")).otherwise(F.col("turn_index"))
    ).select(*placed.columns)


class TurnRouter:
    """Keeps the generations of one turn while its events pass by."""

    def __init__(self, turn_index: int):
        self.turn_index = turn_index
        self.keys: list[str] = []
        self.prints: list[str | None] = []
        self.started: list[bool] = []
        self.ended: list[bool] = []
        self.named = 0
        self.message_ended = False

    def _new(self, key: str, fingerprint: str | None = None) -> int:
        if not key:
            key = f"turn:{self.turn_index}:request:{self.named}"
            self.named += 1
        self.keys.append(key)
        self.prints.append(fingerprint)
        self.started.append(False)
        self.ended.append(False)
        return len(self.keys) - 1

    def _latest(self, wanted) -> int | None:
        return next((g for g in reversed(range(len(self.keys))) if wanted(g)), None)

    def _find(self, key: str) -> int:
        if key:
            return self.keys.index(key) if key in self.keys else self._new(key)
        for wanted in (
            lambda g: not self.ended[g] and not self.started[g],
            lambda g: not self.ended[g],
            lambda g: self.ended[g],
        ):
            found = self._latest(wanted)
            if found is not None:
                return found
        return self._new("")

    def take(
        self, step: str, key: str, fingerprint: str | None, count: int
    ) -> Iterator[tuple[int, int, str]]:
        """Yield (generation, how many of the events, effect) for a run of like events."""
        if step == "request":
            if key:
                found = self._find(key)
            else:
                latest = self._latest(lambda g: not self.ended[g])
                same = latest is not None and fingerprint and self.prints[latest] == fingerprint
                found = latest if same else self._new("", fingerprint)
            yield found, count, "join"
            return
        if step == "end":
            if self.message_ended:
                yield -1, count, "ignored"
                return
            self.message_ended = True
        while count > 0:
            found = self._find(key)
            pending = not self.started[found]
            self.started[found] = True
            taken = 1 if pending else count
            effect = "ignored" if self.ended[found] else "join"
            if step in ("end", "error") and not self.ended[found]:
                self.ended[found] = True
                effect = step
            yield found, taken, effect
            count -= taken


_ROUTES = (
    "session_key string, prompt_seq bigint, turn_index int, run bigint, step string, "
    "request_key string, from_position bigint, to_position bigint, "
    "generation int, generation_key string, effect string"
)


def _route_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Route steps that come sorted by turn and order; only the current turn is kept."""
    turn, router = None, None
    names = [c.split()[0] for c in _ROUTES.split(", ")]
    for steps in batches:
        out = []
        for row in steps.itertuples(index=False):
            here = (row.session_key, row.prompt_seq, row.turn_index)
            if here != turn:
                turn, router = here, TurnRouter(int(row.turn_index))
            position = row.from_position
            for generation, count, effect in router.take(
                row.step, row.request_key, row.fingerprint, int(row.events)
            ):
                key = router.keys[generation] if generation >= 0 else None
                out.append(
                    (
                        *here, row.run, row.step, row.request_key, position,
                        position + count - 1, generation, key, effect,
                    )
                )
                position += count
        yield pd.DataFrame(out, columns=names)


def route(events: DataFrame) -> DataFrame:
    """``events`` of :func:`generation_events` with generation, its key and the effect:
    join, end, error (ends it), or ignored."""
    is_delta = F.col("step") == "delta"
    placed = running(
        _with_fingerprint(events),
        TURN,
        ["seq"],
        {
            "run": Running("sum", F.when(is_delta, 0).otherwise(1)),
            "position": Running("sum", F.when(is_delta, 1).otherwise(0)),
        },
    ).withColumns({"run": F.col("run").cast("bigint"), "position": F.col("position").cast("bigint")})
    steps = placed.groupBy(*TURN, "run", "step", "request_key").agg(
        F.min("seq").alias("first_seq"),
        F.min("position").alias("from_position"),
        F.count("*").alias("events"),
        F.min_by("fingerprint", "seq").alias("fingerprint"),
    )
    # Turns stream through a task one after the other, whatever their size.
    routes = (
        steps.repartition(*TURN)
        .sortWithinPartitions(*TURN, "first_seq")
        .mapInPandas(_route_sorted, _ROUTES)
    )
    joined = placed.join(shuffled(routes), [*TURN, "run", "step", "request_key"])
    in_range = ~is_delta | F.col("position").between(F.col("from_position"), F.col("to_position"))
    return joined.where(in_range).select(
        *events.columns, "generation", "generation_key", "effect"
    )


def collapse_retries(requests: DataFrame) -> DataFrame:
    """Requests without keys that repeat the latest open one are the same generation:
    add ``generation`` as a running count of the ones that differ."""
    marked = running(
        _with_fingerprint(requests),
        TURN,
        ["seq"],
        {"__before": Running("last", F.col("fingerprint"), exclusive=True)},
    ).withColumn("__new", (~F.col("fingerprint").eqNullSafe(F.col("__before"))).cast("int"))
    counted = running(marked, TURN, ["seq"], {"generation": Running("sum", F.col("__new"))})
    return counted.select(*requests.columns, (F.col("generation") - 1).cast("int").alias("generation"))


def stream_texts(routed: DataFrame, events: DataFrame) -> DataFrame:
    """Text and thinking of each generation, its deltas since the message began joined in order."""
    joins = routed.where(F.col("effect") == "join")
    began = joins.where(F.col("step") == "start").groupBy(*GENERATION).agg(F.max("seq").alias("__began"))
    deltas = joins.where(F.col("step") == "delta").join(shuffled(began), GENERATION, "left")
    deltas = deltas.where(F.col("__began").isNull() | (F.col("seq") > F.col("__began"))).select(*GENERATION, "seq", "delta_kind")
    texts = events.where(F.col("kind") == "message_update").select(*EVENT, "delta")
    deltas = texts.join(shuffled(deltas), EVENT)

    def of(kind: str) -> Column:
        return F.when(F.col("delta_kind") == kind, F.col("delta"))

    return concat_in_order(
        deltas,
        GENERATION,
        "seq",
        {"stream_text": of("text_delta"), "stream_thinking": of("thinking_delta")},
    )


def input_snapshots(assigned: DataFrame) -> DataFrame:
    """What each request was given: the latest context before it, else the prompt."""
    kind = F.col("kind")
    events = inside(assigned).where(kind.isin("context", "before_provider_request") | F.col("starts"))
    value = F.when(kind == "context", F.col("text")).when(F.col("starts"), F.col("prompt"))
    filled = running(events, PROMPT, ["seq"], {"input": Running("last", value)})
    return filled.where(kind == "before_provider_request").select(*PROMPT, "seq", "input")


def final_output(message: Column, thinking: Column, text: Column) -> Column:
    """The message text, else the streamed thinking and text."""
    streamed = F.concat(F.coalesce(thinking, F.lit("")), F.coalesce(text, F.lit("")))
    return F.coalesce(F.nullif(F.trim(message), F.lit("")), streamed)


def time_to_first_token(first_token_ms: Column, start_ms: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), first_token_ms - start_ms)


def generations(routed: DataFrame, turn_rows: DataFrame, events: DataFrame) -> DataFrame:
    """One row per generation: request, provider answers, first token, output, end."""
    return generation_texts(generation_spans(routed, turn_rows), routed, events)


def generation_spans(routed: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """The generations without texts and usage; ``texts`` holds the events that have them."""
    step, effect = F.col("step"), F.col("effect")
    live = routed.where(effect != "ignored")
    is_end = effect == "end"

    def first(value, when: Column) -> Column:
        return F.min_by(value, F.when(when, F.col("seq")))

    def last(value, when: Column) -> Column:
        return F.max_by(value, F.when(when, F.col("seq")))

    has_status = (step == "response") & F.col("status").isNotNull()
    token = (step == "delta") & F.col("delta_kind").isin(*TOKEN_DELTAS)
    grouped = live.groupBy(*GENERATION).agg(
        F.min("generation_key").alias("request_key"),
        F.min("seq").alias("start_seq"),
        F.min_by("event_ms", "seq").alias("start_ms"),
        F.max(step != "request").alias("started"),
        last("model", (step == "request") & F.col("model").isNotNull()).alias("request_model"),
        F.max(F.when(step == "request", F.col("seq"))).alias("__payload"),
        last("status", has_status).alias("provider_status"),
        F.array_sort(
            F.collect_list(F.when(has_status, F.struct("seq", "status")))
        ).alias("__statuses"),
        F.max((step == "response") & F.coalesce((F.col("status") >= 400) | F.col("is_error"), F.col("is_error"), F.lit(False))).alias("provider_error"),
        F.min(F.when(token, F.col("event_ms"))).alias("__token_ms"),
        F.min(F.when(effect.isin("end", "error"), F.col("seq"))).alias("end_seq"),
        first("event_ms", effect.isin("end", "error")).alias("end_ms"),
        F.max(effect == "error").alias("stream_error"),
        first("error_message", effect == "error").alias("stream_message"),
        first(
            F.struct("seq", "model", "stop_reason", "error_message", "is_error"), is_end
        ).alias("m"),
    )
    joined = grouped.join(
        shuffled(turn_rows.select(*TURN, F.col("end_seq").alias("__turn_end"), F.col("end_ms").alias("__turn_ms"))),
        TURN,
        "left",
    )
    ended, cut = F.col("end_seq").isNotNull(), F.col("__turn_end").isNotNull()
    m = F.col("m")
    failure = failure_kind(m["stop_reason"])
    flagged = (failure == "error") | F.coalesce(m["is_error"], F.lit(False))
    failed_text = F.when(
        F.col("provider_status").isNotNull(),
        F.concat(F.lit("provider response failed ("), F.col("provider_status").cast("string"), F.lit(")")),
    ).otherwise(F.lit("provider response failed"))
    status = (
        F.when(F.col("stream_error"), F.coalesce(F.col("stream_message"), F.lit("provider response failed")))
        .when(~ended & cut, F.lit("generation abandoned during prompt finalization"))
        .when(failure.isNotNull() & m["error_message"].isNotNull(), m["error_message"])
        .when(flagged, failed_text)
        .when(failure == "aborted", F.lit("provider response aborted"))
    )
    stop_ms = F.coalesce(F.col("end_ms"), F.col("__turn_ms"))
    return joined.select(
        *GENERATION,
        "request_key",
        "start_seq",
        "start_ms",
        stop_ms.alias("end_ms"),
        (stop_ms - F.col("start_ms")).alias("duration_ms"),
        "started",
        F.coalesce(F.nullif(m["model"], F.lit("")), F.col("request_model")).alias("model"),
        "provider_status",
        F.transform(F.col("__statuses"), lambda s: s["status"]).alias("provider_statuses"),
        F.coalesce(F.col("provider_error"), F.lit(False)).alias("provider_error"),
        time_to_first_token(F.col("__token_ms"), F.col("start_ms")).alias("time_to_first_token_ms"),
        F.struct(
            F.col("__payload").alias("payload"), m["seq"].alias("message"), (ended & ~F.col("stream_error")).alias("said")
        ).alias("texts"),
        (~ended & cut).alias("abandoned"),
        (~ended & ~cut).alias("open"),
        (F.col("stream_error") | (~ended & cut) | F.coalesce(flagged | failure.isNotNull(), F.lit(False))).alias("is_error"),
        status.alias("status_message"),
    )


def generation_texts(spans: DataFrame, routed: DataFrame, all_events: DataFrame) -> DataFrame:
    """Replace ``texts`` of :func:`generation_spans` by payload, usage, streamed texts and output."""
    wanted = spans.select(
        *GENERATION, "texts", F.explode(F.array("texts.payload", "texts.message")).alias("seq")
    ).where(F.col("seq").isNotNull())
    events = (
        all_events.where(F.col("kind").isin("before_provider_request", "message_end"))
        .select(*EVENT, "payload", "text", "usage")
    )

    def of(column: str, seq: str) -> Column:
        return F.max(F.when(F.col("seq") == F.col(f"texts.{seq}"), F.col(column))).alias(column)

    found = (
        events.join(shuffled(wanted), EVENT)
        .groupBy(*GENERATION)
        .agg(of("payload", "payload"), of("text", "message"), of("usage", "message"))
    )
    joined = spans.join(shuffled(found), GENERATION, "left").join(
        shuffled(stream_texts(routed, all_events)), GENERATION, "left"
    )
    output = final_output(F.col("text"), F.col("stream_thinking"), F.col("stream_text"))
    return joined.select(
        *[c for c in spans.columns if c != "texts"],
        "payload",
        F.when(F.col("texts.said"), output).alias("output"),
        "stream_text",
        "stream_thinking",
        "usage",
    )


def unfinished_turns(generation_rows: DataFrame, turn_rows: DataFrame) -> DataFrame:
    """Turns that ended by themselves before one of their generations did."""
    ended = turn_rows.where(~F.col("abandoned") & ~F.col("open")).select(*TURN)
    cut = generation_rows.where("abandoned").select(*TURN).distinct()
    return cut.join(shuffled(ended), TURN, "left_semi")


def generation_scores(generation_rows: DataFrame) -> DataFrame:
    """Input and output tokens if not zero, the total cost if there is one."""
    usage = F.col("usage")
    wide = generation_rows.select(
        *GENERATION,
        F.nullif(usage["input"], F.lit(0).cast("bigint")).cast("double").alias("input_tokens"),
        F.nullif(usage["output"], F.lit(0).cast("bigint")).cast("double").alias("output_tokens"),
        usage["cost"]["total"].alias("total_cost"),
    )
    return wide.unpivot(
        GENERATION, ["input_tokens", "output_tokens", "total_cost"], "name", "value"
    ).where(F.col("value").isNotNull())


def requests_per_turn(requests: DataFrame, size: Column) -> DataFrame:
    """The requests of each turn in order, as (event_ms, size, model)."""
    return requests.groupBy(*TURN).agg(
        F.array_sort(
            F.collect_list(
                F.struct("seq", "event_ms", size.cast("bigint").alias("payload_size"), "model")
            )
        ).alias("requests")
    )
