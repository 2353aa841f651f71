"""Known secret values from a table, replaced by placeholders.

The values become automata that find all of them in one pass over a text, so the work doesn't
grow with their number.  They travel as broadcasts of checked size and stand in no plan, no
column expression and no event log.  A table beyond ``BLOCK_CHARACTERS`` makes several blocks,
the longest values first; each is a pass of its own, with the same result as one automaton.

The result is that of replacing the values one after another, the longest first (equally long
ones in their own order), each from the left.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..functions import patterns as P
from ..functions.redaction import placeholder

#: Characters of the values that one automaton holds at most (a longer value makes a block alone).
BLOCK_CHARACTERS = 2_000_000


class Block:
    """Values in the order in which they are replaced, with their marks."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.rows = rows
        self._automaton = None

    def __getstate__(self) -> dict:
        return {"rows": self.rows, "_automaton": None}  # each worker builds its own, once

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            built = ahocorasick.Automaton()
            for place, (value, _) in enumerate(self.rows):
                built.add_word(value, place)
            built.make_automaton()
            self._automaton = built
            # a value that may lie in a mark, or reach into one, can come up only when others are replaced
            self._nested = any("[" in v or "]" in v for v, _ in self.rows) or any(next(built.iter(m), None) for _, m in self.rows)
        return self._automaton

    def redact(self, text: str | None) -> str | None:
        if not text:
            return text
        automaton, done = self.automaton, -1
        while found := sorted({place for _, place in automaton.iter(text) if place > done}):
            for place in found[:1] if self._nested else found:
                text, done = text.replace(*self.rows[place]), place
            if not self._nested:
                break
        return text


def prepared(secrets: DataFrame) -> DataFrame:
    """Values to be replaced and their marks, from columns value and reason, in no order.

    Values are trimmed; those of 8 to 20,000 characters count.  Of the reasons of a repeated value
    the greatest names it; null values are left out, null reasons read as ``secret``.
    """
    value = F.regexp_replace(F.col("value").cast("string"), r"(?U)^\s+|\s+$", "")
    reason = F.coalesce(F.col("reason").cast("string"), F.lit(""))
    rows = secrets.select(value.alias("value"), reason.alias("reason"))
    fit = rows.filter(F.length("value").between(P.MIN_EXACT_SECRET_CHARS, P.MAX_EXACT_SECRET_CHARS))
    each = fit.groupBy("value").agg(F.max("reason").alias("reason"))
    return each.select("value", placeholder(F.col("reason"), F.col("value")).alias("mark"))


def blocks(secrets: DataFrame) -> list[Broadcast]:
    """The automata's values, a broadcast of bounded size each; the driver holds one block at a time."""
    context = secrets.sparkSession.sparkContext
    ordered = prepared(secrets).orderBy(F.desc(F.length("value")), "value")
    out, held, size = [], [], 0
    for row in ordered.toLocalIterator():
        if held and size + len(row.value) > BLOCK_CHARACTERS:
            out.append(context.broadcast(Block(held)))
            held, size = [], 0
        held.append((row.value, row.mark))
        size += len(row.value)
    if held:
        out.append(context.broadcast(Block(held)))
    return out


def redact_known(df: DataFrame, *columns: str, secrets: DataFrame) -> DataFrame:
    """Replace the table's values in string columns, or in the elements of arrays of strings, in place.

    Nulls stay; all other columns pass as they are.  A map over batches rather than a column
    expression: later projections can't be merged with it.
    """
    shared = blocks(secrets)
    if not shared or not columns:
        return df
    places = [df.columns.index(c) for c in columns]

    def redact(value: str | list | None) -> str | list | None:
        if isinstance(value, list):
            return [redact(v) for v in value]
        for block in shared:
            value = block.value.redact(value)
        return value

    def batches(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made = list(batch.columns)
            for place in places:
                made[place] = pa.array([redact(v) for v in made[place].to_pylist()], made[place].type)
            yield pa.RecordBatch.from_arrays(made, schema=batch.schema)

    return df.mapInArrow(batches, df.schema)
