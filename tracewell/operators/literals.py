"""JSON texts that VARIANT would refuse or print otherwise, made fit for the tree walk.

A record may repeat a key (the last one counts) and hold numbers that VARIANT rewrites.
Such texts, a small share of the lines, are parsed and written anew in Arrow batches:
repeated keys are dropped, and numbers become marked strings that the walk takes for
numbers and prints as they stood.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F

from . import outline

#: A private-use character and a sign in front of a number's literal.
MARK = "\ue000#"
#: Numbers that VARIANT may print otherwise: many digits, exponents, zeros at the end of a fraction.
REWRITTEN = r"[0-9][0-9.]{15,}|[0-9][eE][-+]?[0-9]|\.[0-9]*0(?![0-9])"


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


class _Number(str):
    """The literal of a number."""


def _guarded(value):
    """Mark numbers; a string that already looks marked gets one more mark character."""
    if isinstance(value, _Number):
        return MARK + value
    if isinstance(value, str):
        return MARK[0] + value if value.startswith(MARK[0]) else value
    if isinstance(value, dict):
        return {_guarded(k): _guarded(v) for k, v in value.items()}
    return [_guarded(v) for v in value] if isinstance(value, list) else value


def plain_json(text: str) -> str | None:
    """The text without repeated keys and with marked numbers; None if it is no JSON or nested too deep to read."""
    try:
        value = json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_refuse)
        return json.dumps(_guarded(value), separators=(",", ":"))
    except (ValueError, RecursionError):
        return None


def _plain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(plain_json, na_action="ignore").astype(object)


def outside_strings(json_text: Column) -> Column:
    """A JSON text with all its strings emptied."""
    return F.regexp_replace(F.regexp_replace(json_text, r"\\.", ""), '"[^"]*"', '""')


def has_odd_numbers(json_text: Column) -> Column:
    """Whether a JSON text has a number that VARIANT may print otherwise.

    What looks like one in a string, as in ids and times, is none; strings are only taken out
    of texts that seem to have one.
    """
    return F.when(json_text.rlike(REWRITTEN), outside_strings(json_text).rlike(REWRITTEN)).otherwise(F.lit(False))


def prepared(text: Column) -> Column:
    """``text``, or where VARIANT refuses or rewrites it, its plain form; null for what is no JSON."""
    parses = F.try_parse_json(text).isNotNull()
    fit = parses & ~has_odd_numbers(text) & ~text.contains(MARK[0]) & ~text.rlike(r"\\u[eE]000")
    opens = F.ltrim(text).rlike(r"^[\[{\"0-9-]")
    anew = F.pandas_udf(_plain, "string")(F.when(~fit & opens, text))
    return F.when(fit, text).otherwise(anew)


#: In front of a member's name: a private-use character and the member's number in its object.
PLACE, PLACE_DIGITS = "\ue001", 8


def _numbered(value):
    """Members by number, numbers marked, strings that look marked with one more mark character."""
    if isinstance(value, outline.Literal):
        return MARK + value
    if isinstance(value, str):
        return MARK[0] + value if value.startswith(MARK[0]) else value
    if isinstance(value, dict):
        return {f"{PLACE}{i:0{PLACE_DIGITS}}{k}": _numbered(v) for i, (k, v) in enumerate(outline.members(value, by_name=False))}
    return [_numbered(v) for v in value] if isinstance(value, list) else value


def numbered_json(text: str | None) -> str | None:
    """The text with marked numbers and with names that sort in document order; None if it is no JSON or nested too deep for a VARIANT."""
    try:
        return None if text is None else json.dumps(_numbered(outline.parse(text)), separators=(",", ":"))
    except (ValueError, RecursionError):
        return None


def numbered(text: Column) -> Column:
    """:func:`numbered_json` in Arrow batches."""

    def batch(texts: pa.Array) -> pa.Array:
        return pa.array([numbered_json(t) for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(batch, "string")(text)


def name_of(key: Column) -> Column:
    """A numbered member's name."""
    return F.substring(key, PLACE_DIGITS + 2, 2**31 - 1)


def without_places(json_text: Column) -> Column:
    """A numbered JSON text as it stood: names without numbers, numbers without marks."""
    names = F.regexp_replace(json_text, f"{PLACE}[0-9]{{{PLACE_DIGITS}}}", "")
    return F.regexp_replace(names, f'"{MARK}([^"]*)"', "$1")


def is_marked(string: Column) -> Column:
    return F.coalesce(F.startswith(string, F.lit(MARK)), F.lit(False))


def literal(string: Column) -> Column:
    """The number behind the mark."""
    return F.substring(string, len(MARK) + 1, 2**31 - 1)


def unguarded(json_text: Column) -> Column:
    """Strings that looked marked, as they stood."""
    return F.when(json_text.contains(f'"{MARK[0]}{MARK[0]}'), F.replace(json_text, F.lit(f'"{MARK[0]}{MARK[0]}'), F.lit(f'"{MARK[0]}'))).otherwise(json_text)
