"""JSON texts as templates: what stays as it is, and the holes that redaction fills.

A line is read once, in Arrow batches and without recursion, so any depth and size will do.  It
becomes the pieces of JSON around its string leaves and its members with secret names, and
these as an array beside; the strings then go through the text redaction as a column, and
the filled pieces are joined.  Numbers stay as they stand, and of repeated keys the last counts.
A line that is no JSON is one hole, so that all lines take the same passes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.redaction import blob_placeholder, hides_value, is_sensitive_key, json_string, placeholder, redact_columns

#: The reason that stands for a container below the levels asked for; no secret or binary name.
CUT = "structured-value"
#: A hole has the name of the member whose value is hidden, or null for a string leaf.
SCHEMA = "struct<json:boolean,parts:array<string>,names:array<string>,texts:array<string>>"
_TYPE = pa.struct([("json", pa.bool_()), ("parts", pa.list_(pa.string())), ("names", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])

_TOKEN = re.compile(
    r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*+")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?|true|false|null))'
)
_INDEX = re.compile(r"0|[1-9][0-9]{0,9}", re.ASCII)
_SURROGATE = re.compile("[\ud800-\udfff]")


class Names(dict):
    """A name as JSON with its colon, and :func:`hides_value` of it, for each name that is asked for."""

    def __missing__(self, name: str) -> tuple[str, bool]:
        self[name] = known = (_quoted(name) + ":", hides_value(name))
        return known


class Literal(str):
    """A number as it stands."""


_CONSTANTS = {True: "true", False: "false", None: "null"}
_VALUES = {text: value for value, text in _CONSTANTS.items()}


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def parse(text: str) -> object:
    """The value of a JSON text, numbers as literals; ValueError for what is none.  Any depth will do."""
    try:
        return json.loads(text, parse_int=Literal, parse_float=Literal, parse_constant=_refuse)
    except RecursionError:
        return _parse_deep(text)


def _parse_deep(text: str) -> object:
    """The same by a stack of open containers, token by token."""
    top: list[object] = []
    stack: list[tuple[object, str | None]] = []
    holder, key, at, state = top, None, 0, "value"  # what may come: value, first (or a closer), key, colon, comma
    end = len(text.rstrip(" \t\n\r"))
    while at < end:
        token = _TOKEN.match(text, at)
        if token is None or (not stack and state == "comma"):
            raise ValueError(f"no JSON at {at}")
        at = token.end()
        mark, string, literal = token.groups()
        in_object = type(holder) is dict
        if string is not None and in_object and state in ("first", "key"):
            key, state = json.loads(string), "colon"
        elif mark == ":" and state == "colon":
            state = "value"
        elif mark == "," and state == "comma":
            state = "key" if in_object else "value"
        elif mark in ("}", "]") and state in ("first", "comma") and stack and in_object is (mark == "}"):
            holder, key = stack.pop()
            state = "comma"
        elif mark in (":", ",", "}", "]") or not (state == "value" or (state == "first" and not in_object)):
            raise ValueError(f"no JSON at {at}")
        else:
            value = {"{": dict, "[": list}[mark]() if mark else json.loads(string) if string is not None else _VALUES.get(literal, Literal(literal))
            if in_object:
                holder[key] = value
            else:
                holder.append(value)
            state = "comma"
            if mark:
                stack.append((holder, key))
                holder, key, state = value, None, "first"
    if stack or not top:
        raise ValueError("no whole JSON value")
    return top[0]


def members(value: dict, by_name: bool) -> Iterable[tuple[str, object]]:
    """Members by name (as UTF-16, like a VARIANT's), or in document order: array indices first, then as they stand."""
    if len(value) < 2:
        return value.items()
    if by_name:
        return sorted(value.items(), key=lambda item: item[0].encode("utf-16-be", "surrogatepass"))
    indices = [k for k in value if _INDEX.fullmatch(k) and int(k) < 2**32 - 1]
    if not indices:
        return value.items()
    first = dict.fromkeys(sorted(indices, key=int))
    return [(k, value[k]) for k in (*first, *(k for k in value if k not in first))]


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)


def _whole(text: str) -> str:
    """A text with halves of surrogate pairs replaced, which no column can hold."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if _SURROGATE.search(text) else text


def template(
    value: object, by_name: bool, redact: bool = True, depth: int | None = None, known: Names | None = None
) -> tuple[list[str], list[str | None], list[str]]:
    """Pieces, names and texts of a value; without ``redact`` it is one piece, its compact JSON.

    Where ``depth`` is given, a container inside of so many others is a hole as a whole.
    """
    parts, names, texts, piece = [], [], [], []
    known = Names() if known is None else known

    def hole(name: str | None, text: str) -> None:
        parts.append(_whole("".join(piece)))
        piece.clear()
        names.append(name)
        texts.append(_whole(text))

    def whole(v: object) -> str:
        return template(v, by_name, redact=False, known=known)[0][0]

    around: list[tuple] = []
    items, closer, comma = iter([(None, value)]), "", ""
    while True:
        for key, v in items:
            piece.append(comma)
            comma, kind = ",", type(v)
            if key is not None:
                name, hidden = known[key]
                piece.append(name)
                if hidden and redact and v is not None:
                    hole(_whole(key), v if isinstance(v, str) else _CONSTANTS[v] if kind is bool else whole(v))
                    continue
            if kind is str:
                hole(None, v) if redact else piece.append(_quoted(v))
            elif kind is not dict and kind is not list:
                piece.append(v if kind is Literal else _CONSTANTS[v])
            elif depth is not None and len(around) >= depth:
                hole(CUT, whole(v))
            else:
                around.append((items, closer))
                piece.append("{" if kind is dict else "[")
                items, closer = (iter(members(v, by_name)), "}") if kind is dict else (((None, x) for x in v), "]")
                comma = ""
                break
        else:
            piece.append(closer)
            if not around:
                break
            items, closer = around.pop()
            comma = ","
    parts.append(_whole("".join(piece)))
    return parts, names, texts


def _line(text: str | None, by_name: bool, depth: int | None, known: Names) -> dict | None:
    if text is None:
        return None
    try:
        parts, names, texts = template(parse(text.rstrip(" ")), by_name, depth=depth, known=known)
    except ValueError:
        is_blank = not text.strip(" ")
        parts, names, texts = ([text], [], []) if is_blank else (["", ""], [None], [text])
        return {"json": False, "parts": parts, "names": names, "texts": texts}
    return {"json": True, "parts": parts, "names": names, "texts": texts}


def templates(text: Column, by_name: bool = True, depth: int | None = None) -> Column:
    """The template of each text (SCHEMA); null for null."""

    def batch(values: pa.Array) -> pa.Array:
        known = Names()
        return pa.array([_line(v, by_name, depth, known) for v in values.to_pylist()], _TYPE)

    return F.arrow_udf(batch, SCHEMA)(text)


def redact_json(
    df: DataFrame,
    column: str,
    out: str,
    *,
    secrets: Iterable[tuple[str, str]] | DataFrame = (),
    by_name: bool = True,
    depth: int | None = None,
) -> DataFrame:
    """Add ``out``: JSON texts redacted as trees of any depth, other texts as texts; blank texts as they are.

    String leaves are redacted; the value of a member with a secret or binary name, unless it is
    null, gives way to its placeholder, made of the string, the literal or the compact JSON.
    Members come out by name, or in document order.  All levels are walked; a given ``depth`` puts a
    placeholder in the place of each container inside of so many others.  Null gives null; other columns pass, but
    for ``out`` and those named ``__shape`` and ``__texts``, which are replaced or dropped.
    """
    shaped = df.withColumn("__shape", templates(F.col(column), by_name, depth)).withColumn("__texts", F.col("__shape")["texts"])
    filled = redact_columns(shaped, "__texts", secrets=secrets)
    shape = F.col("__shape")
    found = F.arrays_zip(shape["names"].alias("name"), shape["texts"].alias("raw"), F.col("__texts").alias("text"))

    def fill(hole: Column) -> Column:
        mark = F.when(is_sensitive_key(hole["name"]), placeholder(hole["name"], hole["raw"])).otherwise(blob_placeholder(hole["name"], hole["raw"]))
        text = F.when(hole["name"].isNull(), hole["text"]).when(hole["name"] == CUT, placeholder(CUT, hole["raw"])).otherwise(mark)
        return F.when(shape["json"], json_string(text)).otherwise(text)

    fills = F.concat(F.transform(found, fill), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(shape["parts"], fills, lambda part, text: F.concat(part, text)), "")
    return filled.withColumn(out, joined).drop("__shape", "__texts")
