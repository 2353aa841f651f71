"""Redaction of text columns by typed placeholders, as pure Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from . import patterns as P
from .patterns import Shape, java_pattern


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    Catalyst has no let-expression; a one-element ``transform`` is one.  Chained
    passes stay linear in size and in work this way.
    """
    return F.transform(F.array(value), lambda it: body(it))[0]


def normalize_name(name: Column, separator: str) -> Column:
    split_camel = F.regexp_replace(name, "([a-z0-9])([A-Z])", f"$1{separator}$2")
    joined = F.regexp_replace(split_camel, "[^a-zA-Z0-9]+", separator)
    return F.lower(F.regexp_replace(joined, f"^{separator}+|{separator}+$", ""))


def normalize_reason(reason: Column) -> Column:
    return normalize_name(reason, "-")


def normalize_key(key: Column) -> Column:
    return normalize_name(key, "_")


def json_string(text: Column) -> Column:
    """JSON literal of a string."""
    return F.regexp_replace(
        F.regexp_replace(F.to_json(F.struct(text.alias("s"))), r'^\{"s":', ""), r"\}$", ""
    )


def _is_sensitive_normalized(key: Column) -> Column:
    return (
        ~key.rlike(P.PUBLIC_KEY)
        & ~key.rlike(P.TOKEN_COUNT_KEY)
        & (key.rlike(P.SENSITIVE_KEY) | key.rlike(P.TOKEN_KEY))
    )


def is_sensitive_key(key: Column) -> Column:
    """True for names of secrets; token counters and public keys are not secret."""
    return bind(normalize_key(key), _is_sensitive_normalized)


def is_binary_key(key: Column) -> Column:
    return normalize_key(key).rlike(P.BINARY_KEY)


def placeholder(reason: Column | str, value: Column | None = None) -> Column:
    """``[REDACTED:<reason>:<first 10 hex of SHA-256>]``; equal values give equal text."""
    name = (
        F.lit(reason)
        if isinstance(reason, str)
        else F.coalesce(F.nullif(normalize_reason(reason), F.lit("")), F.lit("secret"))
    )
    if value is None:
        return F.concat(F.lit("[REDACTED:"), name, F.lit("]"))
    digest = F.when(
        value != "", F.concat(F.lit(":"), F.substring(F.sha2(value, 256), 1, 10))
    ).otherwise("")
    return F.concat(F.lit("[REDACTED:"), name, digest, F.lit("]"))


def blob_placeholder(reason: Column | str, value: Column) -> Column:
    return F.concat(
        placeholder(reason, value), F.lit("("), F.length(value).cast("string"), F.lit(" chars)")
    )


def may_match(text: Column, shape: Shape) -> Column:
    """Cheap necessary condition for ``shape`` to occur in ``text``."""
    guard = F.lit(True)
    if shape.needles:
        found = [F.contains(text, F.lit(n)) for n in shape.needles]
        guard = found[0]
        for other in found[1:]:
            guard = guard | other
    for needle in shape.all_of:
        guard = guard & F.contains(text, F.lit(needle))
    if shape.prefilter:
        guard = guard & text.rlike(shape.prefilter)
    return guard


def replace_matches(
    text: Column, pattern: str, replacement: Callable[[Column], Column]
) -> Column:
    """Replace every match of a regex by a Column computed from that very match."""

    def replaced(matches: Column) -> Column:
        pieces = F.zip_with(
            F.split(text, pattern, -1),
            F.concat(F.transform(matches, replacement), F.array(F.lit(""))),
            lambda gap, match: F.concat(gap, match),
        )
        return F.when(F.size(matches) == 0, text).otherwise(F.array_join(pieces, ""))

    return bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), replaced)


def passes_luhn(match: Column) -> Column:
    return F.call_function("luhn_check", F.regexp_replace(match, "[^0-9]", ""))


def redact_shape(text: Column, shape: Shape) -> Column:
    def replacement(match: Column) -> Column:
        mark = blob_placeholder if shape.blob else placeholder
        if shape.luhn:
            return F.when(passes_luhn(match), mark(shape.reason, match)).otherwise(match)
        return mark(shape.reason, match)

    return bind(
        text,
        lambda t: F.when(
            may_match(t, shape),
            replace_matches(t, java_pattern(shape), replacement),
        ).otherwise(t),
    )


def may_assign(text: Column) -> Column:
    lowered = F.lower(text)
    named = bind(
        lowered,
        lambda low: F.exists(
            F.array(*[F.lit(n) for n in P.ASSIGNMENT_NEEDLES]), lambda n: F.contains(low, n)
        ),
    )
    return (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & named


def _assignment_part(match: Column, group: int) -> Column:
    return F.regexp_extract(match, f"(?i)^{P.ASSIGNMENT_BODY}$", group)


def redact_assignments(text: Column) -> Column:
    """``KEY = "value"`` keeps key, operator and quotes; only secret keys are touched."""

    def replacement(match: Column) -> Column:
        key = _assignment_part(match, 1)
        quote = _assignment_part(match, 3)
        return F.when(
            is_sensitive_key(key),
            F.concat(
                key,
                _assignment_part(match, 2),
                quote,
                bind(_assignment_part(match, 4), lambda value: placeholder(key, value)),
                quote,
            ),
        ).otherwise(match)

    return bind(
        text,
        lambda t: F.when(
            may_assign(t),
            replace_matches(t, P.JAVA_ASSIGNMENT, replacement),
        ).otherwise(t),
    )


def prepare_secrets(secrets: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Known secret values as (value, reason): trimmed, 8 to 20,000 characters, the last
    reason of a value wins, longest value first so that no value cuts a longer one."""
    kept: dict[str, str] = {}
    for value, reason in secrets:
        trimmed = value.strip()
        if P.MIN_EXACT_SECRET_CHARS <= len(trimmed) <= P.MAX_EXACT_SECRET_CHARS:
            kept[trimmed] = reason
    return sorted(kept.items(), key=lambda item: -len(item[0]))


def _normalized(key: str) -> str:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", key)
    return re.sub(r"[^a-zA-Z0-9]+", "_", spaced).strip("_").lower()


def names_secret(key: str) -> bool:
    """:func:`is_sensitive_key` of a name."""
    name = _normalized(key)
    if re.search(P.PUBLIC_KEY, name) or re.search(P.TOKEN_COUNT_KEY, name):
        return False
    return bool(re.search(P.SENSITIVE_KEY, name) or re.search(P.TOKEN_KEY, name))


def hides_value(key: str) -> bool:
    """Whether a member of that name is secret or binary."""
    return names_secret(key) or bool(re.search(P.BINARY_KEY, _normalized(key)))


def secrets_from_settings(settings: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """The (value, key) pairs of a settings list whose key names a secret."""
    return [(value, key) for key, value in settings if names_secret(key)]


def redact_exact(text: Column, secrets: Sequence[tuple[str, str]]) -> Column:
    """Literal replacement of known secret values (already :func:`prepare_secrets`-ed)."""
    for value, reason in secrets:
        mark = placeholder(F.lit(reason), F.lit(value))
        text = F.replace(text, F.lit(value), mark)
    return text


def by_prefilter(shapes: Iterable[Shape]) -> list[list[Shape]]:
    """Neighbouring shapes with the same prefilter, the others one by one."""
    groups: list[list[Shape]] = []
    for shape in shapes:
        if shape.prefilter and groups and groups[-1][0].prefilter == shape.prefilter:
            groups[-1].append(shape)
        else:
            groups.append([shape])
    return groups


def redact_together(text: Column, shapes: Sequence[Shape]) -> Column:
    """Shapes with a common prefilter in order, the prefilter scanned for once."""
    if len(shapes) == 1:
        return redact_shape(text, shapes[0])

    def guarded(t: Column) -> Column:
        out = t
        for shape in shapes:
            out = redact_shape(out, shape)
        return F.when(t.rlike(shapes[0].prefilter), out).otherwise(t)

    return bind(text, guarded)


def text_passes(
    secrets: Iterable[tuple[str, str]] = (), extra_shapes: Sequence[Shape] = ()
) -> list[Callable[[Column], Column]]:
    """The redaction passes in their fixed order.

    The order is part of the result: an assignment is named by its key before a
    generic shape can take its value, and known values run after the shapes so
    that a shape is never cut by a shorter value inside it.
    """

    def shape_pass(group: list[Shape]) -> Callable[[Column], Column]:
        return lambda text: redact_together(text, group)

    known = prepare_secrets(secrets)
    passes: list[Callable[[Column], Column]] = [redact_assignments]
    passes += [shape_pass(g) for g in by_prefilter((*P.SECRET_SHAPES, *extra_shapes))]
    if known:
        passes.append(lambda text: redact_exact(text, known))
    passes += [shape_pass(g) for g in by_prefilter(P.PERSONAL_SHAPES)]
    return passes


# Passes per projection.  Nested lambdas cost the analyzer one round each, single
# projections cost a row copy each; a handful per projection keeps both small.
PASSES_PER_PROJECTION = 3


def redact_columns(
    df: DataFrame,
    *columns: str,
    secrets: Iterable[tuple[str, str]] | DataFrame = (),
    enabled: bool = True,
    extra_shapes: Sequence[Shape] = (),
) -> DataFrame:
    """Redact string columns, or every element of array-of-string columns, in place.

    Known secrets are few pairs of value and reason, or a table of them (columns value, reason) of
    any size, whose values stand in no plan.
    """
    if not enabled or not columns:
        return df
    if isinstance(secrets, DataFrame):
        from ..operators.known_secrets import redact_known

        every = text_passes((), extra_shapes)
        after = len(by_prefilter(P.PERSONAL_SHAPES))
        shaped = _redact_by(df, columns, every[:-after])
        return _redact_by(redact_known(shaped, *columns, secrets=secrets), columns, every[-after:])
    return _redact_by(df, columns, text_passes(secrets, extra_shapes))


def _redact_by(df: DataFrame, columns: Sequence[str], passes: Sequence[Callable[[Column], Column]]) -> DataFrame:
    arrays = {
        c for c in columns if isinstance(df.schema[c].dataType, ArrayType)
    }
    for start in range(0, len(passes), PASSES_PER_PROJECTION):
        group = passes[start : start + PASSES_PER_PROJECTION]

        def chained(text: Column, group: Sequence = tuple(group)) -> Column:
            for one in group:
                text = one(text)
            return text

        df = df.withColumns(
            {
                c: F.transform(F.col(c), lambda t: chained(t)) if c in arrays else chained(F.col(c))
                for c in columns
            }
        )
    return df


def neutralize_data_prefix(text: Column) -> Column:
    """Escape ``data:`` unless a base64 media address follows."""
    return F.regexp_replace(
        text, "data:(?![^,;]+(?:;[^,;]+)*;base64,[A-Za-z0-9+/=_-]+)", r"data\\:"
    )


def strip_path_roots(text: Column, roots: Iterable[str]) -> Column:
    """Replace each absolute source root by ``[PATH_ROOT]``."""
    for root in dict.fromkeys(r for r in roots if r):
        text = F.replace(text, F.lit(root), F.lit("[PATH_ROOT]"))
    return text
