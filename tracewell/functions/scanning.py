"""Findings: how often each kind of secret or personal datum occurs in a text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from . import patterns as P
from .patterns import Shape, java_pattern
from .redaction import (
    _assignment_part,
    bind,
    by_prefilter,
    is_sensitive_key,
    may_assign,
    may_match,
    normalize_reason,
    passes_luhn,
    prepare_secrets,
)

FINDINGS = "array<struct<reason:string,count:bigint>>"


def without_placeholders(text: Column) -> Column:
    return F.when(
        F.contains(text, F.lit("[REDACTED:")),
        F.regexp_replace(text, P.PLACEHOLDER, P.PLACEHOLDER_STEM),
    ).otherwise(text)


def count_shape(text: Column, shape: Shape) -> Column:
    pattern = java_pattern(shape)
    if shape.luhn:
        found = F.size(
            F.filter(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), passes_luhn)
        )
    else:
        found = F.regexp_count(text, F.lit(pattern))
    return F.when(may_match(text, shape), found).otherwise(0).cast("bigint")


def _finding(reason: Column, count: Column) -> Column:
    return F.struct(reason.alias("reason"), count.cast("bigint").alias("count"))


def json_field_reasons(text: Column) -> Column:
    """Reasons of ``"secretish": "value"`` pairs whose value is not yet redacted."""

    def reasons(t: Column) -> Column:
        keys = F.regexp_extract_all(t, F.lit(P.JSON_FIELD), F.lit(1))
        values = F.regexp_extract_all(t, F.lit(P.JSON_FIELD), F.lit(2))
        pairs = F.filter(
            F.arrays_zip(keys.alias("key"), values.alias("value")),
            lambda p: ~F.startswith(p["value"], F.lit("[REDACTED")),
        )
        return F.transform(pairs, lambda p: normalize_reason(p["key"]))

    lowered = F.lower(text)
    named = bind(
        lowered,
        lambda low: F.exists(
            F.array(*[F.lit(n) for n in P.JSON_FIELD_NEEDLES]), lambda n: F.contains(low, n)
        ),
    )
    possible = F.contains(text, F.lit(":")) & named
    return F.when(possible, reasons(text)).otherwise(F.array().cast("array<string>"))


def assignment_reasons(text: Column) -> Column:
    """Reasons of ``KEY=value`` pairs with a secret key and a value not yet redacted."""

    def reasons(t: Column) -> Column:
        matches = F.regexp_extract_all(t, F.lit(P.JAVA_ASSIGNMENT), F.lit(0))
        kept = F.filter(
            matches,
            lambda m: is_sensitive_key(_assignment_part(m, 1))
            & ~F.startswith(_assignment_part(m, 4), F.lit("[REDACTED")),
        )
        return F.transform(kept, lambda m: normalize_reason(_assignment_part(m, 1)))

    return F.when(may_assign(text), reasons(text)).otherwise(
        F.array().cast("array<string>")
    )


def _count_literal(text: Column, value: str) -> Column:
    shorter = F.length(text) - F.length(F.replace(text, F.lit(value), F.lit("")))
    return F.when(
        F.contains(text, F.lit(value)), (shorter / F.lit(len(value))).cast("bigint")
    ).otherwise(0)


def findings(
    text: Column,
    secrets: Iterable[tuple[str, str]] = (),
    extra_shapes: Sequence[Shape] = (),
) -> Column:
    """Per-row findings as an array of (reason, count), one entry per hit kind.

    Entries of one reason may repeat within a row; sum them by reason.
    """

    def collect(t: Column) -> Column:
        shapes = (*P.SECRET_SHAPES, *extra_shapes, *P.PERSONAL_SHAPES)
        counted, scanned = [], []
        for group in by_prefilter(shapes):
            found = [_finding(F.lit(s.reason), count_shape(t, s)) for s in group]
            if group[0].prefilter:
                scanned.append(
                    F.when(t.rlike(group[0].prefilter), F.array(*found).cast(FINDINGS)).otherwise(
                        F.array().cast(FINDINGS)
                    )
                )
            else:
                counted += found
        exact = [
            _finding(
                F.coalesce(
                    F.nullif(normalize_reason(F.lit(reason)), F.lit("")),
                    F.lit("configured-secret"),
                ),
                _count_literal(t, value),
            )
            for value, reason in prepare_secrets(secrets)
        ]
        fixed = F.filter(
            F.concat(F.array(*counted, *exact).cast(FINDINGS), *scanned), lambda f: f["count"] > 0
        )
        named = F.transform(
            F.concat(json_field_reasons(t), assignment_reasons(t)),
            lambda reason: _finding(reason, F.lit(1)),
        )
        return F.concat(fixed, named).cast(FINDINGS)

    return bind(without_placeholders(F.coalesce(text, F.lit(""))), collect)


def count_findings(
    df: DataFrame,
    text: str,
    keys: Sequence[str],
    secrets: Iterable[tuple[str, str]] = (),
    extra_shapes: Sequence[Shape] = (),
) -> DataFrame:
    """Findings of a text column added up by ``keys`` and reason.

    Rows without a hit emit nothing and the sums combine map-side, so only hit
    counts cross the shuffle.
    """
    hits = df.select(*keys, F.explode(findings(F.col(text), secrets, extra_shapes)).alias("hit"))
    return hits.groupBy(*keys, F.col("hit.reason").alias("reason")).agg(
        F.sum("hit.count").alias("count")
    )


def findings_by_record(counts: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Fold (keys, reason, count) rows into one reason-sorted array per key.

    The array has one entry per reason, so its size is bound by the kinds of
    findings, not by the number of hits.
    """
    return counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("reason", "count"))).alias(name)
    )
