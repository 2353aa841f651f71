"""Building blocks of the comparison SQL."""

from __future__ import annotations

from tracewell.functions import patterns as P


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def normalized(column: str, separator: str) -> str:
    camel = f"regexp_replace({column}, '([a-z0-9])([A-Z])', '\\1{separator}\\2', 'g')"
    joined = f"regexp_replace({camel}, '[^a-zA-Z0-9]+', '{separator}', 'g')"
    return f"lower(regexp_replace({joined}, '^{separator}+|{separator}+$', '', 'g'))"


def sensitive(column: str) -> str:
    key = normalized(column, "_")
    return (
        f"(NOT regexp_matches({key}, {q(P.PUBLIC_KEY)}) AND NOT regexp_matches({key}, {q(P.TOKEN_COUNT_KEY)})"
        f" AND (regexp_matches({key}, {q(P.SENSITIVE_KEY)}) OR regexp_matches({key}, {q(P.TOKEN_KEY)})))"
    )


def mark(reason: str, value: str) -> str:
    """Placeholder; ``reason`` and ``value`` are SQL expressions."""
    return f"concat('[REDACTED:', {reason}, ':', substr(sha256({value}), 1, 10), ']')"


def blob_mark(reason: str, value: str) -> str:
    return f"concat({mark(reason, value)}, '(', CAST(length({value}) AS VARCHAR), ' chars)')"


def luhn(value: str) -> str:
    digits = f"regexp_replace({value}, '[^0-9]', '', 'g')"
    return (
        f"(list_sum(list_transform(range(1, length({digits}) + 1), lambda p: "
        f"CASE WHEN (length({digits}) - p) % 2 = 0 THEN CAST(substr({digits}, p, 1) AS INT) "
        f"ELSE (2 * CAST(substr({digits}, p, 1) AS INT)) // 10 + (2 * CAST(substr({digits}, p, 1) AS INT)) % 10 END)) % 10 = 0)"
    )


def replace_each(column: str, pattern: str, replacement: str) -> str:
    """Replace every match, named m in ``replacement``."""
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({column}, {q(pattern)}), "
        f"list_append(list_transform(regexp_extract_all({column}, {q(pattern)}), lambda m: {replacement}), '')), "
        f"lambda z: concat(z[1], z[2])), '')"
    )


def shape_step(column: str, shape: P.Shape) -> str:
    made = (blob_mark if shape.blob else mark)(q(shape.reason), "m")
    if shape.luhn:
        made = f"CASE WHEN {luhn('m')} THEN {made} ELSE m END"
    return replace_each(column, shape.pattern, made)


VALUE = P.ASSIGNED_VALUE
ASSIGNMENT = rf"""(?i)\b({P.ASSIGNED_NAME})\s*([:=])\s*(?:"({VALUE})"|'({VALUE})'|({VALUE}))"""
ASSIGNED = ASSIGNMENT.replace(r"(?i)\b", "(?i)^") + "$"


def part(match: str, group: int) -> str:
    return f"regexp_extract({match}, {q(ASSIGNED)}, {group})"


def assigned_value(match: str) -> str:
    return f"concat({part(match, 3)}, {part(match, 4)}, {part(match, 5)})"


def assignment_step(column: str) -> str:
    quote = (
        f"CASE WHEN {part('m', 3)} <> '' THEN '\"' WHEN {part('m', 4)} <> '' THEN '''' ELSE '' END"
    )
    made = (
        f"CASE WHEN {sensitive(part('m', 1))} THEN concat({part('m', 1)}, {part('m', 2)}, {quote}, "
        f"{mark(normalized(part('m', 1), '-'), assigned_value('m'))}, {quote}) ELSE m END"
    )
    return replace_each(column, ASSIGNMENT, made)


def chain(source: str, keys: str, steps: list[str]) -> str:
    """CTEs s0..sN applying each step (on column text) to the previous text."""
    ctes = [f"s0 AS ({source})"]
    for i, step in enumerate(steps):
        ctes.append(f"s{i + 1} AS MATERIALIZED (SELECT {keys}, {step} AS text FROM s{i})")
    return "WITH " + ",\n".join(ctes)


def redaction_steps(secrets: list[tuple[str, str]] = ()) -> list[str]:
    steps = [assignment_step("text")]
    steps += [shape_step("text", s) for s in P.SECRET_SHAPES]
    steps += [f"replace(text, {q(v)}, {mark(q(r), q(v))})" for v, r in secrets]
    steps += [shape_step("text", s) for s in P.PERSONAL_SHAPES]
    return steps


def finding_rows(source: str, keys: str) -> str:
    """(keys, reason, n) rows of ``source`` (with column text), one select per kind."""
    scan = "regexp_replace(text, '\\[REDACTED:[^\\]]+\\]', '[REDACTED]', 'g')"
    base = f"SELECT {keys}, {scan} AS t FROM ({source}) AS src"
    selects = []
    for s in (*P.SECRET_SHAPES, *P.PERSONAL_SHAPES):
        found = f"regexp_extract_all(t, {q(s.pattern)})"
        if s.luhn:
            found = f"list_filter({found}, lambda m: {luhn('m')})"
        selects.append(f"SELECT {keys}, {q(s.reason)} AS reason, len({found}) AS n FROM scan_base")
    field = (
        f"SELECT {keys}, unnest(regexp_extract_all(t, {q(P.JSON_FIELD)}, 1)) AS k, "
        f"unnest(regexp_extract_all(t, {q(P.JSON_FIELD)}, 2)) AS v FROM scan_base"
    )
    selects.append(
        f"SELECT {keys}, {normalized('k', '-')} AS reason, 1 AS n FROM ({field}) AS f WHERE NOT starts_with(v, '[REDACTED')"
    )
    matched = f"SELECT {keys}, unnest(regexp_extract_all(t, {q(ASSIGNMENT)})) AS m FROM scan_base"
    selects.append(
        f"SELECT {keys}, {normalized(part('m', 1), '-')} AS reason, 1 AS n FROM ({matched}) AS a "
        f"WHERE {sensitive(part('m', 1))} AND NOT starts_with({assigned_value('m')}, '[REDACTED')"
    )
    union = "\nUNION ALL ".join(selects)
    return f"WITH scan_base AS MATERIALIZED ({base}) SELECT * FROM ({union}) AS hits WHERE n > 0"
