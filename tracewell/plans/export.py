"""The redacted export: read, redact, scan, gate, write, report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.redaction import placeholder, strip_path_roots
from ..operators import gates
from ..operators.outline import redact_json
from ..operators.tree import json_depth
from ..sources.files import publish, write_parts
from ..sources.jsonl import list_layers, read_layers
from .workspace import drop_stage, materialize, stage_path

FILE_KEYS = ("layer", "path")
#: Levels that a line of :func:`redact_lines` may be nested.
DEEPEST = 64
TRAINING_FORMAT = "redacted-jsonl-derivative"


def redact_lines(
    lines: DataFrame,
    roots: Iterable[str] = (),
    secrets: Sequence[tuple[str, str]] = (),
    depth: int | None = None,
) -> DataFrame:
    """Add ``clean`` and ``refused``: :func:`redact_records`, but for lines nested deeper than DEEPEST.

    JSON lines are redacted as trees, with the last of repeated keys and with numbers as they
    stand; other lines as text, blank lines are as they were; source roots are stripped from all
    of them.  What begins as an object or an array and is nested deeper than DEEPEST is refused: a
    placeholder takes its place.
    """
    value = F.col("value")
    openers = [F.length(value) - F.length(F.replace(value, F.lit(c), F.lit(""))) for c in "{["]
    nested = F.ltrim(value).rlike(r"^[\[{]") & (openers[0] + openers[1] > DEEPEST)
    refused = F.when(nested, json_depth(value) > DEEPEST).otherwise(F.lit(False))
    rows = redact_records(lines.withColumn("refused", refused), (), secrets, depth)
    clean = F.when(F.col("refused"), placeholder("structured-value", value)).otherwise(F.col("clean"))
    return rows.withColumn("clean", strip_path_roots(clean, roots))


def redact_records(
    lines: DataFrame,
    roots: Iterable[str] = (),
    secrets: Sequence[tuple[str, str]] | DataFrame = (),
    depth: int | None = None,
    by_name: bool = True,
) -> DataFrame:
    """Add ``clean``: lines redacted as templates, of any depth and size; none is refused.

    Members come out by name, or as they stand in the line.  Known secrets may be a table.  A
    given ``depth`` hides what lies below so many levels.
    """
    redacted = redact_json(lines, "value", "clean", secrets=secrets, by_name=by_name, depth=depth)
    return redacted.withColumn("clean", strip_path_roots(F.col("clean"), roots))


def manifest(
    clean_lines: DataFrame, secrets: Sequence[tuple[str, str]] = (), files: DataFrame | None = None
) -> DataFrame:
    """One row per file: bytes, findings before and after, approved or rejected.

    A file with a refused line is rejected.  With ``files`` (layer, path, file_bytes,
    output_bytes) there is a row for each of them, empty ones too, and bytes are those of the
    files, line ends included; without, they are those of the lines.
    """
    audited = gates.audit(clean_lines, "value", "clean", FILE_KEYS, secrets)
    if "refused" in clean_lines.columns:
        refused = clean_lines.where("refused").groupBy(*FILE_KEYS).agg(F.count("*").alias("__refused"))
        status = F.when(F.col("__refused").isNotNull(), gates.REJECTED).otherwise(F.col("status"))
        audited = audited.join(refused, list(FILE_KEYS), "left").withColumn("status", status).drop("__refused")
    if files is None:
        return audited
    listed = files.select(*FILE_KEYS, F.col("file_bytes").alias("input_bytes"), "output_bytes")
    return listed.join(audited.drop("input_bytes", "output_bytes"), list(FILE_KEYS), "left").withColumn(
        "status", F.coalesce("status", F.lit(gates.APPROVED))
    )


def training_index(approved: DataFrame) -> DataFrame:
    return approved.select(*FILE_KEYS, F.lit(TRAINING_FORMAT).alias("format"))


def report(manifest_rows: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """One row: how many files, approved and rejected, and what the external scan came to."""
    status = F.col("status")
    counts = manifest_rows.agg(
        F.count_if(status == gates.APPROVED).alias("approved"),
        F.count_if(status == gates.REJECTED).alias("rejected"),
        F.count("*").alias("files"),
    )
    return counts if scan is None else counts.crossJoin(scan.select(F.struct("*").alias("external_scan")))


def review(report_row: DataFrame) -> DataFrame:
    """The lines of a note for whoever reviews the export (column ``value``)."""
    scan = F.col("external_scan")
    ran = F.when(~scan["enabled"], "skipped").when(scan["available"], "ran").otherwise("unavailable")
    lines = (
        F.lit("# Redacted export"),
        F.concat(F.lit("Status: "), F.when(F.col("rejected") == 0, gates.APPROVED).otherwise(gates.REJECTED)),
        *[F.concat(F.lit(f"- {name.capitalize()}: "), F.col(name)) for name in ("files", "approved", "rejected")],
        F.concat(F.lit("- External scan: "), ran, F.lit(", required="), scan["required"], F.lit(", findings="), scan["findings"]),
        F.lit("- Training index: training-index"),
        F.lit("Review approved files before they are used for training or shared."),
    )
    return report_row.select(F.explode(F.array(*lines)).alias("value"))


def source_roots(sessions_dir: str | None, raw_trace_dir: str | None) -> list[str]:
    """Roots to strip, the longest first; the folder above ``sessions`` is one too."""
    roots = [r.rstrip("/") for r in (sessions_dir, raw_trace_dir) if r]
    if sessions_dir and roots[0].endswith("/sessions"):
        roots.append(roots[0][: -len("/sessions")])
    return list(dict.fromkeys(r for r in roots if r))


def export_redacted(
    spark: SparkSession,
    out_dir: str,
    sessions_dir: str | None = None,
    raw_trace_dir: str | None = None,
    *,
    secrets: Sequence[tuple[str, str]] = (),
    scanner_lines: DataFrame | None = None,
    scanner_required: bool = False,
    scanner_warning: bool = False,
    scanner_enabled: bool = True,
    scanner_exit_code: int | None = None,
    glob: str = "*.jsonl",
    depth: int | None = None,
) -> DataFrame:
    """Run the export and return its report row.

    ``scanner_lines`` (column ``line``) is the output of an external scanner over an
    earlier run; None means it did not run.  An exit code other than 0 counts as a warning.
    Each input file has one redacted output below ``out_dir``, at the path that manifest and
    training index name: ``sessions/...`` or ``raw-traces/...``, with the line ends of the input
    as line feeds.
    """
    lines = read_layers(spark, sessions_dir, raw_trace_dir, glob)
    roots = source_roots(sessions_dir, raw_trace_dir)
    clean = materialize(redact_records(lines, roots, secrets, depth), "export-lines")
    listed = materialize(list_layers(spark, sessions_dir, raw_trace_dir, glob), "export-files")
    folder = stage_path(spark, "export-parts")
    parts = materialize(write_parts(clean, folder, "clean"), "export-part-list")
    written = materialize(publish(listed, parts, folder, out_dir), "export-published")
    drop_stage(spark, folder)
    files = listed.join(written, list(FILE_KEYS))
    found = None if scanner_lines is None or not scanner_enabled else gates.scanner_findings(scanner_lines, "line")
    failed = scanner_enabled and (scanner_warning or bool(scanner_exit_code))
    gated = gates.external_gate(manifest(clean, secrets, files), found, failed, scanner_enabled and scanner_required)
    rows = materialize(gated, "manifest")
    approved = rows.where(F.col("status") == gates.APPROVED)
    scan = gates.scan_status(spark, found, scanner_enabled, scanner_required, scanner_warning, scanner_exit_code)
    outputs = {
        "manifest": rows,
        "approved": approved,
        "rejected": rows.where(F.col("status") == gates.REJECTED),
        "training-index": training_index(approved),
        "report": materialize(report(rows, scan), "report"),
    }
    for name, df in outputs.items():
        df.write.mode("overwrite").json(f"{out_dir}/{name}")
    review(outputs["report"]).coalesce(1).write.mode("overwrite").text(f"{out_dir}/review")
    return outputs["report"]
