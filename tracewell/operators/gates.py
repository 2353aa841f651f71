"""Gates of an export: which records are clean enough to leave."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scanning import findings, findings_by_record

# --- fixed values: keys that mark a line of an external scanner as a finding ------
DETECTOR_KEYS = ("DetectorName", "SourceMetadata", "Raw", "Redacted")
APPROVED, REJECTED = "approved", "rejected"


def residual_gate(records: DataFrame, residual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Approve the records without a finding left after redaction."""
    found = findings_by_record(residual, keys, "residual_findings")
    joined = records.join(found, list(keys), "left")
    return joined.withColumn(
        "status",
        F.when(F.col("residual_findings").isNull(), APPROVED).otherwise(REJECTED),
    )


def audit(
    df: DataFrame,
    before: str,
    after: str,
    keys: Sequence[str],
    secrets: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Findings and bytes before and after redaction per key, and the verdict.

    Both texts are scanned in the same pass over the rows; what is counted goes
    through one aggregation by (key, stage, reason) that combines map-side.
    """

    def counted(stage: str, column: str):
        return F.transform(
            findings(F.col(column), secrets),
            lambda f: F.struct(F.lit(stage).alias("stage"), f["reason"].alias("reason"), f["count"].alias("n")),
        )

    def sized(stage: str, column: str):
        size = F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
        return F.struct(F.lit(stage).alias("stage"), F.lit("").alias("reason"), size.alias("n"))

    facts = F.concat(
        F.array(sized("in", before), sized("out", after)), counted("pre", before), counted("post", after)
    )
    sums = (
        df.select(*keys, F.explode(facts).alias("fact"))
        .groupBy(*keys, "fact.stage", "fact.reason")
        .agg(F.sum("fact.n").alias("count"))
    )

    def found(stage: str):
        kept = F.when(F.col("stage") == stage, F.struct("reason", "count"))
        listed = F.array_sort(F.collect_list(kept))
        return F.when(F.size(listed) > 0, listed)

    files = sums.groupBy(*keys).agg(
        F.max(F.when(F.col("stage") == "in", F.col("count"))).alias("input_bytes"),
        F.max(F.when(F.col("stage") == "out", F.col("count"))).alias("output_bytes"),
        found("pre").alias("pre_findings"),
        found("post").alias("residual_findings"),
    )
    return files.withColumn(
        "status", F.when(F.col("residual_findings").isNull(), APPROVED).otherwise(REJECTED)
    )


def scanner_findings(lines: DataFrame, column: str) -> DataFrame:
    """Lines of an external scanner's JSONL that report a finding."""
    line = F.trim(F.col(column))
    keys = F.json_object_keys(line)
    level = F.get_json_object(line, "$.level")
    quiet = level.isNull() | level.isin("", "0", "false")
    return lines.where(
        F.startswith(line, F.lit("{"))
        & F.try_parse_json(line).isNotNull()
        & F.arrays_overlap(keys, F.array(*[F.lit(k) for k in DETECTOR_KEYS]))
        & quiet
    )


def external_gate(
    records: DataFrame,
    findings: DataFrame | None,
    warning: bool = False,
    required: bool = False,
) -> DataFrame:
    """Any external finding or warning rejects every record, as does a required
    scanner that did not run (``findings`` is None)."""
    if findings is None:
        return records.withColumn("status", F.lit(REJECTED)) if required else records
    if warning:
        return records.withColumn("status", F.lit(REJECTED))
    tripped = findings.agg((F.count("*") > 0).alias("__tripped"))
    joined = records.crossJoin(F.broadcast(tripped))
    return joined.withColumn(
        "status", F.when(F.col("__tripped"), REJECTED).otherwise(F.col("status"))
    ).drop("__tripped")


def scan_status(
    spark: SparkSession,
    findings: DataFrame | None,
    enabled: bool = True,
    required: bool = False,
    warned: bool = False,
    exit_code: int | None = None,
) -> DataFrame:
    """One row that says what came of an external scan: whether it was asked for, required and
    ran, its exit code, how many findings, and the warning, null if there is none."""
    ran = enabled and findings is not None
    if not enabled:
        warning = "external scan skipped"
    elif not ran:
        warning = "external scan required but did not run" if required else "external scan did not run; built-in residual scan only"
    elif exit_code:
        warning = f"external scan exited with status {exit_code}"
    else:
        warning = "external scan gave a warning" if warned else None
    count = findings.agg(F.count("*").alias("findings")) if ran else spark.range(1).select(F.lit(0).cast("bigint").alias("findings"))
    return count.select(
        F.lit(enabled).alias("enabled"),
        F.lit(enabled and required).alias("required"),
        F.lit(ran).alias("available"),
        F.lit(exit_code if ran else None).cast("int").alias("exit_code"),
        "findings",
        F.lit(warning).cast("string").alias("warning"),
    )
