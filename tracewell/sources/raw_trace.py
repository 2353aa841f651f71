"""Raw trace records on their way to storage.

A standing store is a folder of runs, ``run=<first epoch>-<last epoch>``.  Each epoch of a stream
is a run of a bounded number of sorted files; written again it replaces itself, so a replay adds
nothing.  Compaction merges runs into one that spans them; readers take runs that were written
whole and that no other such run spans, so a compaction that was lost half-way changes nothing.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.identity import raw_trace_path
from ..operators.running import number_rows
from ..operators.tree import shape_raw_record
from ..plans.workspace import drop_stage, materialize, stage_path
from .files import publish, write_parts

PARTITIONS = ("project", "session")
STORED = "project string, session string, epoch bigint, seq bigint, value string"
IN_ORDER = (*PARTITIONS, "epoch", "seq")
#: Files of an epoch, and rows of a session that stay together in one of them.
BUCKETS = 32
ROWS_PER_CHUNK = 1 << 14
#: Bytes of a compacted file.
FILE_BYTES = 128 << 20


def shaped_records(
    records: DataFrame, policy: str | Column = "full-debug", order: str | None = None, **options
) -> DataFrame:
    """Records (session_file, record JSON) shaped and placed: project, session, value, and with
    ``order``, their number within the session, ``seq``.

    Records without a session file have no place and are left out.
    """
    located = records.withColumns(
        {
            "__at": raw_trace_path(F.col("session_file")),
            "__type": F.coalesce(F.get_json_object("record", "$.type"), F.lit("")),
        }
    ).where(F.col("__at").isNotNull())
    shaped = shape_raw_record(located, "record", "value", F.col("__type"), policy, **options)
    numbers = [F.col(order).cast("bigint").alias("seq")] if order else []
    return shaped.select("__at.project", "__at.session", *numbers, "value")


def append_records(records: DataFrame, folder: str, enabled: bool = True) -> None:
    """Append shaped records of a batch as JSON lines, partitioned for pruning."""
    if enabled:
        records.write.mode("append").partitionBy(*PARTITIONS).text(folder)


def stream_records(records: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append shaped records of a stream exactly once: the file sink commits each batch
    together with the source offsets in the checkpoint."""
    return (
        records.writeStream.format("text")
        .partitionBy(*PARTITIONS)
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_epoch(records: DataFrame, folder: str, epoch: int, buckets: int = BUCKETS) -> None:
    """Write one epoch of shaped records (project, session, seq, value) as a run of the store.

    At most ``buckets`` files, whatever the number of sessions; chunks of a session go to
    different ones.  Doing it again replaces what it wrote.
    """
    chunk = F.floor(F.coalesce("seq", F.lit(0)) / ROWS_PER_CHUNK)
    placed = records.withColumn("epoch", F.lit(epoch).cast("bigint"))
    (
        placed.select(*[c.split()[0] for c in STORED.split(", ")])
        .repartition(buckets, *PARTITIONS, chunk)
        .sortWithinPartitions(*IN_ORDER)
        .write.mode("overwrite")
        .parquet(f"{folder}/run={epoch}-{epoch}")
    )


def stream_epochs(records: DataFrame, folder: str, checkpoint: str, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Keep the store up to date from a stream of shaped records, one run for each micro-batch."""
    return (
        records.writeStream.foreachBatch(lambda batch, epoch: append_epoch(batch, folder, epoch, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _runs(spark: SparkSession, folder: str) -> list[tuple[int, int, str]]:
    """(first, last, path) of the runs of a store that were written whole."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    runs = []
    for status in system.listStatus(path):
        name = re.fullmatch(r"run=(\d+)-(\d+)", status.getPath().getName())
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name and system.exists(done):
            runs.append((int(name[1]), int(name[2]), status.getPath().toString()))
    return runs


def _standing(runs: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The runs that no other spans; by first epoch."""
    kept, reach = [], -1
    for first, last, path in sorted(runs, key=lambda r: (r[0], -r[1])):
        if last > reach:
            kept.append((first, last, path))
            reach = last
    return kept


def stored_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the store once: project, session, epoch, seq, value."""
    paths = [path for _, _, path in _standing(_runs(spark, folder))]
    return spark.read.schema(STORED).parquet(*paths) if paths else spark.createDataFrame([], STORED)


def compact(spark: SparkSession, folder: str, file_bytes: int = FILE_BYTES) -> int:
    """Merge the standing runs into one of files of about ``file_bytes``; returns how many there were.

    Files are cut by (project, session, epoch, seq), so a large session spreads over several.
    What the new run spans is deleted after it is whole.  Run it while no stream writes.
    """
    all_runs = _runs(spark, folder)
    runs = _standing(all_runs)
    if len(runs) > 1:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        sizes = [system.getContentSummary(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)).getLength() for _, _, p in runs]
        merged = f"run={runs[0][0]}-{runs[-1][1]}"
        (
            stored_records(spark, folder)
            .repartitionByRange(max(1, -(-sum(sizes) // file_bytes)), *IN_ORDER)
            .sortWithinPartitions(*IN_ORDER)
            .write.mode("overwrite")
            .parquet(f"{folder}/{merged}")
        )
    else:
        merged = f"run={runs[0][0]}-{runs[0][1]}" if runs else ""
    for _, _, stale in all_runs:
        if not stale.endswith(f"/{merged}"):
            drop_stage(spark, stale)
    return len(runs)


def session_files(spark: SparkSession, folder: str, out_dir: str) -> DataFrame:
    """Write the store as one JSONL file per session, ``<project>/<session>``, in order of epoch
    and seq; one row (layer, path, output_bytes, lines, parts) per file.

    Lines are numbered by epochs of a session, not by a window over a session, and go to
    parts by ranges, so no session meets in one task.
    """
    lines = stored_records(spark, folder).select(
        F.lit("raw-trace").alias("layer"), F.concat_ws("/", *PARTITIONS).alias("path"), "epoch", "seq",
        F.coalesce("value", F.lit("")).alias("value"),
    )
    chunk = F.col("epoch") * (1 << 40) + F.floor(F.greatest(F.coalesce("seq", F.lit(0)), F.lit(0)) / ROWS_PER_CHUNK)
    numbered = materialize(number_rows(lines, ["layer", "path"], ["epoch", "seq", "value"], chunk, "row"), "raw-lines")
    size = F.octet_length("value").cast("bigint")
    ordered = numbered.withColumns({"line_bytes": size, "block_start": F.lit(0).cast("bigint"), "file_bytes": F.lit(-2).cast("bigint"), "row": F.col("row").cast("bigint")})
    keys = ("layer", "path")
    parts_folder = stage_path(spark, "raw-parts")
    placed = ordered.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row")
    parts = materialize(write_parts(placed, parts_folder, "value"), "raw-part-list")
    files = numbered.groupBy(*keys).agg(F.sum(size + 1).alias("file_bytes"))
    written = materialize(publish(files, parts, parts_folder, out_dir), "raw-published")
    drop_stage(spark, parts_folder)
    return written
