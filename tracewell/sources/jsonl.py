"""JSONL session files and raw traces as tables of lines."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .files import list_files

SESSIONS, RAW_TRACES = "session", "raw-trace"
OUTPUT_FOLDER = {SESSIONS: "sessions", RAW_TRACES: "raw-traces"}
LINES = "value string, line_bytes bigint, file string, file_bytes bigint, block_start bigint, row bigint"
LINE_ORDER = ("block_start", "row")


def read_lines(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """Every line of the matching files below ``root``; none if there is no such folder.

    (block_start, row) orders the lines of a file, also where a large file is read in
    several splits.  Lines end with a line feed, or a carriage return and one, which are no part
    of ``value``; ``line_bytes`` counts the return.
    """
    try:
        files = (
            spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .option("lineSep", "\n")
            .text(root)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LINES)
    return files.select(
        F.regexp_replace("value", r"\r\z", "").alias("value"),
        F.octet_length("value").cast("bigint").alias("line_bytes"),
        # a plus sign is one in a path, not a space
        F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row"),
    )


def relative_path(file: Column, root: str, layer: str) -> Column:
    """Path of a file below its source root, under the folder of its layer."""
    tail = F.element_at(F.split(file, "/"), -1)
    at = F.instr(file, root.rstrip("/") + "/")
    below = F.when(at > 0, file.substr(at + len(root.rstrip("/")) + 1, F.length(file))).otherwise(tail)
    return F.concat(F.lit(OUTPUT_FOLDER[layer] + "/"), below)


def qualified(spark: SparkSession, root: str) -> str:
    """The root as paths of its files show it: absolute, without scheme and host."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toUri().getPath()


def read_layers(
    spark: SparkSession,
    sessions_dir: str | None,
    raw_trace_dir: str | None,
    glob: str = "*.jsonl",
) -> DataFrame:
    """Session and raw-trace lines in one table; a layer without a folder is left out."""
    layers = [
        read_lines(spark, root, glob).select(
            F.lit(layer).alias("layer"), relative_path(F.col("file"), qualified(spark, root), layer).alias("path"), "*"
        )
        for layer, root in ((SESSIONS, sessions_dir), (RAW_TRACES, raw_trace_dir))
        if root
    ]
    if not layers:
        return spark.createDataFrame([], f"layer string, path string, {LINES}")
    return layers[0] if len(layers) == 1 else layers[0].unionByName(layers[1])


def list_layers(
    spark: SparkSession,
    sessions_dir: str | None,
    raw_trace_dir: str | None,
    glob: str = "*.jsonl",
) -> DataFrame:
    """(layer, path, file_bytes) of all files that the lines come from, and of empty files."""
    layers = [
        list_files(spark, root, glob).select(
            F.lit(layer).alias("layer"), relative_path(F.col("file"), qualified(spark, root), layer).alias("path"), "file_bytes"
        )
        for layer, root in ((SESSIONS, sessions_dir), (RAW_TRACES, raw_trace_dir))
        if root
    ]
    if not layers:
        return spark.createDataFrame([], "layer string, path string, file_bytes bigint")
    return layers[0] if len(layers) == 1 else layers[0].unionByName(layers[1])
