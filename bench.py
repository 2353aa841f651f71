"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the cores.  Each query is planned and run from scratch into a sink that
reads every row; nothing is cached between queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.deploy import ship_package
from tracewell.functions.policy import Limits
from tracewell.functions.redaction import redact_columns
from tracewell.functions.scanning import count_findings
from tracewell.operators import delivery, messages, ordered, tree, trace as T
from tracewell.plans import export
from tracewell.plans.traces import build_traces
from verification import fixtures as V

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package()
    return spark


def _documents(spark: SparkSession) -> DataFrame:
    return V.read(spark, SF_DIR, "documents").select("doc_id", "source", "text").repartition(CPUS)


def redact_documents(spark):
    return redact_columns(_documents(spark), "text")


def scan_documents(spark):
    return count_findings(_documents(spark), "text", ["source"])


def redact_json_records(spark):
    record = F.to_json(F.struct("doc_id", F.struct("text", F.col("source").alias("apiKey")).alias("message")))
    return tree.shape_export(_documents(spark).select("doc_id", record.alias("record")), "record", "out", depth=4)


def shape_and_bound_records(spark):
    record = F.to_json(F.struct(F.lit("tool_call").alias("type"), F.col("text").alias("input"), F.struct("source").alias("metadata")))
    rows = _documents(spark).select("doc_id", record.alias("record"))
    return tree.shape_raw_record(
        rows, "record", "out", F.lit("tool_call"), "conversations", limits=Limits(string_chars=1000, nodes=100), depth=4
    )


def export_manifest(spark):
    docs = _documents(spark)
    record = F.to_json(F.struct(F.col("text").alias("content")))
    lines = docs.select(F.lit("session").alias("layer"), F.col("source").alias("path"), record.alias("value"))
    return export.manifest(export.redact_lines(lines, ["/data"], depth=3))


def rebuild_traces(spark):
    return build_traces(V.lifecycle(spark, SF_DIR)).traces


def prompts_of_random_stream(spark):
    return T.prompts(T.assign_prompts(V.random_stream(spark, SF_DIR)))


def recent_messages(spark):
    rows = V.read(spark, SF_DIR, "conversations").select("conv_id", F.col("turn").alias("seq"), "role", F.col("text").alias("content"))
    return messages.recent_message_rows(rows, ["conv_id"], "seq", 4)


def merge_updates(spark):
    updates = V.read(spark, SF_DIR, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("seq"), F.col("l_returnflag").alias("level"),
        F.create_map(F.col("l_linestatus"), F.col("l_shipdate").cast("string")).alias("metadata"),
    )
    return ordered.fold_updates(updates, ["id"], "seq", ["level"], ["metadata"])


def pack_batches(spark):
    return delivery.pack_batches(V.run(spark, SF_DIR, V.OBSERVATION_SIZE), delivery.trace_shard(16))


QUERIES = (
    redact_documents, scan_documents, redact_json_records, shape_and_bound_records, export_manifest,
    rebuild_traces, prompts_of_random_stream, recent_messages, merge_updates, pack_batches,
)


def main() -> None:
    spark = session()
    # Warm the JVM on another table; no timed query reads what this one read.
    warm = redact_columns(V.read(spark, SF_DIR, "benchmark").select("text"), "text")
    warm.write.format("noop").mode("overwrite").save()
    spent = {}
    for query in QUERIES:
        began = time.time()
        query(spark).write.format("noop").mode("overwrite").save()
        spent[query.__name__] = round(time.time() - began, 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(spent.values()), 3), "unit": "sec",
        "queries": spent, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": CPUS,
    }))


if __name__ == "__main__":
    main()
