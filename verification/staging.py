"""Trace tables of the check inputs, built once per session and read by many checks."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tracewell.plans.traces import TraceTables, build_traces
from tracewell.plans.workspace import materialize
from . import fixtures as V

_BUILT: dict[tuple[str, str, str], TraceTables] = {}


def tables(spark: SparkSession, sf_dir: str, stream: str = "lifecycle") -> TraceTables:
    key = (spark.sparkContext.applicationId, sf_dir, stream)
    if key not in _BUILT:
        events = V.lifecycle(spark, sf_dir) if stream == "lifecycle" else materialize(V.random_stream(spark, sf_dir), "random-events")
        _BUILT[key] = build_traces(events)
    return _BUILT[key]
