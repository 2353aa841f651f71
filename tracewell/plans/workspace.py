"""Stage tables: cut the lineage of long pipelines on shared storage.

A stage is written as parquet below the folder the cluster names in
``spark.checkpoint.dir`` and read back.  It survives lost executors, shortens the
plan of everything built on it, and stays columnar, so later stages still prune.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: The folder of each application that runs on one machine and names none.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    Without one this raises, except in local mode, where driver and executors are one
    process: there the application gets a folder of its own.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_DIR} names no folder; stages need one that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="run-")
    return _OWN[application]


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a stage table and return the table."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a stage's files once nothing reads them any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
