"""Compare check queries with their SQL: python -m verification.compare [sf_dir] [name...]"""

from __future__ import annotations

import importlib
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from tracewell.deploy import ship_package
from .fixtures import TABLES
from .registry import ORACLES, QUERIES

MODULES = (
    "redaction_checks", "summary_checks", "policy_checks", "trace_checks", "export_checks",
)


def load() -> None:
    for module in MODULES:
        try:
            importlib.import_module(f"verification.{module}")
        except ModuleNotFoundError as missing:
            if not str(missing.name).startswith("verification."):
                raise


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package()
    return spark


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.9g}"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.15g}" if abs(value) < 2**53 else str(value)
    if hasattr(value, "as_tuple"):
        return f"{float(value):.9g}"
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in data)


def compare(spark: SparkSession, sf_dir: str, name: str) -> tuple[bool, str]:
    began = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    spent = time.time() - began
    if name not in ORACLES:
        return True, f"{name}: {len(got)} rows, no SQL, {spent:.1f}s"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    want = rows(columns, cursor.fetchall())
    duck = time.time() - began - spent
    if sorted(df.columns) != sorted(columns):
        return False, f"{name}: columns {sorted(df.columns)} / {sorted(columns)}"
    if got == want:
        return True, f"{name}: {len(got)} rows equal, {spent:.1f}s spark {duck:.1f}s sql"
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return False, f"{name}: {len(got)} / {len(want)} rows\n   spark {only_got}\n   sql   {only_want}"[:1500]


def main() -> int:
    load()
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if not sys.argv[2:] or any(w in n for w in sys.argv[2:])]
    spark, bad = session(), 0
    for name in names:
        try:
            ok, text = compare(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            ok, text = False, f"{name}: {type(error).__name__} {str(error)[:700]}"
        bad += not ok
        print("ok  " if ok else "BAD ", text, flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(main())
