"""The standing store of raw trace records: epochs, replays, compaction, session files."""

import tempfile
from pathlib import Path

from tracewell.sources import raw_trace as R

RECORDS = "project string, session string, seq bigint, value string"


def place():
    return Path(tempfile.mkdtemp(prefix="run-"))


def batch(spark, rows):
    return spark.createDataFrame(rows, RECORDS)


def content(spark, folder):
    return sorted((r.project, r.session, r.epoch, -1 if r.seq is None else r.seq, r.value) for r in R.stored_records(spark, str(folder)).collect())


EPOCHS = {
    0: [("p", "a.jsonl", 2, "a2"), ("p", "a.jsonl", 1, "a1"), ("q/r", "b.jsonl", None, "b")],
    1: [("p", "a.jsonl", 1, "again"), ("p", "a.jsonl", 1, "again"), ("p", "c.jsonl", 5, None)],
    2: [("p", "a.jsonl", 0, "é")],
}


def filled(spark, folder, buckets=4):
    for epoch, rows in EPOCHS.items():
        R.append_epoch(batch(spark, rows), str(folder), epoch, buckets)


def test_a_replay_adds_nothing_and_files_are_bounded(spark):
    folder = place()
    filled(spark, folder, 2)
    before = content(spark, folder)
    assert len(before) == 7
    R.append_epoch(batch(spark, EPOCHS[1]), str(folder), 1, 2)
    assert content(spark, folder) == before
    assert all(len(list(folder.glob(f"run={e}-{e}/*.parquet"))) <= 2 for e in EPOCHS)


def test_compaction(spark):
    folder = place()
    filled(spark, folder)
    before = content(spark, folder)
    # an epoch and a compaction that were lost on the way are not read
    for lost in ("run=3-3", "run=0-2"):
        (folder / lost).mkdir()
    assert content(spark, folder) == before
    assert R.compact(spark, str(folder)) == 3
    assert [p.name for p in folder.iterdir() if (p / "_SUCCESS").exists()] == ["run=0-2"]
    assert content(spark, folder) == before
    # a replay of an epoch that is in the compacted run
    R.append_epoch(batch(spark, EPOCHS[2]), str(folder), 2)
    assert content(spark, folder) == before
    assert R.compact(spark, str(folder)) == 1 and content(spark, folder) == before
    assert not (folder / "run=2-2").exists()
    R.append_epoch(batch(spark, [("z", "z", 1, "z")]), str(folder), 3)
    assert R.compact(spark, str(folder), file_bytes=1) == 2
    assert len(content(spark, folder)) == 8


def test_session_files_in_order(spark):
    folder, out = place(), place()
    filled(spark, folder)
    done = {r.path: r.lines for r in R.session_files(spark, str(folder), str(out)).collect()}
    assert done == {"p/a.jsonl": 5, "q/r/b.jsonl": 1, "p/c.jsonl": 1}
    assert (out / "p/a.jsonl").read_text() == "a1\na2\nagain\nagain\né\n"
    assert (out / "q/r/b.jsonl").read_text() == "b\n" and (out / "p/c.jsonl").read_text() == "\n"


def test_a_large_session_keeps_its_order(spark):
    folder, out = place(), place()
    rows = spark.range(60_000).selectExpr("'p' AS project", "CASE WHEN id % 3 = 0 THEN 's' ELSE 'hot' END AS session", "1700000000000 + id * 7 AS seq", "concat('n', id) AS value")
    R.append_epoch(rows.where("seq % 2 = 0"), str(folder), 0, 4)
    R.append_epoch(rows.where("seq % 2 = 1"), str(folder), 1, 4)
    R.compact(spark, str(folder), file_bytes=100_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges, so several parts
    try:
        done = R.session_files(spark, str(folder), str(out)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.path: r.lines for r in done} == {"p/s": 20_000, "p/hot": 40_000} and max(r.parts for r in done) > 1
    hot = [i for i in range(60_000) if i % 3]
    want = [f"n{i}" for odd in (0, 1) for i in hot if i % 2 == odd]
    assert (out / "p/hot").read_text().splitlines() == want


def test_stream(spark):
    folder, source, checkpoint = place(), place(), place()
    for part, (epoch, rows) in enumerate(EPOCHS.items()):
        batch(spark, rows).coalesce(1).write.mode("append").parquet(str(source / "in"))
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(RECORDS).option("maxFilesPerTrigger", 1).parquet(str(source / "in"))
        R.stream_epochs(stream, str(folder), str(checkpoint), 2).awaitTermination()
    assert sorted(r[:2] + r[3:] for r in content(spark, folder)) == sorted(
        (p, s, -1 if n is None else n, v) for rows in EPOCHS.values() for p, s, n, v in rows)


def test_empty_store(spark):
    folder = place()
    assert R.stored_records(spark, str(folder / "none")).count() == 0
    assert R.compact(spark, str(folder)) == 0
    R.append_epoch(batch(spark, []), str(folder), 0)
    assert R.stored_records(spark, str(folder)).count() == 0
    assert R.session_files(spark, str(folder), str(folder / "out")).count() == 0
