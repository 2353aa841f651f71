"""One output file for each input file, the listing, and the status of an external scan."""

import json
import tempfile
from pathlib import Path

from tracewell.operators import gates
from tracewell.plans.export import export_redacted
from tracewell.sources.files import list_files, publish, write_parts
from tracewell.sources.jsonl import read_layers

FILES = {
    "sessions/p/ends.jsonl": b'{"password":"hunter2","n":1}\n{"n":2}\n',
    "sessions/p/bare.jsonl": b'{"n":1}\nplain text',
    "sessions/p/crlf.jsonl": b'{"n":1}\r\n\r\n  \r\ntext\r\n',
    "sessions/p/blank lines.jsonl": b"\n\n",
    "sessions/a+b%20c.jsonl": b'{"n":1}\n\n',
    "sessions/empty.jsonl": b"",
    "sessions/mark.jsonl": b'\xef\xbb\xbf{"n":1}\nx',
    "sessions/_hidden/no.jsonl": b"{}\n",
    "sessions/.no.jsonl": b"{}\n",
    "sessions/no.txt": b"{}\n",
    "raw/q/r.jsonl": "{\"n\":\"é\"}\nü".encode(),
}


def folder(files=FILES):
    root = Path(tempfile.mkdtemp(prefix="run-"))
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return root


def expected(data: bytes) -> bytes:
    return data.removeprefix(b"\xef\xbb\xbf").replace(b"\r\n", b"\n")


def test_every_file_has_its_output(spark):
    root = folder()
    for _ in range(2):  # over its own earlier output as well
        report = export_redacted(spark, str(root / "out"), str(root / "sessions"), str(root / "raw"), depth=3).first()
    names = {"raw-traces" + n[3:] if n.startswith("raw") else n: d for n, d in FILES.items() if "no." not in n}
    assert (report.files, report.approved) == (len(names), len(names))
    rows = {r["path"]: r for r in spark.read.json(str(root / "out" / "manifest")).collect()}
    index = {r["path"] for r in spark.read.json(str(root / "out" / "training-index")).collect()}
    assert set(rows) == set(names) == index
    for name, data in names.items():
        got = (root / "out" / name).read_bytes()
        want = expected(data)
        if b"hunter2" not in data:
            assert got == want, name
        assert got.count(b"\n") == want.count(b"\n")
        assert (rows[name].input_bytes, rows[name].output_bytes) == (len(data), len(got))
    first = (root / "out" / "sessions/p/ends.jsonl").read_text().splitlines()
    assert json.loads(first[0])["password"].startswith("[REDACTED:password:") and first[1] == '{"n":2}'
    placed = [p for part in ("sessions", "raw-traces") for p in (root / "out" / part).rglob("*") if p.is_file() and not p.name.endswith(".crc")]
    assert len(placed) == len(names)
    note = spark.read.text(str(root / "out" / "review")).collect()
    assert any(r.value == "Status: approved" for r in note) and any("External scan: unavailable" in r.value for r in note)


def test_parts_of_a_file_are_joined_in_order(spark):
    """Files cut into many splits, rows out of order, with and without an end of the last line."""
    lines = [f"line {i} é" + "x" * (i % 50) for i in range(3000)]
    root = folder({"s/a.jsonl": "\n".join(lines).encode(), "s/b.jsonl": ("\r\n".join(lines) + "\r\n").encode(), "s/c.jsonl": b"one"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read_layers(spark, str(root / "s"), None).write.parquet(str(root / "lines"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    kept = spark.read.parquet(str(root / "lines"))
    files = kept.select("layer", "path", "file_bytes").distinct()
    for name, ordered in (("scan", kept), ("shuffled", kept.repartition(3, "row")), ("mixed", kept.orderBy("value"))):
        parts = write_parts(ordered, str(root / name / "parts"), "value")
        parts.write.parquet(str(root / name / "list"))
        parts = spark.read.parquet(str(root / name / "list"))
        done = publish(files, parts, str(root / name / "parts"), str(root / name / "out")).collect()
        assert {r.path: r.lines for r in done} == {"sessions/a.jsonl": 3000, "sessions/b.jsonl": 3000, "sessions/c.jsonl": 1}
        assert max(r.parts for r in done) > 1
        read = {n: (root / name / "out/sessions" / f"{n}.jsonl").read_text() for n in "abc"}
        assert read == {"a": "\n".join(lines), "b": "\n".join(lines) + "\n", "c": "one"}
        assert {r.path: r.output_bytes for r in done} == {f"sessions/{n}.jsonl": len(t.encode()) for n, t in read.items()}


def test_listing(spark):
    root = folder()
    got = {Path(r.file).relative_to(root / "sessions").as_posix(): r.file_bytes for r in list_files(spark, str(root / "sessions")).collect()}
    assert got == {n.removeprefix("sessions/"): len(d) for n, d in FILES.items() if n.startswith("sessions/") and "no." not in n}
    assert list_files(spark, str(root / "nowhere")).count() == 0


def test_status_of_the_external_scan(spark):
    root = folder({"sessions/a.jsonl": b'{"type":"message","content":"safe"}\n'})
    quiet = spark.createDataFrame([('{"level":"info","Raw":"r"}',)], "line string")
    found = spark.createDataFrame([('{"DetectorName":"X","Raw":"r"}',)], "line string")

    def run(**options):
        row = export_redacted(spark, str(root / "out"), str(root / "sessions"), depth=2, **options).first()
        return row.rejected, row.external_scan

    rejected, scan = run(scanner_lines=quiet, scanner_exit_code=2)
    assert rejected == 1 and (scan.available, scan.exit_code, scan.findings) == (True, 2, 0) and "exited with status 2" in scan.warning

    def status(*args):
        return gates.scan_status(spark, *args).first()

    assert status(found, True, False, False, 0)[2:] == (True, 0, 1, None)
    skipped = status(None, False, True)
    assert (skipped.enabled, skipped.required, skipped.available, skipped.findings) == (False, False, False, 0)
    assert skipped.warning == "external scan skipped"
    assert "required" in status(None, True, True).warning and "residual scan only" in status(None).warning
    assert status(quiet, True, False, True).warning == "external scan gave a warning"
