import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tracewell.plans.export import export_redacted, manifest, redact_lines
from tracewell.plans.workspace import shared_folder
from tracewell.sources.jsonl import read_layers, read_lines


def tree(lines_by_file):
    root = Path(tempfile.mkdtemp(prefix="run-"))
    for name, lines in lines_by_file.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    return root


def run(spark, root, **options):
    report = export_redacted(
        spark, str(root / "out"), str(root / "sessions"), str(root / "raw"), depth=4, **options
    ).first()
    return report, {r["path"]: r for r in spark.read.json(str(root / "out" / "manifest")).collect()}


def test_export_job(spark):
    root = tree({})
    here = str(root)
    for name, lines in {
        "sessions/p/a.jsonl": [json.dumps({"type": "m", "apiKey": "k1", "content": f"mail a@b.org {here}/sessions/p"}), "", "no json DB_PASSWORD=hunter2hunter2"],
        "sessions/p/b.txt": ["not read"],
        "raw/p/c.jsonl": [json.dumps({"type": "tool_call", "args": {"x": [1, None]}})],
    }.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
    report, rows = run(spark, root)
    assert (report.approved, report.rejected, report.files) == (2, 0, 2)
    assert set(rows) == {"sessions/p/a.jsonl", "raw-traces/p/c.jsonl"}
    # the JSON key, the address, and the assignment
    assert sum(f["count"] for f in rows["sessions/p/a.jsonl"].pre_findings) >= 2
    data = (root / "out" / "sessions" / "p" / "a.jsonl").read_text().split("\n")
    assert data.pop() == ""
    first = json.loads(data[0])
    assert first["apiKey"].startswith("[REDACTED:api-key:") and "[REDACTED:email:" in first["content"]
    assert here not in data[0] and "[PATH_ROOT]" in data[0]
    assert data[1] == "" and data[2].startswith("no json DB_PASSWORD=[REDACTED:db-password:")
    index = spark.read.json(str(root / "out" / "training-index"))
    assert index.count() == 2 and {r.format for r in index.collect()} == {"redacted-jsonl-derivative"}

    # known values are redacted and counted as well
    known = run(spark, root, secrets=[("not-json-but-known", "vault"), ("no json DB_", "label")])[1]
    assert ("label", 1) in {(f.reason, f["count"]) for f in known["sessions/p/a.jsonl"].pre_findings}
    assert known["sessions/p/a.jsonl"].status == "approved"

    # a finding of the external scanner, or a required scanner that did not run, rejects all
    scanner = spark.createDataFrame([('{"DetectorName":"X","Raw":"r"}',), ('{"level":"info","Raw":"r"}',)], "line string")
    assert run(spark, root, scanner_lines=scanner)[0].rejected == 2
    assert run(spark, root, scanner_required=True)[0].rejected == 2
    assert run(spark, root, scanner_lines=scanner.where(F.col("line").contains("level")))[0].rejected == 0


def test_missing_folders(spark):
    assert read_lines(spark, "/tmp/there-is-no-such-folder").count() == 0
    assert read_layers(spark, None, None).count() == 0


def test_raw_trace_stream_appends_once(spark):
    from tracewell.sources.raw_trace import shaped_records, stream_records

    root = tree({})
    rows = [
        ("/home/u/sessions/p/s1.jsonl", json.dumps({"type": "tool_call", "args": {"password": "hunter2"}, "text": "hi"})),
        ("/elsewhere/s2.jsonl", json.dumps({"type": "session_start"})),
        (None, json.dumps({"type": "session_start"})),
    ]
    schema = "session_file string, record string"
    spark.createDataFrame(rows, schema).write.parquet(str(root / "in"))
    source = spark.readStream.schema(schema).parquet(str(root / "in"))
    for _ in range(2):  # the second run finds nothing new
        records = shaped_records(source, "conversations", depth=3)
        stream_records(records, str(root / "raw"), str(root / "checkpoint")).awaitTermination()
    got = {(r.project, r.session, r.value) for r in spark.read.text(str(root / "raw")).collect()}
    assert got == {
        ("p", "s1.jsonl", '{"text":"hi","type":"tool_call"}'),
        ("--unknown--", "s2.jsonl", '{"type":"session_start"}'),
    }


def redacted(spark, lines):
    rows = spark.createDataFrame([("session", f"f{i:02}", v) for i, v in enumerate(lines)], "layer string, path string, value string")
    clean = redact_lines(rows)
    status = {r.path: r.status for r in manifest(clean).collect()}
    return [(r.clean, r.refused, status[r.path]) for r in clean.orderBy("path").collect()]


def nested(depth, inner):
    return '{"a":' * depth + inner + "}" * depth


def test_no_json_line_escapes_the_walk(spark):
    lines = [
        '{"a":1,"a":2,"password":"abc","note":{"apiKey":12345}}', nested(14, '{"password":"abcdefgh1"}'), nested(50, '{"password":"abcdefgh1"}'), nested(80, '{"password":"abcdefgh1"}'),
        '{"x":[{"password":"one","password":"abcdefgh1"}]}', '{"password":"abcdefgh1","n":1e400}', '{"broken": 1,', "", "null", '"mail a@b.org"',
    ]
    out = redacted(spark, lines)
    assert not any("abcdefgh1" in clean or "12345" in clean or "a@b.org" in clean for clean, _, _ in out)
    assert [refused for _, refused, _ in out] == [i == 3 for i in range(len(lines))]
    assert [status for _, _, status in out] == ["rejected" if i == 3 else "approved" for i in range(len(lines))]
    assert out[1][0].count("{") == 15 and json.loads(out[0][0])["a"] == 2


def test_numbers_and_marks_come_out_as_they_stood(spark):
    lines = ['{"a":12345678901234567890123456789012345678901234567890,"b":[1.50,-2E+5,0.1]}', '{"a":"\\ue000#12","b":3,"b":4}', '{"a":"\\ue000\\ue000#1","b":1.0}']
    out = [clean for clean, _, _ in redacted(spark, lines)]
    assert out[0] == lines[0]
    assert out[1] == '{"a":"#12","b":4}'
    assert out[2] == '{"a":"#1","b":1.0}'


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "spark://host:7077", "applicationId": "a"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
    assert shared_folder(spark)


def test_plus_signs_and_relative_roots(spark, monkeypatch):
    root = tree({"sessions/a+b.jsonl": ["{}"], "sessions/x/same.jsonl": ["{}"], "sessions/y/same.jsonl": ["{}"]})
    monkeypatch.chdir(root)
    paths = {r.path for r in read_layers(spark, str(root / "sessions"), None).collect()}
    assert paths == {"sessions/a+b.jsonl", "sessions/x/same.jsonl", "sessions/y/same.jsonl"}


def test_lines_are_read_as_templates_once(spark):
    """No level of a line costs a projection of its own, and brackets are counted only where there are enough of them."""
    rows = spark.createDataFrame([("session", nested(40, '{"password":"abcdefgh1","n":1.50}'), 1)], "layer string, value string, n int")
    out = redact_lines(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "variant" not in plan.lower()
    assert out.first().clean.startswith('{"a":' * 40 + '{"n":1.50,"password":"[REDACTED:password:')
