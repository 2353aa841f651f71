"""Known secrets from a table: equal to replacing them one by one, and in no plan."""

import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tracewell.functions import redaction as R
from tracewell.operators import known_secrets as K


def table(spark, rows):
    return spark.createDataFrame(rows, "value string, reason string")


def one_by_one(spark, secrets, texts):
    marks = {r.value: r.mark for r in K.prepared(secrets).collect()}
    ordered = sorted(marks, key=lambda v: (-len(v), v))
    out = []
    for text in texts:
        for value in ordered if text else ():
            text = text.replace(value, marks[value])
        out.append(text)
    return out


@pytest.mark.parametrize("limit", [40, 2_000_000])
def test_equal_to_one_by_one(spark, monkeypatch, limit):
    monkeypatch.setattr(K, "BLOCK_CHARACTERS", limit)  # several blocks, and one
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    values = [word(rng.randint(8, 12)) for _ in range(60)] + ["REDACTED", "EDACTED:vault", "]abababab", "a" * 8, "a" * 9]
    secrets = table(spark, [(v, rng.choice(["vault", "apiKey", None])) for v in values] + [(None, "x"), ("short", "x"), ("  aaaabbbb\n", "spaced"), (values[0], "zzz"), ("y" * 20_001, "long")])
    texts = [word(rng.randint(0, 120)) for _ in range(150)] + ["", None, "a" * 5000, "x[REDACTED:vault:abc] aaaabbbb"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("list", F.array("text", F.lit("aaaabbbb"), F.lit(None).cast("string")))
    want = one_by_one(spark, secrets, texts)
    got = {r.i: r for r in K.redact_known(df, "text", "list", secrets=secrets).collect()}
    assert [got[i].text for i in range(len(texts))] == want
    assert [got[i].list[0] for i in range(len(texts))] == want
    assert all(r.list[2] is None and r.list[1].startswith("[REDACTED:") for r in got.values())


def test_many_secrets_stand_in_no_plan(spark):
    secrets = spark.range(50_000).select(F.concat(F.lit("secret-value-"), F.format_string("%08d", "id")).alias("value"), F.lit("vault").alias("reason"))
    df = spark.createDataFrame([(i, f"x secret-value-{i * 7:08d} y secret-value-99999999") for i in range(200)], "i bigint, text string")
    out = R.redact_columns(df, "text", secrets=secrets)
    said = io.StringIO()
    with redirect_stdout(said):
        out.explain("extended")
    assert "secret-value-0" not in said.getvalue() and len(said.getvalue()) < 200_000
    rows = out.collect()
    assert all("[REDACTED:vault:" in r.text and f"{r.i * 7:08d}" not in r.text and r.text.endswith("secret-value-99999999") for r in rows)


def test_the_table_gives_what_the_list_gives(spark):
    pairs = [("hunter2hunter2", "vault"), ("known-secret-value", "cloudKey"), ("known-secret", "label")]
    df = spark.createDataFrame([("hunter2hunter2 known-secret-value known-secret a@b.org",), (None,)], "text string")
    assert R.redact_columns(df, "text", secrets=pairs).collect() == R.redact_columns(df, "text", secrets=table(spark, pairs)).collect()


def test_no_secrets(spark):
    df = spark.createDataFrame([("text",)], "text string")
    assert K.redact_known(df, "text", secrets=table(spark, [])).collect() == df.collect()
    assert K.redact_known(df.limit(0), "text", secrets=table(spark, [("value-of-it", "r")])).collect() == []
