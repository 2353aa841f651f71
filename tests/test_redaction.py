import hashlib

import pytest
from pyspark.sql import functions as F

from tracewell.functions import redaction as R, scanning as S
from tracewell.functions.patterns import Shape


def mark(reason, value):
    return f"[REDACTED:{reason}:{hashlib.sha256(value.encode()).hexdigest()[:10]}]"


GITHUB = "ghp_" + "a1B2" * 8
CASES = {
    "plain text stays": "plain text stays",
    f"a {GITHUB} b {GITHUB}": f"a {mark('github-token', GITHUB)} b {mark('github-token', GITHUB)}",
    "DB_PASSWORD=hunter2hunter2": f"DB_PASSWORD={mark('db-password', 'hunter2hunter2')}",
    'api_key : "quoted-value"': f'api_key:"{mark("api-key", "quoted-value")}"',
    "max_tokens=123456789": "max_tokens=123456789",
    "publicKey=abcdefghij": "publicKey=abcdefghij",
    "mail a.b@example.org": f"mail {mark('email', 'a.b@example.org')}",
    "é123-45-6789": f"é{mark('ssn', '123-45-6789')}",
    "call 415-555-1212": f"call {mark('phone-number', '415-555-1212')}",
    "card 4111-1111-1111-1111": f"card {mark('credit-card', '4111-1111-1111-1111')}",
    "card 4111-1111-1111-1112": "card 4111-1111-1111-1112",
    "f" * 100: f"{mark('long-hex-blob', 'f' * 100)}(100 chars)",
    "": "",
}


def test_texts(spark):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(CASES)], "i int, text string")
    got = {r.i: r.text for r in R.redact_columns(rows, "text").collect()}
    assert [got[i] for i in range(len(CASES))] == list(CASES.values())


def test_switched_off_and_known_secrets(spark):
    rows = spark.createDataFrame([("my-known-secret-value x@y.org",)], "text string")
    assert R.redact_columns(rows, "text", enabled=False).first().text == "my-known-secret-value x@y.org"
    secrets = [("known-secret", "short"), ("  my-known-secret-value ", "vaultKey"), ("tiny", "too short")]
    got = R.redact_columns(rows, "text", secrets=secrets).first().text
    assert got == f"{mark('vault-key', 'my-known-secret-value')} {mark('email', 'x@y.org')}"
    assert [v for v, _ in R.prepare_secrets(secrets)] == ["my-known-secret-value", "known-secret"]
    named = R.secrets_from_settings([("DB_PASSWORD", "v1"), ("MAX_TOKENS", "v2"), ("HOME", "v3")])
    assert named == [("v1", "DB_PASSWORD")]


def test_nothing_is_left_after_redaction(spark):
    rows = spark.createDataFrame([(text,) for text in CASES], "text string")
    assert S.count_findings(rows, "text", []).count() > 0
    assert S.count_findings(R.redact_columns(rows, "text"), "text", []).count() == 0


def test_scan_counts_fields_and_known_values(spark):
    text = "\"clientSecret\": \"abcdef\" known-value known-value [REDACTED:x:0123456789]"
    rows = spark.createDataFrame([(text,)], "text string")
    found = {r.reason: r["count"] for r in S.count_findings(rows, "text", [], [("known-value", "vault")]).collect()}
    assert found == {"client-secret": 1, "vault": 2}


@pytest.mark.parametrize("key,secret", [
    ("secretKey", True), ("public_key", False), ("totalTokens", False), ("accessToken", True), ("token", False), ("session_token", True), ("cookie", True),
])
def test_sensitive_keys(spark, key, secret):
    assert spark.range(1).select(R.is_sensitive_key(F.lit(key)).alias("s")).first().s is secret


def test_own_shapes(spark):
    ticket = Shape("ticket-id", r"\bTCK-\d{6}\b", needles=("TCK-",))
    rows = spark.createDataFrame([("see TCK-123456 and TCK-12",)], "text string")
    assert R.redact_columns(rows, "text", extra_shapes=[ticket]).first().text == f"see {mark('ticket-id', 'TCK-123456')} and TCK-12"
    found = S.count_findings(rows, "text", [], extra_shapes=[ticket]).collect()
    assert [(r.reason, r["count"]) for r in found] == [("ticket-id", 1)]
