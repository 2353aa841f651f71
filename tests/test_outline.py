"""JSON lines as templates."""

import json
import random

import pytest

from tracewell.operators import outline as O
from tracewell.plans.export import manifest, redact_records


def any_value(rng, depth):
    if depth == 0 or rng.random() < 0.4:
        return rng.choice([1, -2.5, True, False, None, 'a"b\\', "é\n", 10**30, "", " x"])
    if rng.random() < 0.5:
        return [any_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b", "10", "9", "é", ""]) + rng.choice(["", "x"]): any_value(rng, depth - 1) for _ in range(rng.randrange(4))}


def shape(parse, text):
    try:
        return O.template(parse(text), False)
    except ValueError:
        return None


def test_the_stack_reads_what_the_library_reads():
    rng = random.Random(5)
    refused = 0
    for _ in range(1500):
        value = any_value(rng, 5)
        text = json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        assert json.loads(O.template(O._parse_deep(text), True, redact=False)[0][0]) == value
        at = rng.randrange(len(text))
        broken = text[:at] + rng.choice('{}[],:"1x \\e-.') + text[at + rng.randrange(2) :]
        assert shape(O.parse, broken) == shape(O._parse_deep, broken)
        refused += shape(O.parse, broken) is None
    assert refused > 500


@pytest.mark.parametrize("text", ["", " ", "{", "]", "[1,]", '{"a":1,}', '{"a" 1}', "{1:2}", "[1 2]", "1 2", "NaN", "01", "1.", '"\t"', '"a', '{"a":}', "[}", ',"a"', ":"])
def test_no_json(text):
    assert shape(O.parse, text) is None and shape(O._parse_deep, text) is None


def test_order_of_members():
    value = O.parse('{"b":1,"10":2,"a":3,"b":4,"9":5,"01":6,"4294967295":7}')
    names = [k for k, _ in O.members(value, False)]
    assert names == ["9", "10", "b", "a", "01", "4294967295"] and value["b"] == "4"
    assert [k for k, _ in O.members(value, True)] == sorted(names)


def clean(spark, values, **options):
    rows = spark.createDataFrame([(i, v, 7) for i, v in enumerate(values)], "n int, value string, text int")
    out = redact_records(rows, **options).orderBy("n").collect()
    assert all(r.text == 7 for r in out)
    return [r.clean for r in out]


def test_lines(spark):
    deep = '{"a":' * 3000 + '{"password":"abcdefgh1"}' + "}" * 3000
    lines = [
        None, "", "   ", '{"b": "mail a@b.org", "a": [1.50, null, true]}  ', "mail a@b.org", '{"broken": 1, "mail": "a@b.org"',
        deep, '{"password":null,"clientSecret":true,"apiKey":12345678901234567890,"n":1e400}', "null", "[]", '"a@b.org"', '{"x":"\\ud800","\\udc00":"\\ue000#1"}',
        '{"secret":{"b":[1],"a":"x\\"y"}}', '{"imageData":"abc"}', "x y " * 75_000,
    ]
    out = clean(spark, lines)
    assert out[:3] == lines[:3] and out[8:10] == lines[8:10]
    assert out[3].startswith('{"a":[1.50,null,true],"b":"mail [REDACTED:email:') and out[4].startswith("mail [REDACTED:email:")
    assert not any(s in line for line in out if line for s in ("a@b.org", "abcdefgh1", "12345678901"))
    assert out[6].count("{") == 3001 and "[REDACTED:password:" in out[6]
    assert json.loads(out[7])["password"] is None and json.loads(out[7])["clientSecret"].startswith("[REDACTED:client-secret:") and '"n":1e400' in out[7]
    assert json.loads(out[11]) == {"x": "�", "�": "#1"}
    import hashlib
    digest = hashlib.sha256(b'{"a":"x\\"y","b":[1]}').hexdigest()[:10]
    assert out[12] == f'{{"secret":"[REDACTED:secret:{digest}]"}}'
    assert json.loads(out[13])["imageData"].endswith("(3 chars)]") or json.loads(out[13])["imageData"].endswith("(3 chars)")
    assert out[14] == lines[14]
    cut = clean(spark, ['{"a":{"b":{"c":1}}}', "[[1],2]"], depth=2)
    assert json.loads(cut[0])["a"]["b"].startswith("[REDACTED:structured-value:") and cut[1] == "[[1],2]"
    table = spark.createDataFrame([("known-value-1", "vault")], "value string, reason string")
    assert "[REDACTED:vault:" in clean(spark, ['{"z":1,"a":"known-value-1"}'], secrets=table, by_name=False)[0]


def test_two_values_on_a_line_are_text_and_reach_the_gate(spark):
    rows = spark.createDataFrame([("session", "p", '{"a":1} {"password":"abcdefgh1"}')], "layer string, path string, value string")
    lines = redact_records(rows)
    assert lines.first().clean.startswith('{"a":1} {') and manifest(lines).first().status == ("rejected" if "abcdefgh1" in lines.first().clean else "approved")


def test_no_lines(spark):
    assert clean(spark, []) == []
