import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tracewell.functions.policy import Limits
from tracewell.operators import tree as T

RECORD = {
    "type": "tool_call", "input": {"cmd": "ls", "deep": {"a": {"b": 1}}}, "text": "hello world",
    "metadata": {"systemPrompt": "sys", "x": 1}, "prompt": "p", "other": {"k1": 1, "k2": 2},
    "messages": [{"role": "user", "content": "hi"}, {"role": "system", "content": "be nice"}, "loose"],
}


def shaped(spark, policy="full-debug", record=RECORD, **options):
    rows = spark.createDataFrame([(json.dumps(record),)], "record string")
    return json.loads(T.shape_raw_record(rows, "record", "out", F.lit("tool_call"), policy, redact=False, depth=6, **options).first().out)


def test_policies(spark):
    assert shaped(spark) == RECORD
    assert shaped(spark, "metadata-only") == {"type": "tool_call", "metadata": {"x": 1}, "other": RECORD["other"]}
    prompts = shaped(spark, "prompts-only")
    assert prompts["messages"] == [{"role": "user", "content": "hi"}, {"role": "system", "content": "be nice"}]
    assert "text" not in prompts and "input" not in prompts


@pytest.mark.parametrize("limits,key,want", [
    (Limits(string_chars=3), "text", "hel"),
    (Limits(tool_chars=1), "input", {"cmd": "l", "deep": {"a": {"b": 1}}}),
    (Limits(depth=1), "input", {"cmd": "ls", "deep": "[TRUNCATED:depth]"}),
    (Limits(array_items=1), "messages", [{"role": "user", "content": "hi"}]),
    (Limits(nodes=3), "input", {"cmd": "ls", "deep": {}}),
])
def test_budgets(spark, limits, key, want):
    assert shaped(spark, limits=limits)[key] == want


def test_structural_keys_are_outside_the_budgets(spark):
    assert shaped(spark, limits=Limits(nodes=0)) == {"type": "tool_call"}
    assert shaped(spark, limits=Limits(object_keys=0)) == {"type": "tool_call"}


def test_depth_of_the_walk(spark):
    rows = spark.createDataFrame([('{"a":{"b":{"c":"x@y.org ]"}}}',), ("[1,2]",)], "j string")
    assert T.measure_depth(rows, "j") == 3
    deep = T.shape_export(rows, "j", "out", depth=2).select("out").collect()
    assert json.loads(deep[0].out)["a"]["b"].startswith("[REDACTED:structured-value:")
    assert json.loads(deep[1].out) == [1, 2]


def in_order(spark, texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    return [r.out for r in T.shape_json(rows, "j", "out", depth=6, by_name=False, **options).orderBy("i").collect()]


def test_document_order(spark):
    texts = ['{"z":1.0,"a":{"y":[],"b":2E5},"z":"\\ue000#7","10":null,"9":true}', "[3, {}]", '"s"', "no", None, '{"p\\ue00100000001":"\\ue00100000001"}']
    out = in_order(spark, texts, redact=False)
    assert out[:5] == ['{"9":true,"10":null,"z":"\ue000#7","a":{"y":[],"b":2E5}}', "[3,{}]", '"s"', None, None]
    assert json.loads(out[5]) == json.loads(texts[5])
    # budgets count as members stand; a hidden object is hashed as it stands
    assert in_order(spark, ['{"z":{"y":1,"x":2},"a":3}'], redact=False, limits=Limits(object_keys=1))[0] == '{"z":{"y":1}}'
    assert in_order(spark, ['{"z":{"y":1,"x":2},"a":3}'], redact=False, limits=Limits(nodes=3))[0] == '{"z":{"y":1}}'
    hidden = in_order(spark, ['{"apiKey":{"b":1.50,"a":["q"]}}'])[0]
    assert hidden == f'{{"apiKey":"[REDACTED:api-key:{hashlib.sha256(b'{"b":1.50,"a":["q"]}').hexdigest()[:10]}]"}}'


def test_policies_in_document_order(spark):
    rows = spark.createDataFrame([(json.dumps(RECORD),)], "record string")
    for policy in ("metadata-only", "prompts-only"):
        by_order = T.shape_raw_record(rows, "record", "out", F.lit("tool_call"), policy, redact=False, depth=6, by_name=False).first().out
        assert json.loads(by_order) == shaped(spark, policy)
        assert list(json.loads(by_order)) == [k for k in RECORD if k in json.loads(by_order)]
