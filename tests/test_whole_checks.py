"""Check queries over whole tables and whole texts, against their SQL and on odd rows."""

from verification.compare import compare, load
from verification.registry import QUERIES

load()
SF = "/root/testdata/sf0.001"


def test_policy_matrix_of_all_fields_and_rows(spark):
    ok, text = compare(spark, SF, "policy_matrix_all_fields")
    assert ok, text
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    out = QUERIES["policy_matrix_all_fields"](spark, SF)
    assert out.count() == 7 * rows.count()
    unknown = out.filter("conv_id % 5 = 4")
    assert unknown.count() == 7 * rows.filter("conv_id % 5 = 4").count() > 0
    assert unknown.filter("NOT captured OR captured IS NULL").count() == 0


def test_tool_arguments_of_whole_texts(spark, tmp_path):
    ok, text = compare(spark, SF, "tool_arguments_whole")
    assert ok, text
    value = 'say "a\\b"\n\tthen \r\n\u00e9\U0001f600 $.path {x} [0] \x01 ' * 200 + "end"
    made = spark.createDataFrame([(1, n, "user", value) for n in range(8)], "conv_id bigint, turn bigint, role string, text string")
    made.write.parquet(f"{tmp_path}/conversations.parquet")
    out = {r.turn: r.summary for r in QUERIES["tool_arguments_whole"](spark, str(tmp_path)).collect()}
    want = [value, f"{value}#1:", f"{value}#1:2", value, value, f"{value} | more", '{"count":6}', "[7]"]
    assert out == dict(enumerate(want))


def test_safe_remote_path_of_long_addresses(spark, tmp_path):
    long = "https://" + "a/" * 1000
    urls = [long + "b.git", long + "../c", long + "d"]
    spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    out = {r.page_id: r.path for r in QUERIES["safe_remote_path"](spark, str(tmp_path)).collect()}
    assert out == {0: "a/" * 1000 + "b", 1: None, 2: "a/" * 1000 + "d"}
    ok, text = compare(spark, SF, "safe_remote_path")
    assert ok, text
