"""Sources, sinks, the export job and delivery."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as Ty

from tracewell.operators import delivery as D, records
from tracewell.operators.running import number_rows
from tracewell.plans import export as E
from tracewell.plans.workspace import shared_folder
from tracewell.sources import jsonl, raw_trace
from tracewell.streaming import sessions as S
from . import fixtures as V
from .registry import check
from .sqltext import chain, finding_rows, mark, q, redaction_steps
from .policy_checks import js, obj
from .trace_checks import LIFE, LIFE_ROLLUP

_STEPS = redaction_steps()

# One "file" per source; JSON lines, plain lines and blank lines.
_LINES = V.SECRET_TEXT.replace("SELECT doc_id, source,", "SELECT doc_id, source, lang,")


def _lines(spark, sf):
    rows = V.run(spark, sf, _LINES)
    n = F.col("doc_id")
    record = F.to_json(F.struct(F.col("text").alias("content"), F.col("lang").alias("secretKey"), n.alias("n")))
    plain = F.concat(F.lit("/data/root/x "), F.regexp_replace("text", r"[\r\n]+", " "))
    value = F.when(n % 7 == 0, F.lit("  ")).when(n % 3 > 0, record).otherwise(plain)
    return rows.select(
        F.when(n % 2 == 0, F.lit(jsonl.SESSIONS)).otherwise(F.lit(jsonl.RAW_TRACES)).alias("layer"),
        F.col("source").alias("path"), n.alias("row"), F.lit(0).alias("block_start"), value.alias("value"),
    )


_SPARK_RECORD = f"concat('{{\"content\":', CAST({js('text')} AS VARCHAR), ',\"secretKey\":', CAST({js('lang')} AS VARCHAR), ',\"n\":', CAST(doc_id AS VARCHAR), '}}')"
_VALUE = f"CASE WHEN doc_id % 7 = 0 THEN '  ' WHEN doc_id % 3 > 0 THEN {_SPARK_RECORD} ELSE concat('/data/root/x ', regexp_replace(text, '[\\r\\n]+', ' ', 'g')) END"
_BASE = f"SELECT doc_id, source, lang, CASE WHEN doc_id % 2 = 0 THEN 'session' ELSE 'raw-trace' END AS layer, {_VALUE} AS value, CASE WHEN doc_id % 3 > 0 THEN text ELSE concat('/data/root/x ', regexp_replace(text, '[\\r\\n]+', ' ', 'g')) END AS text FROM ({_LINES}) AS l"
_CLEAN_RECORD = obj(("content", js("text"), "true"), ("n", "doc_id", "true"), ("secretKey", js(mark(q("secret-key"), "lang")), "true"))
_CLEAN = chain(_BASE, "doc_id, source, lang, layer, value", _STEPS) + f""", clean_lines AS (SELECT doc_id, layer, source AS path, value,
  CASE WHEN doc_id % 7 = 0 THEN value WHEN doc_id % 3 > 0 THEN replace({_CLEAN_RECORD}, '/data/root', '[PATH_ROOT]') ELSE replace(text, '/data/root', '[PATH_ROOT]') END AS clean FROM s{len(_STEPS)})"""


def _clean(spark, sf):
    return E.redact_lines(_lines(spark, sf), ["/data/root", "", "/data/root"], depth=3)


@check(_CLEAN + " SELECT doc_id AS row, layer, path, sha256(clean) AS digest FROM clean_lines")
def export_lines(spark, sf):
    return _clean(spark, sf).select("row", "layer", "path", F.sha2("clean", 256).alias("digest"))


_MANIFEST = f"""WITH c AS MATERIALIZED ({_CLEAN} SELECT * FROM clean_lines),
  pre AS (SELECT layer, path, CAST(sum(n) AS BIGINT) AS n FROM ({finding_rows('SELECT layer, path, value AS text FROM c', 'layer, path')}) AS f GROUP BY ALL),
  post AS (SELECT layer, path, CAST(sum(n) AS BIGINT) AS n FROM ({finding_rows('SELECT layer, path, clean AS text FROM c', 'layer, path')}) AS f GROUP BY ALL),
  files AS (SELECT layer, path, CAST(sum(strlen(value)) AS BIGINT) AS input_bytes, CAST(sum(strlen(clean)) AS BIGINT) AS output_bytes FROM c GROUP BY ALL),
  manifest AS (SELECT files.*, coalesce(pre.n, 0) AS pre_findings, coalesce(post.n, 0) AS residual_findings, CASE WHEN post.n IS NULL THEN 'approved' ELSE 'rejected' END AS status
  FROM files LEFT JOIN pre ON pre.layer = files.layer AND pre.path = files.path LEFT JOIN post ON post.layer = files.layer AND post.path = files.path)
"""


def _total(name):
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(name, zero, lambda a, f: a + f["count"]), zero).alias(name)


@check(_MANIFEST + "SELECT * FROM manifest")
def export_manifest(spark, sf):
    rows = E.manifest(_clean(spark, sf))
    return rows.select("layer", "path", "input_bytes", "output_bytes", _total("pre_findings"), _total("residual_findings"), "status")


@check(_MANIFEST + "SELECT count(*) FILTER (status = 'approved') AS approved, count(*) FILTER (status = 'rejected') AS rejected, count(*) AS files FROM manifest")
def export_report(spark, sf):
    return E.report(E.manifest(_clean(spark, sf)))


@check(_MANIFEST + "SELECT layer, path, 'redacted-jsonl-derivative' AS format FROM manifest WHERE status = 'approved'")
def training_index(spark, sf):
    rows = E.manifest(_clean(spark, sf))
    return E.training_index(rows.where("status = 'approved'"))


_OWN_CLEAN = chain(_BASE, "doc_id, source, lang, layer, value", _STEPS) + f""", clean_lines AS (SELECT layer, source,
  CASE WHEN doc_id % 7 = 0 THEN value WHEN doc_id % 3 > 0 THEN {_CLEAN_RECORD} ELSE text END AS clean FROM s{len(_STEPS)})"""


@check(_OWN_CLEAN + """ SELECT layer, concat(CASE WHEN layer = 'session' THEN 'sessions' ELSE 'raw-traces' END, '/origin=', source) AS folder, CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(clean) + 1) AS BIGINT) AS bytes,
  CAST(sum(strlen(clean) + 1) AS BIGINT) AS listed_bytes, CAST(sum(('0x' || substr(md5(clean), 1, 8))::BIGINT) AS BIGINT) AS digest FROM clean_lines GROUP BY ALL""")
def export_data(spark, sf):
    """The whole job: files of both layers are exported, and the outputs read back where the manifest says."""
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    rows = _lines(spark, sf).select("layer", F.col("path").alias("origin"), "value")
    roots = {jsonl.SESSIONS: f"{folder}/in/sessions", jsonl.RAW_TRACES: f"{folder}/in/raw"}
    for layer, root in roots.items():
        rows.where(F.col("layer") == layer).drop("layer").write.partitionBy("origin").text(root)
    E.export_redacted(spark, f"{folder}/out", *roots.values(), glob="*.txt", depth=3)
    listed = spark.read.schema("layer string, path string, output_bytes bigint").json(f"{folder}/out/manifest")
    back = jsonl.read_layers(spark, *[f"{folder}/out/{place}" for place in jsonl.OUTPUT_FOLDER.values()], "*.txt")
    digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    files = back.groupBy("layer", "path").agg(F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.sum(digest).alias("digest"))
    return listed.join(files, ["layer", "path"]).groupBy("layer", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(
        F.sum("lines").alias("lines"), F.sum("bytes").cast("bigint").alias("bytes"), F.sum("output_bytes").alias("listed_bytes"), F.sum("digest").alias("digest"))


_REPEATED = """SELECT 'session' AS layer, concat('c', CAST(conv_id AS VARCHAR(20))) AS path, conv_id, turn, concat('{"a":1,"a":', CAST(turn AS VARCHAR(20)), ',"password":"p', CAST(turn AS VARCHAR(20)),
  'x","note":{"apiKey":1,"apiKey":', CAST(conv_id AS VARCHAR(20)), '}}') AS value FROM conversations"""


def _hash(text: str) -> str:
    return f"substr(sha256({text}), 1, 10)"


@check(f"""SELECT conv_id, turn, concat('{{"a":', CAST(turn AS VARCHAR), ',"note":{{"apiKey":"[REDACTED:api-key:', {_hash("CAST(conv_id AS VARCHAR)")}, ']"}},"password":"[REDACTED:password:', {_hash("concat('p', CAST(turn AS VARCHAR), 'x')")}, ']"}}') AS clean, false AS refused
  FROM ({_REPEATED}) AS l""")
def export_repeated_keys(spark, sf):
    """Lines that repeat a key, at the top and below, are walked with its last value."""
    return E.redact_lines(V.run(spark, sf, _REPEATED)).select("conv_id", "turn", "clean", "refused")


_DEEP = """SELECT 'session' AS layer, source AS path, doc_id, concat(repeat('{"a":', CAST(doc_id % 40 AS INT)), '{"password":"', md5(text), '"}', repeat('}', CAST(doc_id % 40 AS INT))) AS value FROM documents"""


@check(f"""SELECT doc_id, concat(repeat('{{"a":', CAST(doc_id % 40 AS INT)), '{{"password":"[REDACTED:password:', {_hash("md5(text)")}, ']"}}', repeat('}}', CAST(doc_id % 40 AS INT))) AS clean FROM documents""")
def export_deep_records(spark, sf):
    """Records nested 1 to 40 deep come out whole, by default arguments."""
    return E.redact_lines(V.run(spark, sf, _DEEP)).select("doc_id", "clean")


@check(_CLEAN + " SELECT doc_id AS row, layer, path, sha256(clean) AS digest FROM clean_lines")
def export_records(spark, sf):
    """The lines of ``export_lines`` as templates."""
    rows = E.redact_records(_lines(spark, sf), ["/data/root", "", "/data/root"])
    return rows.select("row", "layer", "path", F.sha2("clean", 256).alias("digest"))


_ANY_DEPTH = """SELECT 'session' AS layer, source AS path, doc_id, concat(repeat('{"b":0,"a":[', CAST(doc_id % 500 AS INT)), '{"password":"', md5(text), '","n":1.50}', repeat(']}', CAST(doc_id % 500 AS INT))) AS value FROM documents"""


@check(f"""SELECT doc_id, concat(repeat('{{"b":0,"a":[', CAST(doc_id % 500 AS INT)), '{{"password":"[REDACTED:password:', {_hash("md5(text)")}, ']","n":1.50}}', repeat(']}}', CAST(doc_id % 500 AS INT))) AS clean FROM documents""")
def export_any_depth(spark, sf):
    """Records nested 1 to 999 deep come out whole, as they stand."""
    return E.redact_records(V.run(spark, sf, _ANY_DEPTH), by_name=False).select("doc_id", "clean")


_ORDERED = """SELECT 'session' AS layer, 'p' AS path, conv_id, turn, concat('{"z":', CAST(turn AS VARCHAR(20)), '.0,"role":"', role, '","12":{"y":null,"x":1E5},"z":', CAST(conv_id AS VARCHAR(20)),
  ',"2":[{"b":true,"a":[]}],"apiKey":{"b":1,"a":"', role, '"},"e":{}}') AS value FROM conversations"""


@check(f"""SELECT conv_id, turn, concat('{{"2":[{{"b":true,"a":[]}}],"12":{{"y":null,"x":1E5}},"z":', CAST(conv_id AS VARCHAR), ',"role":"', role, '","apiKey":"[REDACTED:api-key:',
  {_hash("concat('{\"b\":1,\"a\":\"', role, '\"}')")}, ']","e":{{}}}}') AS clean FROM conversations""")
def export_document_order(spark, sf):
    """Members in document order: indices first, a repeated key where it first stood, a hidden object hashed as it stands."""
    return E.redact_records(V.run(spark, sf, _ORDERED), by_name=False).select("conv_id", "turn", "clean")


_NUMBERS = """SELECT 'session' AS layer, 'p' AS path, o_orderkey, concat('{"z":"', o_orderpriority, '","n":', CAST(o_orderkey + 1 AS VARCHAR(20)), repeat('7', 40), ',"f":-', CAST(o_custkey AS VARCHAR(20)), '.50,"e":', CAST(o_custkey AS VARCHAR(20)), 'E+3,"password":', CAST(o_orderkey + 1 AS VARCHAR(20)), '0000000000000000,"i":7}') AS value FROM orders"""


@check(f"""SELECT o_orderkey, concat('{{"e":', CAST(o_custkey AS VARCHAR), 'E+3,"f":-', CAST(o_custkey AS VARCHAR), '.50,"i":7,"n":', CAST(o_orderkey + 1 AS VARCHAR), repeat('7', 40), ',"password":"[REDACTED:password:', {_hash("concat(CAST(o_orderkey + 1 AS VARCHAR), '0000000000000000')")}, ']","z":"', o_orderpriority, '"}}') AS clean FROM orders""")
def export_exact_numbers(spark, sf):
    """Numbers of any length and form are printed as they stood, secret ones hashed by their literal."""
    return E.redact_lines(V.run(spark, sf, _NUMBERS)).select("o_orderkey", "clean")


@check("""SELECT layer, folder, CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(value)) AS BIGINT) AS bytes, CAST(sum(('0x' || substr(md5(value), 1, 8))::BIGINT) AS BIGINT) AS digest FROM (
  SELECT 'session' AS layer, concat('sessions/lang=', lang) AS folder, concat('{"n":', CAST(doc_id AS VARCHAR), '}') AS value FROM documents UNION ALL
  SELECT 'raw-trace', concat('raw-traces/role=', role), concat('{"c":', CAST(conv_id AS VARCHAR), ',"t":', CAST(turn AS VARCHAR), '}') FROM conversations) AS l GROUP BY ALL""")
def jsonl_layers(spark, sf):
    """Both layers are written from the tables, then discovered and read back."""
    folder = f"{shared_folder(spark)}/jsonl-{uuid.uuid4().hex}"
    docs = V.read(spark, sf, "documents").select("lang", F.to_json(F.struct(F.col("doc_id").alias("n"))).alias("value"))
    talk = V.read(spark, sf, "conversations").select("role", F.to_json(F.struct(F.col("conv_id").alias("c"), F.col("turn").alias("t"))).alias("value"))
    docs.write.partitionBy("lang").text(f"{folder}/s")
    talk.write.partitionBy("role").text(f"{folder}/r")
    lines = jsonl.read_layers(spark, f"{folder}/s", f"{folder}/r", "*.txt")
    place = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    return lines.groupBy("layer", place.alias("folder")).agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("value")).cast("bigint").alias("bytes"), F.sum(digest).alias("digest")
    )


@check("SELECT page_id, concat('sessions/', CASE WHEN contains(url, '/en/') THEN substr(url, instr(url, '/en/') + 4) ELSE string_split(url, '/')[-1] END) AS path FROM pages")
def relative_output_path(spark, sf):
    pages = V.read(spark, sf, "pages")
    return pages.select("page_id", jsonl.relative_path(F.col("url"), "/en", jsonl.SESSIONS).alias("path"))


# --- raw records ------------------------------------------------------------------------


@check("""SELECT conv_id, turn, concat('own', CAST(turn AS VARCHAR)) AS type, CASE WHEN turn % 2 = 0 THEN role ELSE 'base-model' END AS model, 'base' AS provider, true AS applied FROM conversations""")
def record_envelope(spark, sf):
    rows = V.read(spark, sf, "conversations")
    n = F.col("turn")
    record = rows.select("conv_id", "turn", F.concat(F.lit("own"), n.cast("string")).alias("type"), F.when(n % 2 == 0, F.col("role")).alias("model"))
    full = records.envelope(record, {"type": F.lit("x"), "model": F.lit("base-model"), "provider": F.lit("base")})
    return full.select("conv_id", "turn", "type", "model", "provider", "redaction.applied")


@check("SELECT event_id, CAST(CAST(event_id AS HUGEINT) * 100000000000000000000 + 7 AS VARCHAR) AS big, user_id FROM events")
def big_integers(spark, sf):
    events = V.read(spark, sf, "events")
    big = F.col("event_id").cast(Ty.DecimalType(38, 0))
    wide = events.select("event_id", (big * F.lit(str(10**20)).cast(Ty.DecimalType(22, 0)) + 7).cast(Ty.DecimalType(38, 0)).alias("big"), "user_id")
    return records.big_integers_as_text(wide)


@check("SELECT page_id % 3 AS part, CASE page_id % 4 WHEN 0 THEN 'p' ELSE '--unknown--' END AS project, count(*) AS n FROM pages WHERE page_id % 4 <> 3 GROUP BY ALL")
def raw_trace_append(spark, sf):
    """Append to the partitioned sink, then count what is there."""
    n = F.col("page_id")
    file = F.when(n % 4 == 0, F.concat(F.lit("/x/sessions/p/"), (n % 3).cast("string"))).when(n % 4 < 3, (n % 3).cast("string"))
    rows = V.read(spark, sf, "pages").select(file.alias("session_file"), F.to_json(F.struct(F.lit("tool_call").alias("type"), "url")).alias("record"))
    folder = f"{shared_folder(spark)}/raw-{uuid.uuid4().hex}"
    raw_trace.append_records(raw_trace.shaped_records(rows, depth=2), folder)
    back = spark.read.text(folder)
    return back.groupBy(F.col("session").cast("bigint").alias("part"), "project").agg(F.count("*").alias("n"))


@check("""SELECT concat('p', CAST(conv_id % 3 AS VARCHAR)) AS project, count(DISTINCT conv_id) AS files, count(*) AS lines, CAST(sum(strlen(value) + 1) AS BIGINT) AS bytes, CAST(sum(place * turn) AS BIGINT) AS order_digest, CAST(sum(('0x' || substr(md5(value), 1, 8))::BIGINT) AS BIGINT) AS digest
  FROM (SELECT conv_id, turn, concat('{"c":', CAST(conv_id AS VARCHAR), ',"n":', CAST(turn AS VARCHAR), ',"role":"', role, '","type":"tool_call"}') AS value, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations) AS r GROUP BY ALL""")
def raw_trace_epochs(spark, sf):
    """Three epochs, one of them replayed, a compaction, a replay after it; then a file per session, read back in order."""
    turns = V.read(spark, sf, "conversations")
    file = F.concat(F.lit("/x/sessions/p"), (F.col("conv_id") % 3).cast("string"), F.lit("/c"), F.col("conv_id").cast("string"), F.lit(".jsonl"))
    record = F.to_json(F.struct(F.lit("tool_call").alias("type"), F.col("turn").alias("n"), F.col("conv_id").alias("c"), "role"))
    rows = turns.select(file.alias("session_file"), record.alias("record"), "turn")
    shaped = raw_trace.shaped_records(rows, order="turn", depth=2)
    folder = f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"
    epoch = F.least(F.floor(F.col("seq") / 2), F.lit(2))
    for n in (0, 1, 1, 2):
        raw_trace.append_epoch(shaped.where(epoch == n), f"{folder}/runs", n)
    raw_trace.compact(spark, f"{folder}/runs")
    raw_trace.append_epoch(shaped.where(epoch == 2), f"{folder}/runs", 2)
    raw_trace.session_files(spark, f"{folder}/runs", f"{folder}/out")
    lines = jsonl.read_lines(spark, f"{folder}/out")
    path = F.regexp_extract("file", "/out/(.*)$", 1)
    placed = number_rows(lines.select(path.alias("path"), "value", "block_start", "row"), ["path"], ["block_start", "row"], F.col("block_start"), "place")
    turn = F.get_json_object("value", "$.n").cast("bigint")
    digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    return placed.groupBy(F.split("path", "/")[0].alias("project")).agg(
        F.count_distinct("path").alias("files"), F.count("*").alias("lines"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes"),
        F.sum(F.col("place") * turn).cast("bigint").alias("order_digest"), F.sum(digest).cast("bigint").alias("digest"))


@check("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'generation-create' ELSE 'span-create' END AS type, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 5 ELSE o_orderkey END AS timestamp,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS model FROM orders UNION ALL SELECT c_custkey, 'trace-create', c_custkey, NULL FROM customer""")
def ingestion_events(spark, sf):
    orders, customers = V.read(spark, sf, "orders"), V.read(spark, sf, "customer")
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    null = F.lit(None).cast("string")
    observations = orders.select(
        k.alias("id"), F.col("o_custkey").alias("trace_id"), F.lit("x").alias("name"), F.when(k % 3 == 0, "GENERATION").otherwise("SPAN").alias("type"), null.alias("parent_id"),
        k.alias("start_ms"), F.when(k % 2 == 0, k + 5).alias("end_ms"), null.alias("input"), null.alias("output"), F.col("o_orderpriority").alias("model"), F.lit("DEFAULT").alias("level"), null.alias("status_message"),
    )
    traces = customers.select(c.alias("id"), c.alias("start_ms"), F.lit("t").alias("name"), null.alias("input"), null.alias("output"))
    events = records.ingestion_events(traces, observations)
    return events.select("id", "type", "timestamp", F.get_json_object("body", "$.model").alias("model"))


# --- delivery ---------------------------------------------------------------------------

_TRACES = "SELECT o_orderkey AS trace_id, o_orderstatus = 'F' AS completed FROM orders"
_ATTEMPTED = "SELECT l_orderkey AS trace_id FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 3 = 0"
_ACKNOWLEDGED = "SELECT l_orderkey AS trace_id FROM lineitem WHERE l_returnflag = 'R'"


@check(f"SELECT trace_id FROM ({_TRACES}) AS t WHERE completed AND trace_id NOT IN ({_ATTEMPTED})")
def delivery_candidates(spark, sf):
    return D.candidates(V.run(spark, sf, _TRACES), V.run(spark, sf, _ATTEMPTED)).select("trace_id")


@check(f"SELECT trace_id FROM ({_TRACES}) AS t WHERE trace_id NOT IN ({_ACKNOWLEDGED})")
def missing_at_sink(spark, sf):
    return D.missing_at_sink(V.run(spark, sf, _TRACES), V.run(spark, sf, _ACKNOWLEDGED)).select("trace_id")


@check(f"SELECT trace_id FROM ({_ATTEMPTED}) AS a UNION SELECT trace_id FROM ({_TRACES}) AS t WHERE completed")
def retire_traces(spark, sf):
    return D.retire(V.run(spark, sf, _ATTEMPTED), V.run(spark, sf, _TRACES).where("completed"))


_SHARDS = 16
_ROOM = D.MAX_BATCH_BYTES - D.ENVELOPE_BYTES


@check(f"""WITH RECURSIVE t AS (SELECT trace_id, sum(bytes + 1) AS bytes, trace_id % {_SHARDS} AS shard, row_number() OVER (PARTITION BY trace_id % {_SHARDS} ORDER BY trace_id) AS i FROM ({V.OBSERVATION_SIZE}) AS o GROUP BY trace_id),
  f AS (SELECT shard, i, trace_id, CAST(0 AS BIGINT) AS batch, CAST(bytes AS HUGEINT) AS used FROM t WHERE i = 1
  UNION ALL SELECT t.shard, t.i, t.trace_id, CASE WHEN f.used + t.bytes > {_ROOM} THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.used + t.bytes > {_ROOM} THEN t.bytes ELSE f.used + t.bytes END FROM f JOIN t ON t.shard = f.shard AND t.i = f.i + 1)
  SELECT trace_id, concat('s-', CAST(shard AS VARCHAR), '-', CAST(batch AS VARCHAR)) AS batch FROM f""")
def pack_batches(spark, sf):
    events = V.run(spark, sf, V.OBSERVATION_SIZE)
    packed = D.pack_batches(events, F.col("trace_id") % _SHARDS)
    return packed.select("trace_id", "batch").distinct()


_PARTS = "SELECT l_suppkey AS trace_id, l_orderkey AS order_key, l_linenumber AS seq, l_partkey AS part, CAST(floor(l_extendedprice * CASE WHEN l_orderkey % 500 = 0 THEN 40 ELSE 1 END) AS BIGINT) AS bytes FROM lineitem"


@check(f"""SELECT trace_id, batch, count(*) AS events, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT *, CASE WHEN bytes + 1 > {_ROOM // 2} THEN concat('e-', CAST(trace_id AS VARCHAR), '-', CAST(order_key AS VARCHAR), '-', CAST(seq AS VARCHAR), '-', CAST(part AS VARCHAR))
  ELSE concat('t-', CAST(trace_id AS VARCHAR), '-', CAST(before_bytes // {_ROOM // 2} AS VARCHAR)) END AS batch FROM (SELECT *, coalesce(sum(bytes + 1) OVER (PARTITION BY trace_id ORDER BY order_key, seq, part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_bytes
  FROM ({_PARTS}) AS p WHERE trace_id IN (SELECT trace_id FROM ({_PARTS}) AS q GROUP BY trace_id HAVING sum(bytes + 1) > {_ROOM})) AS b) AS c GROUP BY ALL""")
def split_large_traces(spark, sf):
    packed = D.pack_batches(V.run(spark, sf, _PARTS), D.trace_shard(_SHARDS), order=("order_key", "seq", "part"))
    return packed.where("batch NOT LIKE 's-%'").groupBy("trace_id", "batch").agg(F.count("*").alias("events"), F.sum("bytes").alias("bytes"))


@check(f"SELECT true AS within, count(*) AS events, CAST(sum(bytes) AS BIGINT) AS bytes FROM ({_PARTS}) AS p")
def packed_batch_bytes(spark, sf):
    """All batches, of small and of large traces with equal start times: none passes the limit as it is sent."""
    parts = V.run(spark, sf, _PARTS).withColumn("start", F.lit(0)).withColumn("id", F.concat_ws("/", "order_key", "seq", "part"))
    packed = D.pack_batches(parts, order=("start",), event_id="id")
    batches = packed.groupBy("batch").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("events"))
    sent = F.col("bytes") + F.col("events") * D.SEPARATOR_BYTES + D.ENVELOPE_BYTES
    return batches.agg((F.max(F.when(F.col("events") > 1, sent)) <= D.MAX_BATCH_BYTES).alias("within"), F.sum("events").alias("events"), F.sum("bytes").cast("bigint").alias("bytes"))


# --- streaming -----------------------------------------------------------------------------


@check(LIFE + """SELECT session_key, tool_call_id, seq, result FROM (SELECT *, row_number() OVER (PARTITION BY session_key, tool_call_id ORDER BY seq) AS n FROM e WHERE kind = 'tool_result') AS r WHERE n = 1""")
def streamed_first_results(spark, sf):
    """First tool results through a stream that drops later ones under a watermark."""
    events = S.as_stream(V.lifecycle(spark, sf), "first-results")
    return S.run_to_table(S.first_results(events), "first-results").select("session_key", "tool_call_id", "seq", "result")


@check(LIFE_ROLLUP + """SELECT session_key, prompt_seq, 'prompt' AS kind, CAST(prompt_seq AS VARCHAR) AS id, NULL AS parent, start_ms, end_ms, verdict AS status, verdict <> 'completed' AS is_error, reason FROM rolled WHERE verdict <> 'open'
  UNION ALL SELECT session_key, prompt_seq, 'turn', CAST(turn_index AS VARCHAR), NULL, start_ms, end_ms, CASE WHEN abandoned THEN 'abandoned' ELSE 'ended' END, abandoned OR stop_reason IS NOT NULL, NULL FROM turns WHERE NOT open
  UNION ALL SELECT session_key, prompt_seq, 'tool', tool_call_id, CAST(turn_index AS VARCHAR), start_ms, end_ms, status, is_error, NULL FROM tools WHERE status <> 'open'
  UNION ALL SELECT session_key, prompt_seq, 'generation', concat('turn:', CAST(turn_index AS VARCHAR), ':request:0'), CAST(turn_index AS VARCHAR), start_ms, coalesce(x_ms, turn_ms), CASE WHEN abandoned THEN 'abandoned' ELSE 'end' END,
  abandoned OR stop_reason IS NOT NULL, NULL FROM gens WHERE x_seq IS NOT NULL OR (abandoned AND started)""")
def streamed_observations(spark, sf):
    """Prompts, turns, generations and tools closed by the stateful session processor."""
    events = S.as_stream(V.lifecycle(spark, sf), "sessions")
    return S.run_to_table(S.closed_observations(events), "sessions")

