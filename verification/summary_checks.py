"""Summaries, usage, source identity and session files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions import identity as I, redaction as R, summaries as M, usage as U
from tracewell.operators import messages as X
from . import fixtures as V
from .registry import check
from .sqltext import chain, redaction_steps

_STEPS = redaction_steps()


@check("SELECT doc_id, CASE WHEN length(text) > 300 THEN concat(substr(text, 1, 300), '…') ELSE text END AS text FROM documents")
def truncate(spark, sf):
    docs = V.read(spark, sf, "documents")
    return docs.select("doc_id", M.truncate(F.col("text"), 300).alias("text"))


_BOUNDED = f"""SELECT doc_id, CASE WHEN length(text) > 900 THEN concat(substr(text, 1, 900), '…[truncated ', CAST(length(text) - 900 AS VARCHAR), ' chars]') ELSE text END AS text
FROM ({V.SECRET_TEXT}) AS t"""


@check(chain(_BOUNDED, "doc_id", _STEPS) + f" SELECT doc_id, CASE WHEN length(text) > 400 THEN concat(substr(text, 1, 400), '…') ELSE text END AS text FROM s{len(_STEPS)}")
def telemetry_text(spark, sf):
    rows = V.secret_text(spark, sf).select("doc_id", "text")
    return M.telemetry_text(rows, "text", 400)


@check("SELECT conv_id, turn, CAST(strlen(CAST(json_object('r', role, 'n', turn) AS VARCHAR)) AS BIGINT) AS bytes, CAST(json_object('r', role, 'n', turn) AS VARCHAR) AS json FROM conversations")
def json_text_and_bytes(spark, sf):
    rows = V.read(spark, sf, "conversations")
    json = M.safe_json(F.struct(F.col("role").alias("r"), F.col("turn").alias("n")))
    return rows.select("conv_id", "turn", M.json_bytes(json).cast("bigint").alias("bytes"), json.alias("json"))


# Content items: words of a text as text items, with images and empty items between.
def _items(spark, sf):
    rows = V.read(spark, sf, "conversations")
    words = F.split("text", " ")
    items = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i % 5 == 3, F.lit("image")).when(i % 7 == 6, F.lit("image_url")).otherwise(F.lit("text")).alias("type"),
            F.when((i % 5 != 3) & (i % 7 != 6), F.when(i % 4 == 1, F.lit("")).otherwise(w)).alias("text"),
        ),
    )
    return rows.select("conv_id", "turn", F.when(F.col("turn") % 6 == 5, F.filter(items, lambda x: x["type"] != "text")).otherwise(items).alias("items"))


_ITEMS = """
SELECT conv_id, turn, CASE WHEN turn % 6 = 5 THEN list_filter(items, lambda x: x.type <> 'text') ELSE items END AS items FROM (
  SELECT conv_id, turn, list_transform(string_split(text, ' '), lambda w, i: {
    'type': CASE WHEN (i - 1) % 5 = 3 THEN 'image' WHEN (i - 1) % 7 = 6 THEN 'image_url' ELSE 'text' END,
    'text': CASE WHEN (i - 1) % 5 <> 3 AND (i - 1) % 7 <> 6 THEN CASE WHEN (i - 1) % 4 = 1 THEN '' ELSE w END END}) AS items
  FROM conversations) AS t
"""
_TEXT_OF = "coalesce(array_to_string(list_transform(list_filter({0}, lambda x: x.type = 'text' AND x.text <> ''), lambda x: x.text), chr(10)), '')"
_IMAGES = "nullif(len(list_filter(items, lambda x: x.type IN ('image', 'image_url'))), 0)"


@check(f"SELECT conv_id, turn, {_TEXT_OF.format('items')} AS whole, {_TEXT_OF.format('items[1:20]')} AS first FROM ({_ITEMS}) AS i")
def content_text(spark, sf):
    return _items(spark, sf).select(
        "conv_id", "turn", M.content_text(F.col("items")).alias("whole"), M.content_text(F.col("items"), 20).alias("first")
    )


@check(f"SELECT conv_id, turn, {_IMAGES} AS images FROM ({_ITEMS}) AS i")
def image_blocks(spark, sf):
    return _items(spark, sf).select("conv_id", "turn", M.image_blocks(F.col("items")).alias("images"))


_TOOL_CONTENT = f"concat_ws(chr(10), nullif({_TEXT_OF.format('items')}, ''), CASE WHEN {_IMAGES} IS NOT NULL THEN concat('[', CAST({_IMAGES} AS VARCHAR), ' image content block(s) from tool result]') END)"


@check(chain(f"SELECT conv_id, turn, {_TOOL_CONTENT} AS text FROM ({_ITEMS}) AS i", "conv_id, turn", _STEPS) + f" SELECT conv_id, turn, text FROM s{len(_STEPS)}")
def tool_content(spark, sf):
    rows = _items(spark, sf).select("conv_id", "turn", M.tool_content(F.col("items")).alias("text"))
    return R.redact_columns(rows, "text")


@check(f"SELECT conv_id, turn, coalesce(nullif({_TEXT_OF.format('items')}, ''), concat('turn ', CAST(turn AS VARCHAR))) AS text FROM ({_ITEMS}) AS i")
def tool_result(spark, sf):
    other = F.concat(F.lit("turn "), F.col("turn").cast("string"))
    return _items(spark, sf).select("conv_id", "turn", M.tool_result(other, F.col("items")).alias("text"))


def _payload(spark, sf, head):
    """JSON tool arguments of each message with the value ``head``, of a different form per turn."""
    rows = V.read(spark, sf, "conversations").withColumn("head", head)
    h, n = F.col("head"), F.col("turn")
    forms = [
        ("bash", F.struct(h.alias("command"))),
        ("read", F.struct(h.alias("path"), n.alias("offset"))),
        ("read", F.struct(h.alias("path"), n.alias("limit"))),
        ("edit", F.struct(h.alias("path"), F.col("text").alias("body"))),
        ("web_search", F.struct(h.alias("query"))),
        ("web_search", F.struct(F.array(h, F.lit("more")).alias("queries"))),
        ("other", F.struct(n.alias("count"))),
    ]
    tool, args = F.lit("none"), F.to_json(F.array(n))
    for i, (name, form) in enumerate(forms):
        tool = F.when(n % 8 == i, F.lit(name)).otherwise(tool)
        args = F.when(n % 8 == i, F.to_json(form)).otherwise(args)
    return rows.select("conv_id", "turn", tool.alias("tool"), args.alias("args"))


@check("""SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN h WHEN 1 THEN concat(h, '#', CAST(turn AS VARCHAR), ':') WHEN 2 THEN concat(h, '#1:', CAST(turn AS VARCHAR))
  WHEN 3 THEN h WHEN 4 THEN h WHEN 5 THEN concat(h, ' | more') WHEN 6 THEN concat('{"count":', CAST(turn AS VARCHAR), '}') ELSE concat('[', CAST(turn AS VARCHAR), ']') END AS summary
  FROM (SELECT conv_id, turn, substr(text, 1, 20) AS h FROM conversations) AS c""")
def tool_arguments(spark, sf):
    return _payload(spark, sf, F.substring("text", 1, 20)).select("conv_id", "turn", M.tool_arguments(F.col("tool"), F.col("args")).alias("summary"))


@check("""SELECT conv_id, turn, CASE turn % 8 WHEN 0 THEN text WHEN 1 THEN concat(text, '#', CAST(turn AS VARCHAR), ':') WHEN 2 THEN concat(text, '#1:', CAST(turn AS VARCHAR))
  WHEN 3 THEN text WHEN 4 THEN text WHEN 5 THEN concat(text, ' | more') WHEN 6 THEN concat('{"count":', CAST(turn AS VARCHAR), '}') ELSE concat('[', CAST(turn AS VARCHAR), ']') END AS summary
  FROM conversations""")
def tool_arguments_whole(spark, sf):
    """As tool_arguments, of the whole texts."""
    return _payload(spark, sf, F.col("text")).select("conv_id", "turn", M.tool_arguments(F.col("tool"), F.col("args")).alias("summary"))


@check("""SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN text WHEN 1 THEN text WHEN 2 THEN '[1 content item(s)]' WHEN 3 THEN '[object content]' ELSE '' END AS summary FROM conversations""")
def message_content(spark, sf):
    rows = V.read(spark, sf, "conversations")
    t, n = F.col("text"), F.col("turn")
    item = F.struct(F.lit("text").alias("type"), t.alias("text"))
    content = (
        F.when(n % 5 == 0, F.regexp_extract(F.to_json(F.struct(t.alias("x"))), r'^\{"x":(.*)\}$', 1))
        .when(n % 5 == 1, F.to_json(F.struct(F.array(item).alias("content"))))
        .when(n % 5 == 2, F.to_json(F.array(F.struct(F.lit("image").alias("type")))))
        .when(n % 5 == 3, F.to_json(F.struct(n.alias("n"))))
        .otherwise(F.lit("null"))
    )
    return rows.select("conv_id", "turn", M.message_content(content).alias("summary"))


_RECENT = 4


@check(f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations)
  SELECT conv_id, turn AS seq, role, text AS content FROM n WHERE back <= {_RECENT}
  UNION ALL SELECT DISTINCT conv_id, CAST(NULL AS BIGINT), 'system', concat('[truncated ', CAST(total - {_RECENT} AS VARCHAR), ' earlier message(s)]') FROM n WHERE total > {_RECENT}""")
def recent_message_rows(spark, sf):
    rows = V.read(spark, sf, "conversations").select("conv_id", F.col("turn").alias("seq"), "role", F.col("text").alias("content"))
    return X.recent_message_rows(rows, ["conv_id"], "seq", _RECENT)


@check(f"""WITH m AS (SELECT conv_id, list({{'role': role, 'content': text}} ORDER BY turn) AS ms FROM conversations GROUP BY conv_id)
  SELECT conv_id, array_to_string(list_transform(list_concat(CASE WHEN len(ms) > {_RECENT} THEN [{{'role': 'system', 'content': concat('[truncated ', CAST(len(ms) - {_RECENT} AS VARCHAR), ' earlier message(s)]')}}] ELSE [] END,
  ms[greatest(1, len(ms) - {_RECENT - 1}):]), lambda x: concat(x.role, ':', x.content)), '|') AS window_text FROM m""")
def recent_messages(spark, sf):
    rows = V.read(spark, sf, "conversations")
    by_request = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("ms")
    )
    messages = F.transform("ms", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    shown = by_request.select("conv_id", M.recent_messages(messages, _RECENT).alias("w"))
    return shown.select("conv_id", F.array_join(F.transform("w", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|").alias("window_text"))


@check("""SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat('m', CAST(turn AS VARCHAR)) ELSE 'fallback' END AS model, CASE WHEN turn % 3 > 0 THEN turn % 4 END AS messages,
  CASE WHEN turn % 2 = 0 THEN CASE WHEN turn % 3 > 0 THEN 'model,messages,text' ELSE 'model,text' END ELSE CASE WHEN turn % 3 > 0 THEN 'messages,text' ELSE 'text' END END AS keys FROM conversations""")
def provider_payload(spark, sf):
    rows = V.read(spark, sf, "conversations")
    n = F.col("turn")
    messages = F.when(n % 3 > 0, F.filter(F.array(*[F.struct(F.lit(i).alias("i")) for i in range(4)]), lambda m: m["i"] < n % 4))
    payload = F.to_json(F.struct(F.when(n % 2 == 0, F.concat(F.lit("m"), n.cast("string"))).alias("model"), messages.alias("messages"), F.col("text").alias("text")))
    s = M.provider_payload(payload, F.lit("fallback"))
    return rows.select("conv_id", "turn", s.alias("s")).select(
        "conv_id", "turn", "s.model", F.col("s.messageCount").alias("messages"), F.array_join("s.keys", ",").alias("keys")
    )


@check("""SELECT doc_id, CASE WHEN length(line) > 500 THEN concat(substr(line, 1, 499), '…') ELSE line END AS line FROM
  (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS line FROM documents) AS d""")
def diagnostic_line(spark, sf):
    docs = V.read(spark, sf, "documents")
    return docs.select("doc_id", M.diagnostic(F.col("text")).alias("line"))


_LINE = "CASE WHEN length({0}) > {1} THEN concat(substr({0}, 1, {1} - 1), '…') ELSE {0} END"
_WIDE_LINE = _LINE.format("trim(regexp_replace(html, '\\s+', ' ', 'g'))", 500)


@check(f"""SELECT page_id, concat_ws(', ', CASE WHEN page_id % 2 = 0 THEN concat('id=', {_LINE.format('url', 120)}) END, CASE WHEN page_id % 3 = 0 THEN concat('status=', CAST(page_id AS VARCHAR)) END,
  CASE WHEN page_id % 5 > 0 THEN concat('message=', {_WIDE_LINE}) END) AS summary FROM pages""")
def error_summary(spark, sf):
    pages = V.read(spark, sf, "pages")
    n = F.col("page_id")
    return pages.select("page_id", M.error_summary(
        F.when(n % 2 == 0, F.col("url")), F.when(n % 3 == 0, n), F.when(n % 5 > 0, F.col("html")), F.lit(None).cast("string")
    ).alias("summary"))


_ATTEMPTS = "SELECT l_suppkey % 10 AS run_id, l_orderkey AS batch, l_returnflag <> 'N' AS failed, concat('code ', CAST(l_linenumber AS STRING)) AS reason FROM lineitem"


@check(f"""WITH a AS ({_ATTEMPTS}), t AS (SELECT run_id, count(*) AS total, count(*) FILTER (failed) AS failed FROM a GROUP BY run_id),
  r AS (SELECT run_id, list(DISTINCT reason ORDER BY reason) AS reasons FROM a WHERE failed GROUP BY run_id)
  SELECT t.run_id, concat('ingestion failed for ', CAST(t.failed AS VARCHAR), '/', CAST(total AS VARCHAR), ' batch(es): ', array_to_string(reasons[1:3], '; '),
  CASE WHEN len(reasons) > 3 THEN concat(' (+', CAST(len(reasons) - 3 AS VARCHAR), ' more)') ELSE '' END) AS message FROM t JOIN r ON t.run_id = r.run_id""")
def failure_reasons(spark, sf):
    return X.failure_reasons(V.run(spark, sf, _ATTEMPTS), ["run_id"], "failed", "reason")


# Headers and metadata as maps from page and conversation columns.
_HEADER_SQL = """SELECT page_id, unnest(['Content-Type', 'X-Secret', 'SERVER', 'Retry-After', 'Date']) AS k, unnest([lang, 'hidden', html, CAST(page_id AS VARCHAR), substr(html, 1, 200)]) AS v
  FROM (SELECT page_id, html, url AS lang FROM pages) AS p"""


@check(f"SELECT page_id, lower(k) AS name, v AS value FROM ({_HEADER_SQL}) AS h WHERE k <> 'X-Secret' AND length(v) <= 200")
def safe_headers(spark, sf):
    pages = V.read(spark, sf, "pages")
    headers = F.create_map(
        F.lit("Content-Type"), F.col("url"), F.lit("X-Secret"), F.lit("hidden"), F.lit("SERVER"), F.col("html"),
        F.lit("Retry-After"), F.col("page_id").cast("string"), F.lit("Date"), F.substring("html", 1, 200),
    )
    return pages.select("page_id", F.explode(M.safe_headers(headers)).alias("name", "value"))


@check("""SELECT page_id, k AS name, v AS value FROM (SELECT page_id, unnest(['finishReason', 'accessKey', 'model', 'requestId']) AS k, unnest([url, 'x', html, substr(html, 1, 500)]) AS v FROM pages) AS p
  WHERE k <> 'accessKey' AND length(v) <= 500""")
def safe_provider_metadata(spark, sf):
    pages = V.read(spark, sf, "pages")
    metadata = F.create_map(
        F.lit("finishReason"), F.col("url"), F.lit("accessKey"), F.lit("x"), F.lit("model"), F.col("html"), F.lit("requestId"), F.substring("html", 1, 500)
    )
    return pages.select("page_id", F.explode(M.safe_provider_metadata(metadata)).alias("name", "value"))


@check("""SELECT conv_id, turn, k AS name, v AS value FROM (SELECT conv_id, turn, unnest(['temperature', 'max_tokens', 'reasoning_effort']) AS k, unnest([concat('0.', CAST(turn % 10 AS VARCHAR)), CAST(length(text) AS VARCHAR), role]) AS v FROM conversations) AS c
  WHERE NOT (k = 'reasoning_effort' AND turn % 2 = 1) AND NOT (k = 'temperature' AND turn % 10 = 0)""")
def model_parameters(spark, sf):
    rows = V.read(spark, sf, "conversations")
    n = F.col("turn")
    payload = F.concat(
        F.lit('{"temperature":'), F.when(n % 10 == 0, F.lit("null")).otherwise(F.concat(F.lit("0."), (n % 10).cast("string"))),
        F.lit(',"max_tokens":'), F.length("text").cast("string"), F.lit(',"secret":"x","reasoning_effort":'),
        F.when(n % 2 == 1, F.lit('["no"]')).otherwise(F.concat(F.lit('"'), F.col("role"), F.lit('"'))), F.lit("}"),
    )
    return rows.select("conv_id", "turn", F.explode(M.model_parameters(payload)).alias("name", "value"))


@check("SELECT doc_id, k AS name, v AS value FROM (SELECT doc_id, unnest(['lang', 'text', 'chars']) AS k, unnest([lang, text, CAST(n_chars AS VARCHAR)]) AS v FROM documents) AS d WHERE length(v) <= 200")
def propagated_metadata(spark, sf):
    docs = V.read(spark, sf, "documents")
    metadata = F.create_map(F.lit("lang"), F.col("lang"), F.lit("text"), F.col("text"), F.lit("chars"), F.col("n_chars").cast("string"))
    return docs.select("doc_id", F.explode(M.propagated_metadata(metadata)).alias("name", "value"))


@check("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'ERROR' END AS level, k AS name, v AS value FROM (
  SELECT conv_id, turn, unnest(['input', 'output', 'total']) AS k, unnest([length(text) + 1, turn, CASE WHEN turn % 2 = 0 THEN length(text) END]) AS v FROM conversations) AS c WHERE v IS NOT NULL""")
def observation_attributes(spark, sf):
    rows = V.read(spark, sf, "conversations")
    n = F.length("text").cast("bigint")
    total = F.when(F.col("turn") % 2 == 0, F.create_map(F.lit("total"), n, F.lit("input"), n + 1)).otherwise(F.create_map(F.lit("input"), n + 1))
    body = rows.select("conv_id", "turn", F.create_map(F.lit("input"), n, F.lit("output"), F.col("turn")).alias("usage_details"), total.alias("usage"), (F.col("turn") % 3 == 0).alias("is_error"))
    return M.observation_attributes(body).select("conv_id", "turn", "level", F.explode("usage_details").alias("name", "value"))


@check("""SELECT doc_id, array_to_string(CASE WHEN doc_id % 4 = 0 THEN list_concat(['agent', 'traced', 'runtime:local', lang], CASE WHEN doc_id % 2 = 0 THEN [concat('project:', source)] ELSE [] END, [concat('model:', lang)])
  WHEN doc_id % 2 = 0 THEN ['agent', 'traced', 'runtime:local', lang, concat('project:', source), concat('model:', lang), 'session:startup'] ELSE ['agent', 'traced', 'runtime:local', lang, concat('model:', lang), 'session:startup'] END, ',') AS tags FROM documents""")
def trace_tags(spark, sf):
    docs = V.read(spark, sf, "documents")
    n = F.col("doc_id")
    tags = M.trace_tags(
        ("agent", "traced"), F.lit("local"), F.array(F.col("lang"), F.lit("agent"), F.col("lang")),
        F.when(n % 2 == 0, F.col("source")), F.lit(""), F.col("lang"), F.when(n % 4 > 0, F.lit("startup")),
    )
    return docs.select("doc_id", F.array_join(tags, ",").alias("tags"))


@check("""SELECT page_id, array_to_string(list_filter(list_transform(string_split(replace(url, '/', ' , '), ','), lambda x: trim(x)), lambda x: x <> '')[1:3], '|') AS items FROM pages""")
def parse_list(spark, sf):
    pages = V.read(spark, sf, "pages")
    listed = F.replace(F.col("url"), F.lit("/"), F.lit(" , "))
    return pages.select("page_id", F.array_join(M.parse_list(listed, 3), "|").alias("items"))


# --- usage and cost ----------------------------------------------------------------

_UNPIVOT = "SELECT conv_id, turn, unnest([{0}]) AS name, unnest([{1}]) AS value FROM ({2}) AS u"


@check(f"SELECT conv_id, turn, name, value FROM ({_UNPIVOT.format(chr(39) + (chr(39)+', '+chr(39)).join(['input', 'output', 'input_cached_read', 'input_cached_write', 'total']) + chr(39), 'input, output, cache_read, cache_write, total', V.USAGE_SQL)}) AS x WHERE value <> 0")
def usage_details(spark, sf):
    rows = V.usage_rows(spark, sf)
    return rows.select("conv_id", "turn", F.explode(U.usage_details(F.col("usage"))).alias("name", "value"))


@check(f"SELECT conv_id, turn, name, value FROM ({_UNPIVOT.format(chr(39) + (chr(39)+', '+chr(39)).join(['input', 'output', 'total']) + chr(39), 'input, output, coalesce(nullif(total, 0), input + output)', V.USAGE_SQL)}) AS x WHERE value <> 0")
def standard_usage(spark, sf):
    rows = V.usage_rows(spark, sf)
    return rows.select("conv_id", "turn", F.explode(U.standard_usage(F.col("usage"))).alias("name", "value"))


@check(f"""SELECT conv_id, turn, name, CAST(value AS DOUBLE) AS value FROM (SELECT conv_id, turn, unnest(['input', 'total']) AS name, unnest([cost_input, cost_total]) AS value,
  coalesce(cost_input, 0) <> 0 OR coalesce(cost_total, 0) <> 0 AS any_cost FROM ({V.USAGE_SQL}) AS u) AS x WHERE any_cost AND value IS NOT NULL""")
def cost_details(spark, sf):
    rows = V.usage_rows(spark, sf)
    return rows.select("conv_id", "turn", F.explode(U.cost_details(F.col("usage.cost"))).alias("name", "value"))


@check(f"""SELECT conv_id, CAST(sum(input + cache_read + cache_write) AS BIGINT) AS tokens_in, CAST(sum(output) AS BIGINT) AS tokens_out, CAST(sum(cache_read) AS BIGINT) AS cache_read,
  CAST(sum(cache_write) AS BIGINT) AS cache_write FROM ({V.USAGE_SQL}) AS u GROUP BY conv_id""")
def tokens_per_conversation(spark, sf):
    usage = F.col("usage")
    return V.usage_rows(spark, sf).groupBy("conv_id").agg(
        F.sum(U.tokens_in(usage)).alias("tokens_in"), F.sum(usage["output"]).alias("tokens_out"),
        F.sum(usage["cacheRead"]).alias("cache_read"), F.sum(usage["cacheWrite"]).alias("cache_write"),
    )


# --- source identity ----------------------------------------------------------------

_REMOTES = """
SELECT page_id, CASE page_id % 10
  WHEN 0 THEN concat('https://user:pw@Git.Example.com/', 'team', CAST(page_id AS STRING), '/repo.git')
  WHEN 1 THEN concat('git@Host', CAST(page_id AS STRING), '.org:owner/name.git')
  WHEN 2 THEN concat('ssh://git@host.org/', CAST(page_id AS STRING), '/a/b')
  WHEN 3 THEN concat('file:///local/', CAST(page_id AS STRING))
  WHEN 4 THEN concat('https://host.org/a/../b', CAST(page_id AS STRING))
  WHEN 5 THEN concat('host.org:one', CAST(page_id AS STRING))
  WHEN 6 THEN ''
  WHEN 7 THEN 'https://host.org/'
  WHEN 8 THEN concat('git://host.org//deep/er/', CAST(page_id AS STRING), '.GIT')
  ELSE url END AS remote FROM pages
"""
_HOST = "lower(regexp_extract(remote, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1))"
_PATH = "regexp_extract(remote, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_SPLIT_REMOTE = f"""
SELECT page_id, CASE WHEN is_url AND NOT allowed THEN NULL WHEN is_url THEN {_HOST} ELSE lower(regexp_extract(remote, '^(?:[^@\\s/:]+@)?([^:\\s]+):(.+)$', 1)) END AS host,
  regexp_replace(regexp_replace(CASE WHEN is_url AND NOT allowed THEN NULL WHEN is_url THEN {_PATH} ELSE regexp_extract(remote, '^(?:[^@\\s/:]+@)?([^:\\s]+):(.+)$', 2) END, '^/+', ''), '(?i)\\.git$', '') AS path
FROM (SELECT page_id, remote, regexp_matches(remote, '^[A-Za-z][A-Za-z0-9+.-]*://') AS is_url, regexp_matches(remote, '^(?i)(https?|ssh|git)://') AS allowed FROM ({_REMOTES}) AS r) AS a
"""
_SAFE_REMOTE = f"""
SELECT page_id, CASE WHEN ok THEN host END AS host, CASE WHEN ok THEN path END AS path FROM (SELECT page_id, host, path,
  coalesce(host <> '' AND path <> '' AND len(list_filter(string_split(path, '/'), lambda p: p IN ('', '.', '..'))) = 0, false) AS ok FROM ({_SPLIT_REMOTE}) AS s) AS t
"""


@check(f"SELECT page_id, host AS git_remote_host, path AS git_remote_path FROM ({_SAFE_REMOTE}) AS r")
def sanitize_remote(spark, sf):
    rows = V.run(spark, sf, _REMOTES)
    return rows.select("page_id", I.sanitize_remote(F.col("remote")).alias("r")).select("page_id", "r.*")


@check("""SELECT page_id, CASE WHEN NOT regexp_matches(p, '(^|/)(|\\.|\\.\\.)(/|$)') THEN p END AS path FROM (SELECT page_id, regexp_replace(regexp_replace(substr(url, 9), '^/+', ''), '(?i)\\.git$', '') AS p FROM pages) AS x""")
def safe_remote_path(spark, sf):
    pages = V.read(spark, sf, "pages")
    return pages.select("page_id", I.safe_remote_path(F.expr("substr(url, 9)")).alias("path"))


@check(f"""SELECT page_id, CASE WHEN len(parts) >= 2 THEN concat(parts[-2], '/', parts[-1]) END AS repo_identity, CASE WHEN len(parts) >= 2 THEN parts[-2] END AS repo_owner,
  CASE WHEN len(parts) >= 2 THEN parts[-1] END AS repo_name FROM (SELECT page_id, list_filter(string_split(path, '/'), lambda p: p <> '') AS parts FROM ({_SAFE_REMOTE}) AS r) AS x""")
def repo_identity(spark, sf):
    rows = V.run(spark, sf, _REMOTES).select("page_id", I.sanitize_remote(F.col("remote"))["git_remote_path"].alias("path"))
    return rows.select("page_id", I.repo_identity(F.col("path")).alias("r")).select("page_id", "r.*")


_OVERRIDES = """SELECT page_id, unnest(['repo_owner', 'repo_name', 'repo_identity', 'environment', 'other', 'service_name']) AS k,
  unnest([CASE WHEN page_id % 2 = 0 THEN 'team' ELSE 'te/am' END, concat(' n', CAST(page_id AS VARCHAR), ' '), CASE WHEN page_id % 3 = 0 THEN 'a/b' ELSE 'ab' END, url, 'x', CASE WHEN page_id % 5 = 0 THEN '~home' WHEN page_id % 5 = 1 THEN 'C:\\x' ELSE html END]) AS v FROM pages"""
_KEPT_OVERRIDES = f"""SELECT page_id, k, trim(v) AS v FROM ({_OVERRIDES}) AS o WHERE k <> 'other' AND trim(v) <> '' AND length(trim(v)) <= 200 AND NOT contains(v, '://') AND NOT regexp_matches(trim(v), '^([/\\\\~]|[A-Za-z]:[/\\\\])')
  AND NOT regexp_matches(trim(v), '[\\x00-\\x1f\\x7f]') AND NOT (k IN ('repo_owner', 'repo_name') AND regexp_matches(trim(v), '[\\\\/]')) AND NOT (k = 'repo_identity' AND NOT regexp_matches(trim(v), '^[^/\\\\\\s]+/[^/\\\\\\s]+$'))"""


def _override_map(spark, sf):
    n = F.col("page_id")
    return V.read(spark, sf, "pages").withColumn("overrides", F.create_map(
        F.lit("repo_owner"), F.when(n % 2 == 0, F.lit("team")).otherwise(F.lit("te/am")),
        F.lit("repo_name"), F.concat(F.lit(" n"), n.cast("string"), F.lit(" ")),
        F.lit("repo_identity"), F.when(n % 3 == 0, F.lit("a/b")).otherwise(F.lit("ab")),
        F.lit("environment"), F.col("url"), F.lit("other"), F.lit("x"),
        F.lit("service_name"), F.when(n % 5 == 0, F.lit("~home")).when(n % 5 == 1, F.lit("C:\\x")).otherwise(F.col("html")),
    ))


@check(f"SELECT page_id, k AS name, v AS value FROM ({_KEPT_OVERRIDES}) AS o")
def safe_overrides(spark, sf):
    return _override_map(spark, sf).select("page_id", F.explode(I.safe_overrides(F.col("overrides"))).alias("name", "value"))


@check(f"""WITH o AS ({_KEPT_OVERRIDES}), r AS ({_SAFE_REMOTE}), d AS (SELECT page_id, list_filter(string_split(path, '/'), lambda p: p <> '') AS parts FROM r WHERE path IS NOT NULL),
  ranked AS (SELECT page_id, 'source_type' AS name, 'git-repo' AS value, 0 AS rank FROM pages UNION ALL SELECT page_id, 'repo_root_name', 'root', 0 FROM pages
  UNION ALL SELECT p.page_id, 'metadata_source', CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.page_id = p.page_id) THEN 'repo-file' ELSE 'git-detection' END, 0 FROM pages AS p
  UNION ALL SELECT page_id, 'git_branch', 'main', 0 FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT page_id, 'git_commit', lower(substr(sha256(html), 1, 40)), 0 FROM pages WHERE page_id % 3 > 0
  UNION ALL SELECT page_id, 'git_remote_host', host, 1 FROM r UNION ALL SELECT page_id, 'git_remote_path', path, 1 FROM r
  UNION ALL SELECT page_id, 'repo_owner', parts[-2], 2 FROM d WHERE len(parts) >= 2 UNION ALL SELECT page_id, 'repo_name', parts[-1], 2 FROM d WHERE len(parts) >= 2
  UNION ALL SELECT page_id, 'repo_identity', concat(parts[-2], '/', parts[-1]), 2 FROM d WHERE len(parts) >= 2 UNION ALL SELECT page_id, k, v, 3 FROM o
  UNION ALL SELECT a.page_id, 'repo_identity', concat(a.v, '/', b.v), 1 FROM o AS a JOIN o AS b ON a.page_id = b.page_id AND a.k = 'repo_owner' AND b.k = 'repo_name')
  SELECT page_id, name, arg_max(value, rank) AS value FROM ranked WHERE value IS NOT NULL GROUP BY page_id, name""")
def source_metadata(spark, sf):
    rows = _override_map(spark, sf).join(V.run(spark, sf, _REMOTES), "page_id")
    n = F.col("page_id")
    metadata = I.source_metadata(
        F.lit("root"), F.when(n % 2 == 0, F.lit("main")).otherwise(F.lit("")),
        F.when(n % 3 > 0, F.upper(F.substring(F.sha2("html", 256), 1, 40))).otherwise(F.lit("HEAD")), F.col("remote"), F.col("overrides"),
    )
    return rows.select("page_id", F.explode(metadata).alias("name", "value"))


# --- session files ----------------------------------------------------------------------

_FILES = """SELECT page_id, CASE page_id % 5 WHEN 0 THEN concat('/home/u/sessions/proj', CAST(page_id AS STRING), '/a/s.jsonl') WHEN 1 THEN concat('/home/u/sessions/', CAST(page_id AS STRING), '.jsonl')
  WHEN 2 THEN concat('/tmp/x', CAST(page_id AS STRING), '.jsonl.jsonl') WHEN 3 THEN '' ELSE url END AS file, CASE WHEN page_id % 10 = 3 THEN '' ELSE concat('s', CAST(page_id AS STRING)) END AS id FROM pages"""


@check(f"""SELECT page_id, regexp_replace(string_split(file, '/')[-1], '\\.jsonl', '') AS session_id, CASE WHEN contains(file, '/sessions/') THEN substr(file, 1, instr(file, '/sessions/') + 8) END AS session_root,
  CASE WHEN file <> '' THEN concat('file:', file) WHEN id <> '' THEN concat('id:', id) END AS session_key FROM ({_FILES}) AS f""")
def session_identity(spark, sf):
    f = F.col("file")
    return V.run(spark, sf, _FILES).select(
        "page_id", I.session_id(f).alias("session_id"), I.session_root(f).alias("session_root"), I.session_key(f, F.col("id")).alias("session_key")
    )


@check(f"""SELECT page_id, CASE WHEN file <> '' THEN CASE WHEN contains(below, '/') THEN regexp_extract(below, '^(.*)/[^/]*$', 1) ELSE '--unknown--' END END AS project,
  CASE WHEN file <> '' THEN CASE WHEN contains(below, '/') THEN string_split(below, '/')[-1] ELSE string_split(file, '/')[-1] END END AS session
  FROM (SELECT page_id, file, CASE WHEN contains(file, '/sessions/') THEN substr(file, instr(file, '/sessions/') + 10) END AS below FROM ({_FILES}) AS f) AS g""")
def raw_trace_path(spark, sf):
    return V.run(spark, sf, _FILES).select("page_id", I.raw_trace_path(F.col("file")).alias("p")).select("page_id", "p.project", "p.session")
