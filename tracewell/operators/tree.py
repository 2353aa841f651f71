"""Redaction, capture policy and budgets on JSON documents, one narrow pipeline.

A document becomes an in-row array of nodes in document order: containers are
opened one level per projection until only leaves are left, string leaves pass
through the text redaction as an array column, and the array is joined back to
JSON.  No row leaves its partition: there is neither explode nor shuffle, so the
cost is that of a map over the input at any scale.

Objects are ordered by key (the VARIANT order), or as they stand where asked for; that is
also the order budgets count in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import patterns as P, policy as policies
from ..functions.policy import Limits
from . import literals
from ..functions.redaction import (
    bind,
    blob_placeholder,
    is_binary_key,
    is_sensitive_key,
    json_string,
    placeholder,
    redact_columns,
)

TRUNCATED = "[TRUNCATED:depth]"
OVERSIZED = "[structured-value]"

# How the children of a node get their field class.
PLAIN, RECORD, METADATA, PROVIDER, MESSAGE = "plain", "record", "metadata", "provider", "message"


def _type_of(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


class _Walk:
    """The rules of one walk; every method is an expression on node structs.

    A node is (path, key, state, v, mode, field, level, counted).  Its state is
    ``todo`` (a container to open), ``{`` or ``[`` (opened), ``}`` or ``]``
    (closed), ``text`` (string leaf), ``done`` (other leaf), ``deep`` (cut by the
    depth budget), ``hide`` or ``hide_blob`` (masked by its key).
    """

    def __init__(
        self,
        redact: bool,
        limits: Limits,
        field_of: Callable[[Column], Column] | None,
        captured: Callable[[Column], Column],
        marked: bool = False,
        by_name: bool = True,
    ):
        self.redact = redact
        self.marked = marked
        self.by_name = by_name
        self.limits = limits
        self.field_of = field_of
        self.captured = captured
        self.paths = field_of is not None or limits != Limits()

    def root(self, v: Column) -> Column:
        no_path = F.array().cast("array<int>")
        no_text = F.lit(None).cast("string")
        kind = self._kind_of(v)
        state = self._plain_state(kind)
        mode = F.lit(PLAIN) if self.field_of is None else F.when(
            kind == "OBJECT", F.lit(RECORD)
        ).otherwise(F.lit(PLAIN))
        return F.array(
            F.struct(
                no_path.alias("path"),
                no_text.alias("key"),
                state.alias("state"),
                v.alias("v"),
                mode.alias("mode"),
                no_text.alias("field"),
                F.lit(0).alias("level"),
                F.lit(self.field_of is None).alias("counted"),
            )
        )

    def _kind_of(self, v: Column) -> Column:
        """The type of a value; a marked string is the number it stands for."""
        kind = _type_of(v)
        if not self.marked:
            return kind
        number = (kind == "STRING") & literals.is_marked(F.try_variant_get(v, "$", "string"))
        return F.when(number, F.lit("NUMBER")).otherwise(kind)

    @staticmethod
    def _plain_state(kind: Column) -> Column:
        return (
            F.when(kind == "STRING", F.lit("text"))
            .when(kind.isin("OBJECT", "ARRAY"), F.lit("todo"))
            .otherwise(F.lit("done"))
        )

    def _state(self, f: Column, level: Column, plain: Column) -> Column:
        state = self._plain_state(f["kind"])
        if self.limits.depth is not None:
            deep = (state == "todo") & (level >= self.limits.depth) & plain
            state = F.when(deep, F.lit("deep")).otherwise(state)
        if not self.redact:
            return state
        return F.when(f["key"].isNull() | (f["kind"] == "VOID"), state).otherwise(
            F.coalesce(f["hide"], state)
        )

    def _members(self, v: Column) -> Column:
        """Key and value of an object's members in the order of the walk; null for no object."""
        entries = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
        if self.by_name:
            return entries
        return F.transform(entries, lambda e: F.struct(literals.name_of(e["key"]).alias("key"), e["value"].alias("value")))

    def _member(self, v: Column, name: str) -> Column:
        """A member's value; null where there is none."""
        if self.by_name:
            return F.try_variant_get(v, f"$.{name}", "variant")
        return F.get(F.filter(self._members(v), lambda e: e["key"] == name), F.lit(0))["value"]

    def text_of(self, v: Column) -> Column:
        """The JSON text of a value."""
        return F.to_json(v) if self.by_name else literals.without_places(F.to_json(v))

    def _facts(self, n: Column) -> Column:
        """Children of a container with what the rules ask about them, each once."""
        members = self._members(n["v"])
        items = F.transform(
            F.try_variant_get(n["v"], "$", "array<variant>"),
            lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")),
        )

        def facts(e: Column, i: Column) -> Column:
            fields = [
                i.alias("i"),
                e["key"].alias("key"),
                e["value"].alias("v"),
                self._kind_of(e["value"]).alias("kind"),
            ]
            if self.redact:
                hide = F.when(is_sensitive_key(e["key"]), F.lit("hide")).when(
                    is_binary_key(e["key"]), F.lit("hide_blob")
                )
                fields.append(hide.alias("hide"))
            return F.struct(*fields)

        return F.transform(F.coalesce(members, items), facts)

    def _ruled(self, n: Column, facts: Column) -> Column:
        """Facts plus field class and mode under the capture policy."""
        mode = n["mode"]

        def field_class(f: Column) -> Column:
            role = F.coalesce(F.try_variant_get(self._member(n["v"], "role"), "$", "string"), F.lit(""))
            field = (
                F.when(mode == RECORD, self.field_of(f["key"]))
                .when(mode == METADATA, policies.metadata_field(f["key"]))
                .when(
                    mode == MESSAGE,
                    F.when(f["key"] != "role", policies.message_field(role, f["key"])),
                )
                .when(mode == PROVIDER, F.lit("providerInput"))
                .otherwise(n["field"])
            )
            listed = (f["kind"] == "ARRAY") | (
                _type_of(self._member(f["v"], "messages")) == "ARRAY"
            )
            return f.withField("field", field).withField("listed", listed)

        def next_mode(f: Column) -> Column:
            is_item = f["key"].isNull()
            out = (
                F.when(
                    (mode == RECORD) & (f["field"] == "metadata") & (f["kind"] == "OBJECT"),
                    F.lit(METADATA),
                )
                .when(
                    (mode == PROVIDER) & is_item & (f["kind"] == "OBJECT"), F.lit(MESSAGE)
                )
                .when((mode == PROVIDER) & (is_item | (f["key"] != "messages")), F.lit(PLAIN))
                .when(
                    (f["field"] == "providerInput")
                    & mode.isin(RECORD, PROVIDER, MESSAGE)
                    & f["listed"],
                    F.lit(PROVIDER),
                )
                .otherwise(F.lit(PLAIN))
            )
            return f.withField("mode", out)

        return F.transform(F.transform(facts, field_class), next_mode)

    def _kept(self, n: Column, f: Column) -> Column:
        free = (n["mode"] == RECORD) & f["field"].isNull()
        role = (n["mode"] == MESSAGE) & (f["key"] == "role")
        sides = ("providerInput", "prompt", "systemPrompt", "assistantOutput", "toolOutput")
        any_side = F.exists(
            F.array(*[F.lit(side) for side in sides]), lambda side: self.captured(side)
        )
        return (
            F.when(free | role | f["mode"].isin(METADATA, MESSAGE), F.lit(True))
            .when(f["mode"] == PROVIDER, any_side)
            .when(f["field"].isNull(), F.lit(True))
            .otherwise(self.captured(f["field"]))
        )

    def _child(self, n: Column, f: Column) -> Column:
        path = (
            F.concat(n["path"], F.array(f["i"].cast("int"))) if self.paths else n["path"]
        )
        if self.field_of is None:
            level = n["level"] + 1
            mode, field = F.lit(PLAIN), F.lit(None).cast("string")
            counted, plain = F.lit(True), F.lit(True)
        else:
            inside = n["mode"] == PLAIN
            level = F.when(inside, n["level"] + 1).otherwise(F.lit(0))
            mode, field = f["mode"], f["field"]
            counted = field.isNotNull() & ~mode.isin(METADATA, PROVIDER)
            plain = (mode == PLAIN) & field.isNotNull()
        return F.struct(
            path.alias("path"),
            f["key"].alias("key"),
            self._state(f, level, plain).alias("state"),
            f["v"].alias("v"),
            mode.alias("mode"),
            field.alias("field"),
            level.alias("level"),
            counted.alias("counted"),
        )

    def open(self, n: Column) -> Column:
        """A container to open becomes: opener, its kept children, closer."""
        facts = self._facts(n)
        if self.field_of is not None:
            facts = F.filter(self._ruled(n, facts), lambda f: self._kept(n, f))
        children = F.transform(facts, lambda f: self._child(n, f))
        children = self._breadth_budget(n, children)
        is_object = F.try_variant_get(n["v"], "$", "map<string,variant>").isNotNull()
        opener = n.withField("state", F.when(is_object, F.lit("{")).otherwise(F.lit("[")))
        closer = (
            n.withField("state", F.when(is_object, F.lit("}")).otherwise(F.lit("]")))
            .withField("key", F.lit(None).cast("string"))
            .withField("counted", F.lit(False))
        )
        return F.concat(F.array(opener), children, F.array(closer))

    def _breadth_budget(self, n: Column, children: Column) -> Column:
        """First items of an array, first keys of an object; structural keys are free."""
        items, keys = self.limits.array_items, self.limits.object_keys
        if items is None and keys is None:
            return children

        def free(c: Column) -> Column:
            if self.field_of is None:
                return F.lit(False)
            return c["field"].isNull()

        def cut(all_children: Column) -> Column:
            is_array = F.get(all_children, F.lit(0))["key"].isNull()
            limit = F.when(is_array, F.lit(items)).otherwise(F.lit(keys)).cast("int")
            content = F.filter(all_children, lambda c: ~free(c))
            beyond = F.get(content, limit)["path"]
            return F.filter(
                all_children, lambda c: free(c) | beyond.isNull() | (c["path"] < beyond)
            )

        return bind(children, cut)

    def node_budget(self, nodes: Column) -> Column:
        """Stop at the first counted node beyond the budget: it and all that begins
        after it go, what began before is closed properly."""
        limit = self.limits.nodes
        if limit is None:
            return nodes

        def cut(all_nodes: Column) -> Column:
            over = F.get(F.filter(all_nodes, lambda n: n["counted"]), F.lit(limit))["path"]

            def before(n: Column) -> Column:
                of_message = (n["key"] == "role") & (F.size(n["path"]) > 1) & n["field"].isNull()
                home = F.when(
                    of_message, F.slice(n["path"], 1, F.size(n["path"]) - 1)
                ).otherwise(n["path"])
                structural = n["field"].isNull() & ~F.coalesce(of_message, F.lit(False))
                return over.isNull() | (home < over) | (
                    structural if self.field_of is not None else F.lit(False)
                )

            return F.filter(all_nodes, before)

        return bind(nodes, cut)

    def drop_empty_metadata(self, nodes: Column) -> Column:
        """A metadata object of which nothing is left goes as a whole."""

        def drop(all_nodes: Column) -> Column:
            def hollow(i: Column) -> Column:
                here, after = F.get(all_nodes, i), F.get(all_nodes, i + 1)
                return F.coalesce(
                    (here["mode"] == METADATA) & (here["state"] == "{") & (after["state"] == "}"),
                    F.lit(False),
                )

            return F.filter(
                all_nodes,
                lambda n, i: ~hollow(i) & ~((n["state"] == "}") & (i > 0) & hollow(i - 1)),
            )

        return bind(nodes, drop)


def json_depth(json: Column) -> Column:
    """Nesting depth of a JSON text, from its brackets outside of strings."""
    bare = F.regexp_replace(F.regexp_replace(json, r"\\.", ""), '"[^"]*"', "")
    brackets = F.regexp_extract_all(bare, F.lit(r"[\[\]{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

    def step(acc: Column, b: Column) -> Column:
        now = acc["now"] + F.when(b.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["top"], now).alias("top"))

    return F.aggregate(brackets, start, step, lambda acc: acc["top"])


def measure_depth(df: DataFrame, column: str) -> int:
    """Greatest nesting depth in the data; one narrow pass."""
    row = df.agg(F.max(json_depth(F.col(column))).alias("depth")).first()
    return int(row["depth"] or 0)


_NODES = "__tree_nodes"


def _masked_text(n: Column, bounded: bool, walk: _Walk) -> Column:
    """Placeholder of a value hidden because of its key."""
    kind = _type_of(n["v"])
    string = F.try_variant_get(n["v"], "$", "string")
    if walk.marked:
        string = F.when(literals.is_marked(string), literals.literal(string)).otherwise(string)
    value = F.coalesce(F.when(kind == "STRING", string), walk.text_of(n["v"]))
    if bounded:
        value = F.when(
            (kind != "STRING") & (F.length(value) > P.STRUCTURED_VALUE_CHARS), F.lit(OVERSIZED)
        ).otherwise(value)
    return F.when(n["state"] == "hide", placeholder(n["key"], value)).when(
        n["state"] == "hide_blob", blob_placeholder(n["key"], value)
    )


def shape_json(
    df: DataFrame,
    column: str,
    out: str,
    *,
    redact: bool = True,
    field_of: Callable[[Column], Column] | None = None,
    captured: Callable[[Column], Column] | None = None,
    limits: Limits | None = None,
    secrets: Iterable[tuple[str, str]] = (),
    depth: int | None = None,
    force: bool = False,
    marked: bool = False,
    by_name: bool = True,
) -> DataFrame:
    """Add ``out``: the JSON text of ``column`` redacted, masked and bounded.

    ``field_of`` maps a top-level key to its field class (null: structural, always
    kept), ``captured`` a field class to whether it is kept.  Text that is no JSON
    gives null.  Everything is walked: the depth of the data is measured first, in one
    narrow pass.  Where ``depth`` is given (always for a stream, which can't be measured),
    containers below it are replaced whole by a placeholder, so nothing in them can leak.
    ``marked`` texts come from :func:`literals.prepared`.  Members are walked, counted and written
    by name, or without ``by_name`` in document order: array indices first, the others as they
    stand; then a repeated key has its last value where it first stood, and numbers are as they stood.
    """
    if depth is None:
        depth = measure_depth(df, column)
    marked = marked or not by_name
    walk = _Walk(redact, limits or Limits(), field_of, captured or (lambda f: F.lit(True)), marked, by_name)
    source = F.col(column) if by_name else literals.numbered(F.col(column))
    nodes = df.withColumn("__tree_root", F.try_parse_json(source)).withColumn(
        _NODES, F.when(F.col("__tree_root").isNotNull(), walk.root(F.col("__tree_root")))
    ).drop("__tree_root")
    todo = F.exists(F.col(_NODES), lambda n: n["state"] == "todo")
    opened = F.flatten(
        F.transform(
            F.col(_NODES),
            lambda n: F.when(n["state"] == "todo", walk.open(n)).otherwise(F.array(n)),
        )
    )
    grown = F.when(todo, opened).otherwise(F.col(_NODES))
    for _ in range(depth):
        nodes = nodes.withColumn(_NODES, grown)

    if limits is not None:
        nodes = nodes.withColumn(_NODES, walk.node_budget(F.col(_NODES)))
    if field_of is not None and not force:
        nodes = nodes.withColumn(_NODES, walk.drop_empty_metadata(F.col(_NODES)))

    # What is left to open lies deeper than the walk: hidden as one value.
    deeper = placeholder("structured-value", F.lit(None)) if not redact else None

    def raw(v: Column) -> Column:
        if not marked:
            return F.to_json(v)
        string = F.try_variant_get(v, "$", "string")
        number = (_type_of(v) == "STRING") & literals.is_marked(string)
        return F.when(number, literals.literal(string)).otherwise(F.to_json(v))

    def leaf(n: Column) -> Column:
        unopened = (
            F.lit(OVERSIZED) if deeper is not None else placeholder("structured-value", walk.text_of(n["v"]))
        )
        text = (
            F.when(n["state"] == "text", F.try_variant_get(n["v"], "$", "string"))
            .when(n["state"] == "todo", unopened)
            .when(n["state"] == "deep", F.lit(TRUNCATED))
            .otherwise(_masked_text(n, limits is not None, walk))
        )
        return F.struct(
            n["key"].alias("key"),
            n["state"].alias("state"),
            n["field"].alias("field"),
            text.alias("text"),
            F.when(n["state"] == "done", raw(n["v"])).alias("raw"),
        )

    slim = nodes.withColumn(_NODES, F.transform(F.col(_NODES), leaf))
    if redact:
        texts = slim.withColumn(
            "__tree_texts",
            F.transform(
                F.filter(F.col(_NODES), lambda n: n["state"] == "text"), lambda n: n["text"]
            ),
        )
        slim = _return_texts(redact_columns(texts, "__tree_texts", secrets=secrets))
    bound = limits or Limits()

    def cut(n: Column) -> Column:
        if limits is None:
            return n["text"]
        free = (n["field"].isNull() if field_of is not None else F.lit(False)) | (n["state"] == "deep")
        return F.when(free, n["text"]).otherwise(
            policies.bound_string(n["text"], F.coalesce(n["field"], F.lit("metadata")), bound)
        )

    def fragment(n: Column) -> Column:
        name = F.when(
            n["key"].isNotNull(), F.concat(json_string(n["key"]), F.lit(":"))
        ).otherwise("")
        value = (
            F.when(n["state"].isin("{", "[", "}", "]"), n["state"])
            .when(n["state"] == "done", n["raw"])
            .otherwise(json_string(cut(n)))
        )
        return F.struct(n["state"].alias("state"), F.concat(name, value).alias("json"))

    pieces = slim.withColumn(_NODES, F.transform(F.col(_NODES), fragment))
    joined = F.array_join(
        F.transform(
            F.col(_NODES),
            lambda f, i: F.when(
                (i == 0)
                | f["state"].isin("}", "]")
                | F.get(F.col(_NODES), i - 1)["state"].isin("{", "["),
                f["json"],
            ).otherwise(F.concat(F.lit(","), f["json"])),
        ),
        "",
    )
    return pieces.withColumn(out, joined if by_name else literals.unguarded(joined)).drop(_NODES)


def _return_texts(df: DataFrame) -> DataFrame:
    """Put the redacted texts back on the text nodes they came from, in order."""
    at = F.array_compact(
        F.transform(F.col(_NODES), lambda n, i: F.when(n["state"] == "text", i))
    )
    df = df.withColumn("__tree_at", F.map_from_arrays(at, F.col("__tree_texts")))
    return df.withColumn(
        _NODES,
        F.transform(
            F.col(_NODES),
            lambda n, i: F.when(
                n["state"] == "text", n.withField("text", F.col("__tree_at")[i])
            ).otherwise(n),
        ),
    ).drop("__tree_at", "__tree_texts")


def shape_trace(df: DataFrame, column: str, out: str, policy: str | Column = policies.DEFAULT_POLICY, **options) -> DataFrame:
    """Capture policy and budgets on a JSON trace body."""
    return shape_json(
        df, column, out, field_of=policies.trace_field,
        captured=lambda f: policies.is_captured(f, policy), **_budgets(options),
    )


def shape_observation(df: DataFrame, column: str, out: str, name: Column, policy: str | Column = policies.DEFAULT_POLICY, **options) -> DataFrame:
    """Capture policy and budgets on a JSON observation body."""
    return shape_json(
        df, column, out, field_of=lambda key: policies.observation_field(name, key),
        captured=lambda f: policies.is_captured(f, policy), **_budgets(options),
    )


def shape_raw_record(df: DataFrame, column: str, out: str, type_: Column, policy: str | Column = policies.DEFAULT_POLICY, **options) -> DataFrame:
    """Capture policy and budgets on a JSON raw trace record."""
    return shape_json(
        df, column, out, field_of=lambda key: policies.raw_field(type_, key),
        captured=lambda f: policies.is_captured(f, policy), **_budgets(options),
    )


def _budgets(options: dict) -> dict:
    return {"limits": Limits(), **options}


def shape_export(df: DataFrame, column: str, out: str, **options) -> DataFrame:
    """Redaction always on; policy and budgets are not applied to exports."""
    return shape_json(df, column, out, redact=True, **options)
