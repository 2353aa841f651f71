"""Near-duplicate texts: word 5-grams, an index of count vectors, exact Jaccard similarity.

A text's set of shingles is hashed into groups; the number of shingles in each group is a
point.  Two sets share at most the sum of the coordinate minima of their points, so pairs
whose sum is too small for the similarity asked for are left out unseen; of boxes of points
the upper corners are compared the same way.  What survives is verified on the whole sets.

Distribution.  Texts of equal sets are one class.  Points are indexed under the rarest
shingles of their set, so many of them that two similar sets always share one (a lossless
prefix: the order is the same for all).  Under each such key first everything is compared
with one leader; links found join components.  Only keys that still hold several components
go on: their points are cut into leaves of bounded size, leaves are compared by their boxes,
and the points of the leaf pairs that survive by their vectors.  Points that may link fall
into classes, each point into one, and the texts of a class are compared the same way, leaf
by leaf.  A hot key is thus many leaves, no pair travels alone, and a group of copies that
hang together is left alone, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_name, by_place, map_batches, stage, table
from .components import connected_components

#: Two sets link when LINK_NUM / LINK_DEN of their union is shared.
LINK_NUM, LINK_DEN = 4, 5
#: Shingles seen in so many sets of one task count towards the list of common ones, kept at so many.
#: The list only orders a set's shingles; without it results are the same and hot keys more.
COMMON_IN_TASK, COMMON_KEPT, TASK_SHINGLES = 3, 1 << 18, 1 << 20
#: Points in a leaf, in one that carries texts, and the ratio of sizes within one.
LEAF, TEXT_LEAF, LEAF_RATIO = 256, 64, 1.25
#: Bits of the bitmap that keeps texts nobody asks for out of a shuffle.
BITMAP = 1 << 23

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

SIGNATURES = "kind int, doc_id bigint, n bigint, node bigint, counts binary, shingle bigint, seen bigint"


def shingles(text: bytes | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams: A-Z lower-cased, cut at ASCII white space.

    A text with fewer words is one shingle; one without words, or null, has none.
    """
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), len(tokens))], np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, tokens), np.uint64, len(tokens))
    out = hashes[: len(hashes) - words + 1].copy()
    for i in range(1, words):
        out *= _MIX[0]
        out += hashes[i : len(hashes) - words + 1 + i]
    for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
        out ^= out >> np.uint64(shift)
        out *= factor
    out ^= out >> np.uint64(31)
    return np.unique(out)


def node_of(hashes: np.ndarray) -> int:
    """The class of a set: 64 bits, so among N different sets about N * N / 2**65 are taken for another."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), 7)).astype(np.int64))


def groups_for(n: int) -> int:
    """Groups of a set of n shingles, a power of two: two to four shingles in each."""
    return 1 << max(4, math.ceil(math.log2(max(1, n) / 4)))


def count_vector(hashes: np.ndarray) -> np.ndarray:
    groups = groups_for(len(hashes))
    return np.bincount((hashes >> np.uint64(32)).astype(np.int64) & (groups - 1), minlength=groups)


def pack_counts(counts: np.ndarray) -> bytes:
    top = int(counts.max(initial=0))
    return counts.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def unpack_counts(data: bytes, n: int, groups: int | None = None) -> np.ndarray:
    """The vector of a set of n shingles, folded to fewer groups where they are asked for."""
    own = groups_for(n)
    counts = np.frombuffer(data, {1: "u1", 2: "<u2", 4: "<u4"}[len(data) // own]).astype(np.int32)
    return counts if groups in (None, own) else counts.reshape(own // groups, groups).sum(0, dtype=np.int32)


def enough(overlap, n_a, n_b):
    """Whether an overlap (or a bound of it) can make a link of sets of these sizes."""
    return LINK_DEN * overlap >= LINK_NUM * (n_a + n_b - overlap)


def similar_sizes(a: Column, b: Column) -> Column:
    return F.least(a, b) * LINK_DEN >= F.greatest(a, b) * LINK_NUM


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    size = next(len(c) for c in columns if c is not None)
    arrays = [pa.nulls(size, kinds[k]) if c is None else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def signatures(docs: DataFrame) -> DataFrame:
    """Kind 0: doc_id, n, node and counts of each row.  Kind 1: a shingle and the sets of a task that hold it."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, nodes = [], 0, set()

        def common() -> pa.RecordBatch:
            values, seen = np.unique(np.concatenate(held), return_counts=True)
            often = seen >= COMMON_IN_TASK
            return _batch(SIGNATURES, np.ones(often.sum(), np.int32), None, None, None, None, values[often].astype(np.int64), seen[often])

        for batch in batches:
            rows = []
            for text in batch.column("text"):
                hashes = shingles(text.as_py())
                node = node_of(hashes) if len(hashes) else None
                rows.append((len(hashes), node, pack_counts(count_vector(hashes)) if len(hashes) else None))
                if node is not None and node not in nodes:
                    nodes.add(node)
                    held.append(hashes)
                    size += len(hashes)
                if size >= TASK_SHINGLES:
                    yield common()
                    held, size, nodes = [], 0, set()
            n, node, counts = zip(*rows, strict=True) if rows else ((), (), ())
            yield _batch(SIGNATURES, np.zeros(len(rows), np.int32), batch.column("doc_id"), n, node, counts, None, None)
        if held:
            yield common()

    return map_batches(docs, sign, SIGNATURES)


def common_shingles(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with their counts: a list of bounded length."""
    rows = (
        signed.filter("kind = 1").groupBy("shingle").agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "shingle").limit(COMMON_KEPT).toArrow()
    )
    values = rows.column("shingle").to_numpy().astype(np.uint64)
    order = np.argsort(values)
    return values[order], rows.column("seen").to_numpy()[order]


def prefix(hashes: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first shingles in the order (how common, value): so many that two linked sets share one of theirs."""
    length = len(hashes) - -(-LINK_NUM * len(hashes) // LINK_DEN) + 1
    values, seen = common
    if not len(values):
        return hashes[:length]
    at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
    weight = np.where(values[at] == hashes, seen[at], 0)
    return hashes[np.argsort(weight, kind="stable")[:length]]


def prefix_keys(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(key, node) for each prefix shingle of each row; a task leaves out sets it has just had."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: set[int] = set()
        for batch in batches:
            held, owners, size = [], [], 0
            for text in batch.column("text"):
                hashes = shingles(text.as_py())
                node = node_of(hashes) if len(hashes) else None
                if node is None or node in nodes:
                    continue
                if len(nodes) >= 1 << 17:
                    nodes.clear()
                nodes.add(node)
                held.append(prefix(hashes, shared.value))
                owners.append(np.full(len(held[-1]), node, np.int64))
                size += len(held[-1])
                if size >= 1 << 19:
                    yield _batch("key bigint, node bigint", np.concatenate(held).astype(np.int64), np.concatenate(owners))
                    held, owners, size = [], [], 0
            if held:
                yield _batch("key bigint, node bigint", np.concatenate(held).astype(np.int64), np.concatenate(owners))

    return map_batches(docs, keys, "key bigint, node bigint")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, node, leader) for keys of several sets; of keys under which the same sets stand, one."""
    several = keys.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    rows = stage(keys.join(several.select("key", "leader"), "key"), "shared")
    digest = F.xxhash64("node")
    same = rows.groupBy("key", "leader").agg(
        F.max("node").alias("last"), F.count(F.lit(1)).alias("n"),
        F.try_sum(F.shiftrightunsigned(digest, 32)).alias("high"), F.try_sum(digest.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
    )
    kept = same.groupBy("leader", "last", "n", "high", "low").agg(F.min("key").alias("key")).select("key")
    return stage(rows.join(kept, "key").select("key", "node", "leader").distinct(), "keys")


def _with_points(pairs: DataFrame, points: DataFrame) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(points.select(*[F.col(c).alias(f"{c}_{side}" if c != "node" else side) for c in ("node", "n", "counts")]), side)
    return pairs.filter(similar_sizes(F.col("n_a"), F.col("n_b")))


def bounded_pairs(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b) those whose count vectors allow a link."""

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, out = batch.column("a").to_numpy(), batch.column("b").to_numpy(), []
            rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "counts_a", "counts_b")), strict=True)
            for i, (n_a, n_b, counts_a, counts_b) in enumerate(rows):
                groups = min(groups_for(n_a), groups_for(n_b))
                most = int(np.minimum(unpack_counts(counts_a, n_a, groups), unpack_counts(counts_b, n_b, groups)).sum())
                if enough(most, n_a, n_b):
                    out.append(i)
            yield _batch("a bigint, b bigint", a[out], b[out])

    return map_batches(_with_points(pairs, points), bound, "a bigint, b bigint")


def _maybe_wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id may be among ``ids`` (doc_id), told by a bitmap of bounded size; rows without an id too."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP))
    bitmap = (
        ids.filter("doc_id IS NOT NULL").select(F.bitmap_bucket_number(spot).alias("__bucket"), F.bitmap_bit_position(spot).alias("bit"))
        .groupBy("__bucket").agg(F.bitmap_construct_agg("bit").alias("__bits"))
    )
    placed = docs.withColumn("__bucket", F.bitmap_bucket_number(spot)).withColumn("__bit", F.bitmap_bit_position(spot))
    byte = F.conv(F.hex(F.substring("__bits", (F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(__bit % 8 as int)) & 1") == 1
    # at most BITMAP / 32768 rows of 4 KB are broadcast
    return placed.join(F.broadcast(bitmap), "__bucket", "left").withColumn("__byte", byte).filter(hit | F.col("doc_id").isNull()).select(*docs.columns)


def texts_of(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) for each node of ``wanted`` (node, doc_id), told by the text itself as an id may repeat."""

    def own_node(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node_of(shingles(t.as_py())) for t in batch.column("text")]
            yield _batch("node bigint, text binary", nodes, batch.column("text"))

    texts = map_batches(_maybe_wanted(docs, wanted.select("doc_id")), own_node, "node bigint, text binary")
    return texts.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, points: DataFrame, docs: DataFrame) -> DataFrame:
    """Of ``pairs`` (a, b; a stage table) those whose sets link, told on the whole texts."""
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = stage(ends.join(points, "node").select("node", F.col("first").alias("doc_id")), "wanted")
    own = stage(texts_of(wanted, docs), "texts")
    sides = pairs.join(own.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    sides = sides.join(own.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b, out = batch.column("a").to_pylist(), batch.column("b").to_pylist(), []
            for i, (text_a, text_b) in enumerate(zip(batch.column("text_a"), batch.column("text_b"), strict=True)):
                if a[i] != last:
                    last, left = a[i], shingles(text_a.as_py())
                right = shingles(text_b.as_py())
                if enough(overlap(left, right), len(left), len(right)):
                    out.append(i)
            yield _batch("a bigint, b bigint", [a[i] for i in out], [b[i] for i in out])

    return stage(map_batches(sides, link, "a bigint, b bigint"), "links")


@dataclass
class Leaf:
    """Points of one leaf: nodes, their components, sizes and count vectors, and the texts where they are asked for."""

    nodes: list[int]
    components: list[int]
    sizes: np.ndarray
    vectors: list[np.ndarray]
    texts: list[bytes]

    @classmethod
    def of(cls, points: list[dict]) -> Leaf:
        return cls(
            [p["node"] for p in points], [p["component"] for p in points], np.array([p["n"] for p in points], np.int64),
            [unpack_counts(p["counts"], p["n"]) for p in points], [p.get("text") for p in points],
        )

    def __post_init__(self) -> None:
        self._sets: dict[int, np.ndarray] = {}

    def set_of(self, i: int) -> np.ndarray:
        if i not in self._sets:
            self._sets[i] = shingles(self.texts[i])
        return self._sets[i]

    def matrix(self, groups: int) -> np.ndarray:
        return np.stack([v.reshape(len(v) // groups, groups).sum(0, dtype=np.int32) for v in self.vectors])

    @property
    def groups(self) -> int:
        return min(len(v) for v in self.vectors)


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if not len(left) or not len(right):
        return 0
    at = np.minimum(np.searchsorted(right, left), len(right) - 1)
    return int((right[at] == left).sum())


def joining_pairs(left: Leaf, right: Leaf, same: bool, verify: bool) -> list[tuple[int, int]]:
    """Pairs that join components across two leaves: pairs whose vectors allow a link, or only true links.

    Points already joined, before or by an earlier pair, aren't looked at again: components are
    what is asked for, so no more pairs come out than there are components.
    """
    groups = min(left.groups, right.groups)
    a, b = left.matrix(groups), right.matrix(groups)
    box, least = b.max(0), right.sizes.min()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    roots = np.array(right.components, np.int64)  # kept up to date for the right leaf
    out = []
    for i in range(len(a)):
        if not enough(int(np.minimum(a[i], box).sum()), left.sizes[i], least):
            continue  # the whole box is too far
        own, start = root(left.components[i]), i + 1 if same else 0
        open_ = np.flatnonzero(roots[start:] != own) + start
        fits = open_[enough(np.minimum(a[i], b[open_]).sum(1), left.sizes[i], right.sizes[open_])]
        for j in fits:
            j = int(j)
            if roots[j] == own or verify and not enough(overlap(left.set_of(i), right.set_of(j)), left.sizes[i], right.sizes[j]):
                continue
            out.append((left.nodes[i], right.nodes[j]))
            old = int(roots[j])
            parent[old] = own
            roots[roots == old] = own
    return out


def size_bin(n: int) -> int:
    return math.floor(math.log(n) / math.log(LEAF_RATIO))


def within(points: list[dict], verify: bool) -> list[tuple[int, int]]:
    """Joining pairs among the points of one leaf; points of other than neighbouring sizes can't link."""
    bins: dict[int, list[dict]] = {}
    for p in points:
        bins.setdefault(size_bin(p["n"]), []).append(p)
    leaves = {k: Leaf.of(v) for k, v in bins.items()}
    out = []
    for k, leaf in leaves.items():
        out += joining_pairs(leaf, leaf, True, verify)
        if k + 1 in leaves:
            out += joining_pairs(leaf, leaves[k + 1], False, verify)
    return out


POINT = ("node", "component", "n", "counts")
BOXES = "group bigint, leaf bigint, size_bin int, first_component bigint, last_component bigint, least_n bigint, most_n bigint, box binary"


def _leaves(placed: DataFrame, payload: DataFrame, most: int, fields: tuple[str, ...]) -> DataFrame:
    """Cut the points of each group (group, node, component, n, in_group) into leaves of about ``most`` points."""
    by_component = placed.groupBy("group", "component").agg(F.count(F.lit(1)).alias("in_component"))
    parts = lambda count: F.ceil(F.col(count) / most)
    cut = placed.join(by_component, ["group", "component"]).withColumns({
        "size_bin": F.floor(F.log(F.col("n").cast("double")) / math.log(LEAF_RATIO)).cast("int"),
        "part": F.pmod(F.xxhash64("component"), parts("in_group")).cast("int"),
        "piece": F.pmod(F.xxhash64("node"), parts("in_component")).cast("int"),
    })
    return cut.join(payload, "node").groupBy("group", "size_bin", "part", "piece").agg(
        F.collect_list(F.struct(*fields)).alias("points"), F.min("component").alias("first_component"), F.max("component").alias("last_component"),
        F.min("n").alias("least_n"), F.max("n").alias("most_n"),
    ).withColumn("leaf", F.xxhash64("size_bin", "part", "piece"))


def _compared(leaves: DataFrame, verify: bool) -> DataFrame:
    """Joining pairs of the rows of ``leaves`` (points_a, points_b; null where a leaf meets itself)."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(f"points_{s}")[i].as_py() for s in "ab")
                found = within(a, verify) if b is None else joining_pairs(Leaf.of(a), Leaf.of(b), False, verify)
                if found:
                    yield _batch("a bigint, b bigint", [p[0] for p in found], [p[1] for p in found])

    return map_batches(leaves, compare, "a bigint, b bigint")


def joined_groups(points: DataFrame, payload: DataFrame, most: int, verify: bool) -> DataFrame:
    """(a, b): pairs that join the components of each group of ``points`` (group, node, component, n).

    ``payload`` has the counts of each node, and its text if links are to be verified; see ``joining_pairs``.
    A group of up to ``most`` points is one leaf.  Larger ones are cut: of their leaves the boxes are
    compared first, then the points of the leaf pairs whose boxes allow a link.  Leaf pairs of one and
    the same component are left out, so a group that hangs together costs nothing.
    """
    fields = (*POINT, "text") if verify else POINT
    by_group = points.groupBy("group").agg(F.count(F.lit(1)).alias("in_group"))
    placed = stage(points.join(by_group, "group"), "placed")
    small = placed.filter(F.col("in_group") <= most).join(payload, "node").groupBy("group").agg(F.collect_list(F.struct(*fields)).alias("points_a"))
    nothing = F.lit(None).cast(small.schema["points_a"].dataType).alias("points_b")
    alone = _compared(small.select("points_a", nothing), verify)

    leaves = stage(_leaves(placed.filter(F.col("in_group") > most), payload, most, fields), "leaves")
    heads = ["group", "leaf", "size_bin", "first_component", "last_component", "least_n", "most_n"]

    def boxes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for points in batch.column("points").to_pylist():
                leaf = Leaf.of([{"node": 0, "component": 0, **p} for p in points])
                out.append(leaf.matrix(leaf.groups).max(0).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in heads), pa.array(out, pa.binary())], [*heads, "box"])

    vectors = F.transform("points", lambda p: F.struct(p["n"].alias("n"), p["counts"].alias("counts"))).alias("points")
    boxed = stage(map_batches(leaves.select(*heads, vectors), boxes, BOXES), "boxes")
    left, right = (boxed.select("group", *[F.col(c).alias(f"{c}_{s}") for c in boxed.columns if c != "group"]) for s in "ab")
    near = left.join(right, "group").filter(
        (F.col("leaf_a") <= F.col("leaf_b")) & (F.abs(F.col("size_bin_a") - F.col("size_bin_b")) <= 1)
        & (F.col("least_n_a") * LINK_NUM <= F.col("most_n_b") * LINK_DEN) & (F.col("least_n_b") * LINK_NUM <= F.col("most_n_a") * LINK_DEN)
        & (F.least("first_component_a", "first_component_b") < F.greatest("last_component_a", "last_component_b"))
    )

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("box_a", "box_b", "least_n_a", "least_n_b")), strict=True)
            for i, (box_a, box_b, n_a, n_b) in enumerate(rows):
                a, b = np.frombuffer(box_a, "<i4"), np.frombuffer(box_b, "<i4")
                groups = min(len(a), len(b))
                most_shared = int(np.minimum(a.reshape(-1, groups).sum(0), b.reshape(-1, groups).sum(0)).sum())
                if enough(most_shared, n_a, n_b):
                    out.append(i)
            yield _batch("group bigint, leaf_a bigint, leaf_b bigint", *(batch.column(c).to_numpy()[out] for c in ("group", "leaf_a", "leaf_b")))

    met = map_batches(near, meet, "group bigint, leaf_a bigint, leaf_b bigint")
    held = leaves.select("group", "leaf", "points")
    both = met.join(held.withColumnsRenamed({"leaf": "leaf_a", "points": "points_a"}), ["group", "leaf_a"])
    # a leaf against itself is carried once
    other = F.when(F.col("leaf_a") != F.col("leaf_b"), F.col("points_b")).alias("points_b")
    both = both.join(held.withColumnsRenamed({"leaf": "leaf_b", "points": "points_b"}), ["group", "leaf_b"]).select("points_a", other)
    return alone.union(_compared(both, verify))


def _several(placed: DataFrame, least_nodes: int = 2) -> DataFrame:
    """Rows (group, node, component) of the groups that hold several components, and so many nodes."""
    groups = placed.groupBy("group").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("nodes"))
    return placed.join(groups.filter((F.col("lo") < F.col("hi")) & (F.col("nodes") >= least_nodes)).select("group"), "group")


def _named(nodes: DataFrame, components: DataFrame) -> DataFrame:
    return nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))


def classes_and_components(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, node) of each row, and (node, first, component) of each class of equal sets."""
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    signed = stage(signatures(docs), "signed")
    rows = signed.filter("kind = 0").select("doc_id", "n", "node", "counts")
    points = stage(
        rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.first("counts").alias("counts")), "points"
    )
    keys = shared_keys(prefix_keys(docs, common_shingles(signed)))

    led = keys.filter("leader <> node").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = verified(stage(bounded_pairs(led, points), "led"), points, docs)
    components = stage(connected_components(links), "components")

    # what may link, by the points alone: classes of nodes, each node in one; of two nodes under a key one was the leader
    placed = _several(_named(keys.select(F.col("key").alias("group"), "node"), components), 3).join(points.select("node", "n"), "node")
    may_join = joined_groups(placed, points.select("node", "counts"), LEAF, verify=False)
    classes = connected_components(may_join.union(links)).withColumnRenamed("component", "group")
    # and what does, on the whole texts
    rest = stage(_several(_named(classes, components)).join(points, "node").select("group", *POINT, F.col("first").alias("doc_id")), "rest")
    texts = texts_of(rest.select("node", "doc_id"), docs).join(rest.select("node", "counts"), "node")
    more = joined_groups(rest.select("group", "node", "component", "n"), stage(texts, "texts"), TEXT_LEAF, verify=True)
    whole = connected_components(links.union(more))

    named = points.join(whole, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    return rows.select("doc_id", "n", "node"), named


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``documents`` (doc_id, text).

    component_id is the smallest doc_id of the component, a null id aside; null where no row of
    it has an id.  Rows without shingles are their own component.  Rows that repeat an id stay
    apart by their texts.  Extra columns are left aside.
    """
    rows, named = classes_and_components(documents)
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    final = named.join(names, "component").select("node", "component_id")
    return rows.join(final, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def keep_first(documents: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest id; null ids come last.

    Rows without shingles all stay, one for each id.  Of rows alike in id and set any one stays.
    """
    _, named = classes_and_components(documents)
    best = named.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("first"), F.col("node").alias("node"))).alias("best"))
    kept = stage(best.select((~F.col("best.none")).alias("__has"), F.coalesce("best.first", F.lit(0)).alias("__id"), F.col("best.node").alias("__node"), F.lit(True).alias("__kept")), "kept")
    placed, names = by_place(documents)
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in placed.schema] + ["__node bigint"])
    text, own_id = names["text"], names["doc_id"]

    def own_node(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.encode("utf-8", "replace")) if (t := v.as_py()) else () for v in batch.column(text)]
            nodes = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, nodes], [*batch.schema.names, "__node"])

    keyed = map_batches(placed, own_node, schema).withColumns({
        "__has": F.col(own_id).isNotNull(), "__id": F.coalesce(F.col(own_id).cast("bigint"), F.lit(0)), "__node": F.coalesce("__node", F.lit(0)), "__none": F.col("__node").isNull(),
    })
    found = keyed.join(kept, ["__has", "__id", "__node"], "left").filter(F.col("__kept") | F.col("__none"))
    return by_name(found.dropDuplicates(["__has", "__id", "__node"]), names)


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) END AS g FROM w
), u AS (SELECT r, len(g) AS n, unnest(g) AS x FROM s
), p AS (
  SELECT a.r AS ra, b.r AS rb FROM u a JOIN u b USING (x) WHERE a.r < b.r GROUP BY a.r, b.r, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS (SELECT ra, rb FROM p UNION SELECT rb, ra FROM p
), reach AS (SELECT r AS ra, r AS rb FROM s UNION SELECT reach.ra, e.rb FROM reach JOIN e ON reach.rb = e.ra
)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT ra, min(s2.doc_id) AS c FROM reach JOIN s s2 ON s2.r = rb GROUP BY ra) m ON m.ra = s.r
"""
