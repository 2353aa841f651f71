"""The n-gram join and the code search against comparing everything with everything."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import hamming, ngram_join
from tracewell.llm.components import connected_components

DOCS = "doc_id bigint, text string, component_id string, node string"


def plain_sets(text):
    words = "".join(c.lower() if c < "\x80" else c for c in text or "").encode().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain_components(rows):
    sets = [plain_sets(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids, default=None) if sets[i] else rows[i][0]))
    return sorted(out, key=str)


def joined(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect()), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


def family(rng, first_id, size, length, edits):
    base = [f"w{rng.randrange(3000)}" for _ in range(length)]
    return [(first_id + i, " ".join(edited(rng, base, rng.randint(0, edits)))) for i in range(size)]


def test_join_equals_all_pairs(spark):
    rng = random.Random(11)
    rows = family(rng, 1000, 60, 200, 6) + family(rng, 2000, 25, 40, 2) + family(rng, 3000, 20, 600, 12)
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(4000 + i, f"{passage} " + " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(0, 80)))) for i in range(40)]
    rows += [(i, t) for i, t in enumerate(["", None, "   \n", "one two", "One TWO", "one two three", "a b c d e", "A b c d e", "É a b c d", "é a b c d", "x " * 900, "x " * 5])]
    rows += [(50, "one two"), (50, "same id other text of six words"), (None, "one two"), (None, "no id at all in this row"), (None, "no id at all in this row"), (None, None)]
    rng.shuffle(rows)
    assert joined(spark, rows) == plain_components(rows)


def test_groups_beyond_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", 8)
    monkeypatch.setattr(ngram_join, "TEXT_LEAF", 4)
    rng = random.Random(5)
    rows = family(rng, 0, 90, 120, 9) + family(rng, 500, 40, 60, 5)
    assert joined(spark, rows) == plain_components(rows)


def test_join_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.near_duplicates(empty).collect() == [] and ngram_join.keep_first(empty).collect() == []


def test_one_of_each_group_stays(spark):
    rng = random.Random(2)
    rows = family(rng, 10, 12, 100, 2) + [(90, "alone in the world of words"), (90, "alone in the world of words"), (None, rng.random().hex()), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS)
    out = ngram_join.keep_first(df).collect()
    want = {c for d, _, c in plain_components(rows)}
    assert df.columns == ngram_join.keep_first(df).columns
    assert sorted(str(r.doc_id) for r in out) == sorted(map(str, want))


@pytest.mark.parametrize("n", [3, 20, 77, 400, 5000])
def test_bounds_never_miss(n):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**64, n, np.uint64)
    for share in (0.0, 0.05, 0.1, 0.2):
        other = base.copy()
        changed = rng.random(n) < share
        other[changed] = rng.integers(0, 2**64, changed.sum(), np.uint64)
        a, b = np.unique(base), np.unique(other)
        groups = min(ngram_join.groups_for(len(a)), ngram_join.groups_for(len(b)))
        vectors = [ngram_join.unpack_counts(ngram_join.pack_counts(ngram_join.count_vector(x)), len(x), groups) for x in (a, b)]
        assert np.minimum(*vectors).sum() >= len(np.intersect1d(a, b)) == ngram_join.overlap(a, b)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7)] + [(900, 901), (901, 900)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {out[i] for i in range(100, 141)} == {100} and {out[i] for i in range(500, 560)} == {500} and out[901] == 900 and 7 not in out
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_search_equals_sql(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=40)
    rows = [(i, [float(x) for x in (hot if i % 3 == 0 else rng.normal(size=40))]) for i in range(150)]
    rows += [(None, rows[0][1]), (300, None), (320, []), (340, [float("nan"), 1.0, None]), (20, rows[20][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, code string")
    out = sorted((r.query_id, r["rank"], r.neighbor_id, r.distance) for r in hamming.top_k(df, "vec_id", "embedding", 10, F.col("vec_id") % 20 == 0, 40).collect())
    bits = {}
    for i, v in rows:
        if i is not None and v is not None:
            bits.setdefault(i, [k < len(v) and v[k] is not None and v[k] > 0 for k in range(40)])
    want = []
    for q in [i for i, v in rows if i is not None and v is not None and i % 20 == 0]:
        near = sorted((sum(x != y for x, y in zip(bits[q], b, strict=True)), i) for i, b in bits.items() if i != q)[:10]
        want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    assert out == sorted(want)


def test_pairs_beyond_the_distance_asked_for_do_not_leave_the_join(spark):
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (300, 4)).tolist()
    index = spark.createDataFrame([(c, i) for i, c in enumerate(codes)], "code array<int>, first bigint").select("code", "first", F.posexplode("code").alias("segment", "value"))
    asked = spark.createDataFrame([(codes[i], most) for i, most in ((0, 64), (1, 24), (2, 0))], "query array<int>, most int")
    apart = lambda a, b: [(x ^ y).bit_count() for x, y in zip(a, b, strict=True)]
    for radius in (0, 2, 4):
        met = hamming.met_pairs(asked, index, radius, 4)
        want = sorted((q, i) for q, most in ((0, 64), (1, 24), (2, 0)) for i, c in enumerate(codes) if min(w := apart(codes[q], c)) == radius and sum(w) <= most)
        assert sorted((codes.index(list(r.query)), r["first"]) for r in met.collect()) == want


def test_search_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert hamming.top_k(df, "vec_id", "embedding", 3, F.lit(True)).collect() == []


def test_sql_of_the_join_on_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = sorted(con.execute(ngram_join.SQL).fetchall())
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.query(spark, sf).collect()) == want
