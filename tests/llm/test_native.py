"""Sharding and secret scans against plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import secrets, sharding
from tracewell.llm.common import number_from_zero


def jump(key: int, shards: int) -> int:
    at, following = -1, 0
    while following < shards:
        at = following
        key = (key * 2862933555777941757 + 1) % 2**64
        following = int((at + 1) * (2147483648.0 / ((key >> 33) + 1)))
    return at


DOCS = "doc_id bigint, text string, size string, shard string"


@pytest.mark.parametrize("shards", [1, 7, 40, 300])
def test_shards_equal_the_plain_walk(spark, shards):
    rows = [(i, "x" * (i % 7), "kept", "s") for i in range(400)] + [(None, None, "a", None), (None, "", None, None), (5, "äö", None, None), (5, "äö", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    out = sharding.shard_rows(docs, "doc_id", "text", shards).collect()
    assert len(out) == len(rows)
    places = {}
    for r in out:
        key = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:16], 16)
        assert (r.shard, r.grown_shard) == (jump(key, shards), jump(key, shards + 1))
        data = (r.text or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(data) + 16, zlib.crc32(data), "key")
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_shards_of_nothing(spark):
    assert sharding.shard_rows(spark.createDataFrame([], DOCS), "doc_id", "text", 4).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_rows(spark.createDataFrame([], DOCS), "doc_id", "text", 0)


def test_numbers_are_gapless_for_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 1).alias("k"), "id")
    out = number_from_zero(df, ["k"], ["id"], F.pmod(F.hash("id"), F.lit(16)), "n").groupBy("k").agg(
        F.countDistinct("n").alias("d"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("c")).collect()
    assert sorted((r.lo, r.hi, r.d, r.c) for r in out) == [(0, 999, 1000, 1000), (0, 1999, 2000, 2000)]


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_spans(text: str) -> list[tuple]:
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


TEXTS = [
    None, "", "no secret here", "password=hunter22", 'Token : "abcdef" api_key=\'short\' APIKEY=longenough1', 'secret=token"=abcdefgh', "AKIA" + "Z" * 16 + "AKIA" + "Q" * 3,
    "😀 passwd = 0123456789abcdef0123456789abcdef 😀 tail", "f" * 23 + " " + "f" * 24, "é" * 50 + "password:abcdef" * 3, "secret=abc" * 400, "zQ8vK2xLm9TqW4rB7nXc plain identifier_of_some_length",
]


def test_base_spans_equal_the_regex_module(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, base string")
    out = secrets.scan(df, secrets.train(df)).select("text", "base", "spans", secrets.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        base = [(s.start, s.rank, s.kind, s.end) for s in r.base]
        assert base == plain_spans(r.text or "")
        spans = [(s.start, s.rank, s.kind, s.end) for s in r.spans]
        assert set(base) <= set(spans) and spans == sorted(spans)
        want, at = [], 0
        for s, _, kind, e in spans:
            if s >= at:
                want += [r.text[at:s], f"<{kind}>"]
            at = max(at, e)
        assert r.clean == (None if r.text is None else "".join(want) + r.text[at:])


def test_models_tell_random_strings_from_identifiers(spark):
    rng = np.random.default_rng(1)
    random = ["".join(rng.choice(list(secrets.ALPHABET[:62]), 24)) for _ in range(60)]
    plain = ["getUserNameFromRequestHeader", "internationalisation_of_things", "verschiedenheitlichkeiten", "some-hyphenated-words-in-a-row"]
    rows = [(i, f"the name getUserName of things in headers and requests token={r} or verschiedenheit internationalisation some hyphenated words") for i, r in enumerate(random[:30])]
    rows += [(1000 + i, "ordinary text about users and their names, requests, headers, things that words say in a row") for i in range(300)]
    rows += [(100 + i, f"look at {r} here") for i, r in enumerate(random[30:])] + [(200 + i, f"look at {r} here") for i, r in enumerate(plain)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [s.kind for s in r.spans] for r in secrets.scan(df, secrets.train(df)).collect()}
    assert sum(found[100 + i] == ["markov"] for i in range(30)) >= 28
    assert all(found[200 + i] == [] for i in range(len(plain)))


def test_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert secrets.scan(empty, secrets.train(empty)).collect() == []
