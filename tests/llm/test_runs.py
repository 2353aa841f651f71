"""Runs by grammar against all periods tried one by one."""

import hashlib
import random
import zlib

import numpy as np

from tracewell.llm import runs


def brute(words):
    """Every maximal stretch of every period."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def document(rng):
    letters, words = rng.choice([1, 2, 2, 3, 5, 50]), []
    for _ in range(rng.randint(0, 8)):
        kind = rng.random()
        if kind < 0.4:
            words += [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
        elif kind < 0.8:
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, rng.choice([2, 5, 20])))]
            words += (unit * rng.randint(2, 14))[: rng.randint(10, 200)]
        elif words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 60)]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    found = 0
    for _ in range(120):
        group = [document(rng) for _ in range(rng.randint(1, 12))]
        got = runs.find_runs(np.array([w for d in group for w in d], np.int64), np.cumsum([len(d) for d in group]))
        for words, mine in zip(group, got, strict=True):
            want = brute(words)
            found += len(want)
            assert mine == want, words
    assert found > 400


def test_a_grammar_derives_its_words_and_counts_its_places():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 9, 1, 2, 7, 7, 7, 7, 7])
    g = runs.Grammar(words, np.array([len(words)]))
    for rule, place in zip(g.rule.tolist(), g.place.tolist(), strict=True):
        length = g.stops[rule] - g.starts[rule]
        assert words[place : place + length].tolist() == words[g.starts[rule] : g.stops[rule]].tolist()
        assert g.starts[rule] < g.splits[rule] < g.stops[rule]
    assert len(set(g.rule.tolist())) == len(g.starts) < len(g.rule)  # some rules come again
    assert (g.stops - g.starts).max() == len(words)


def test_long_regular_words_take_little_time():
    a, b = [0], [0, 1]
    while len(b) < 30_000:
        a, b = b, b + a
    for words in ([0] * 60_000, [0, 1] * 30_000, b, [x for i in range(300) for x in range(i)]):
        got = runs.find_runs(np.array(words, np.int64), np.array([len(words)]))[0]
        for start, length, period in got[:50] + got[-50:]:
            assert words[start : start + length - period] == words[start + period : start + length]


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs if len(r.text.split()) < 1500]
    rows += [(None, None), (None, "a " * 30), (4, None), (5, ""), (5, ""), (6, " \n"), (7, "x\x0by\x1cz é " * 20)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_runs int")
    got = sorted(map(tuple, runs.collapse_runs(df).collect()), key=str)
    assert got == sorted((plain_row(i, t) for i, t in rows), key=str)
    assert runs.collapse_runs(df.limit(0)).collect() == []
