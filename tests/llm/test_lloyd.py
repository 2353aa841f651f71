"""Vector codes against plain rounds over all entries."""

import hashlib
import math
import random

import numpy as np

from tracewell.llm import lloyd


def plain(rows, entries=256, parts=4, rounds=4):
    kept = [(i, label, [math.floor(1024 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][2]) // parts
    cut = lambda v: [tuple(v[p * width : (p + 1) * width]) for p in range(parts)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    books = [[cut(r[2])[p] for r in first] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, v in kept:
                members.setdefault(nearest(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            books[p] = [tuple(sum(c) // len(members[k]) for c in zip(*members[k])) if k in members else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = []
    for i, label, v in kept:
        best = [nearest(cut(v)[p], books[p]) for p in range(parts)]
        out.append([i, label, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)])
    errors = {}
    for _, label, _, error in out:
        errors[label] = errors.get(label, 0) + error
    return [(i, code, error, errors[label], digest) for i, label, code, error in out]


def check(spark, rows):
    df = spark.createDataFrame([(*r, "z") for r in rows], "vec_id bigint, embedding array<double>, label int, code string").repartition(3)
    got = [(r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in lloyd.encode(df).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    return got


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(5)
    few = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(40)]  # ties: entries that are alike
    rows = [(i, rng.choice(few) if rng.random() < 0.5 else [rng.gauss(0, 1) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(700)]
    rows += [(900, None, 1), (901, [1.0, None] * 4, 1), (902, [math.nan] * 8, 1), (903, [math.inf] + [0.0] * 7, 1), (904, [1.0] * 8, None), (904, [1.0] * 8, None), (None, [2.0] * 8, 3)]
    rng.shuffle(rows)
    assert len(check(spark, rows)) == 703


def test_few_rows_none_and_other_lengths(spark):
    assert len(check(spark, [(2, [0.5, -0.25, 0.0, 1.0], 1), (1, [0.5, -0.3, 0.0, 1.0], None)])) == 2
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert lloyd.encode(empty).collect() == []
    mixed = spark.createDataFrame([(1, [1.0] * 4, 1), (2, [1.0] * 8, 1), (3, [], 1), (4, [1e300] * 4, 1)], "vec_id bigint, embedding array<double>, label int")
    assert sorted(r.vec_id for r in lloyd.encode(mixed).collect()) == [1, 4]


def test_only_active_entries_change_a_fixed_part():
    rng = np.random.default_rng(2)
    parts, entries = rng.integers(-50, 50, (400, 3)), rng.integers(-50, 50, (20, 3))
    none = np.full(400, -1)
    code, distance = lloyd.assign(parts, entries, np.ones(20, bool), none, none)
    after = entries.copy()
    after[[3, 7]] = rng.integers(-50, 50, (2, 3))
    after[11] = after[2]  # an exact tie, which the lower entry wins
    moved = (after != entries).any(1)
    got = lloyd.assign(parts, after, moved, code, distance)
    want = lloyd.assign(parts, after, np.ones(20, bool), none, none)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    large = parts * (1 << 24)
    assert (lloyd._distances(large, entries) == ((large[:, None] - entries[None]) ** 2).sum(2)).all()
