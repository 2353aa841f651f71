import random

import pytest
from pyspark.sql import functions as F

from tracewell.operators import delivery as D, generations as G, ordered as O
from tracewell.operators.intervals import latest_covering
from tracewell.operators.running import Running, running


def test_running_over_chunks(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.choice([None, rng.randint(0, 9)])) for k in "ab" for i in range(300)]
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    out = running(df, ["k"], ["seq"], {
        "total": Running("sum", F.col("v")), "before": Running("last", F.col("v"), exclusive=True), "top": Running("max", F.col("v")),
    }, chunk=F.floor(F.col("seq") / 32))
    got = {(r.k, r.seq): (r.total, r.before, r.top) for r in out.collect()}
    for k in "ab":
        total, before, top = 0, None, None
        for key, seq, v in rows:
            if key != k:
                continue
            previous = before
            if v is not None:
                total, before, top = total + v, v, v if top is None else max(top, v)
            assert got[(k, seq)] == (total, previous, top)


def test_latest_covering_interval(spark):
    rng = random.Random(5)
    spans = [(s, None if rng.random() < 0.03 else s + 1 + int(rng.expovariate(1 / 80)), f"t{s}") for s in rng.sample(range(5000), 200)]
    points = rng.sample(range(5200), 500)
    df = latest_covering(
        spark.createDataFrame([("k", p) for p in points], "k string, at long"),
        spark.createDataFrame([("k", *s) for s in spans], "k string, start long, stop long, name string"),
        ["k"], "at", "start", "stop", ["name"],
    )
    got = {r[0]: r[1] for r in df.select("at", "name").collect()}
    for p in points:
        over = [s for s in spans if s[0] <= p and (s[1] is None or s[1] > p)]
        assert got[p] == (max(over)[2] if over else None)


STEPS = ("request", "response", "start", "delta", "delta", "delta", "end", "error")


def simulate(events):
    """Event by event, straight from the rules; no runs, no ranges."""
    gens, ended_message, out = [], False, {}
    named = 0
    for seq, step, key, print_ in events:
        alive = [g for g in gens if not g["ended"]]
        found = next((g for g in gens if key and g["key"] == key), None)
        if step == "end" and ended_message:
            out[seq] = (None, "ignored")
            continue
        ended_message = ended_message or step == "end"
        if found is None and not key:
            if step == "request":
                found = alive[-1] if alive and print_ and alive[-1]["print"] == print_ else None
            else:
                pending = [g for g in alive if not g["started"]]
                found = (pending or alive or gens or [None])[-1]
        if found is None:
            name = key or f"turn:1:request:{named}"
            named += 0 if key else 1
            found = {"key": name, "print": print_ if step == "request" and not key else None, "started": False, "ended": False}
            gens.append(found)
        effect = "join"
        if step != "request":
            found["started"] = True
            effect = "ignored" if found["ended"] else step if step in ("end", "error") else "join"
            found["ended"] = found["ended"] or step in ("end", "error")
        out[seq] = (found["key"], effect)
    return out


@pytest.mark.parametrize("with_keys", [False, True])
def test_generation_routing(spark, with_keys):
    rng = random.Random(11)
    rows, want = [], {}
    for turn in range(40):
        events = []
        for seq in range(rng.randint(1, 40)):
            step = rng.choice(STEPS)
            # deltas carry keys only apart from each other: runs of one key are one step
            key = rng.choice(["", "", "k1", "k2"]) if with_keys and step != "delta" else ""
            events.append((seq, step, key, rng.choice(["p", "q"]) if step == "request" else None))
        rows += [("s", turn, 1, *e) for e in events]
        want.update({(turn, seq): result for seq, result in simulate(events).items()})
    df = spark.createDataFrame(rows, "session_key string, prompt_seq long, turn_index int, seq long, step string, request_key string, payload string")
    got = {(r.prompt_seq, r.seq): (r.generation_key, r.effect) for r in G.route(df).collect()}
    assert got == want


def test_concat_and_map_merge(spark):
    df = spark.createDataFrame([("a", i, str(i % 10)) for i in range(50)], "k string, seq long, t string")
    text = O.concat_in_order(df, ["k"], "seq", {"t": F.col("t")}).first().t
    assert text == "0123456789" * 5
    updates = df.select("k", "seq", F.create_map(F.concat(F.lit("m"), "t"), "seq").alias("m"), F.when(F.col("seq") < 30, F.col("t")).alias("name"))
    row = O.fold_updates(updates, ["k"], "seq", ["name"], ["m"]).first()
    assert row["name"] == "9"
    assert row.m == {f"m{d}": 40 + d for d in range(10)}


def test_batches_hold_every_event_once_within_the_limit(spark):
    rng = random.Random(7)
    rows = [(t, s, rng.randint(1, 400)) for t in range(60) for s in range(rng.randint(1, 6))]
    rows += [(1000, s, rng.choice([5, 300, 900, 1500])) for s in range(200)]
    df = spark.createDataFrame(rows, "trace_id long, seq long, bytes long")
    packed = D.pack_batches(df, D.trace_shard(3), limit=1000).collect()
    assert sorted((r.trace_id, r.seq, r.bytes) for r in packed) == sorted(rows)
    sizes, homes, members = {}, {}, {}
    for r in packed:
        sizes[r.batch] = sizes.get(r.batch, 0) + r.bytes
        members[r.batch] = members.get(r.batch, 0) + 1
        homes.setdefault(r.trace_id, set()).add(r.batch)
    # as sent: with the envelope, and a comma after each event
    assert all(size + members[b] + D.ENVELOPE_BYTES <= 1000 or members[b] == 1 for b, size in sizes.items())
    total = {t: sum(b for k, _, b in rows if k == t) for t, _, _ in rows}
    count = {t: sum(k == t for k, _, _ in rows) for t, _, _ in rows}
    assert all(len(h) == 1 for t, h in homes.items() if total[t] + count[t] + D.ENVELOPE_BYTES <= 1000)
    assert D.shards_for(10**12) > D.shards_for(10**9) == 5
