"""Vector codes from codebooks that Lloyd's rounds refine, with active entries.

A vector's integer components are cut into equal consecutive parts; each part position has a
codebook.  A round assigns every part to its nearest entry and replaces the entries by the means
of their parts.  A part keeps its entry and exact distance: where that entry stayed as it was,
only the entries that moved are compared with the stored distance; where it moved, all are.

Rounds are stage tables.  Codebooks travel with the tasks (at most ``ENTRIES`` vectors); sums of
parts are taken in each task and added by key.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, stage, table

ENTRIES, PARTS, ROUNDS = 256, 4, 4
#: An integer component is this many times the component, rounded down.
SCALE = 1024

_STATE = "vec_id bigint, label string, vector array<bigint>, code array<int>, distance array<bigint>"


def integer_vectors(rows: DataFrame, vector: str, label: str) -> DataFrame:
    """vec_id, label (as text) and the integer components of vectors without null or non-finite ones.

    Vectors of another length than that of the smallest vec_id are not of the table's kind and are
    left out, as are empty ones and those whose length the parts don't divide.  Components are held
    to a bound under which no sum of squares passes a long.
    """
    value = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))), F.lit(False))
    kept = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), value.alias("value")).filter(fine)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "value").limit(1).select(F.size("value").alias("n")).collect()
    length = first[0].n if first and first[0].n and first[0].n % PARTS == 0 else -1
    bound = float(math.isqrt((1 << 62) // max(length, 1)) // 2)
    scaled = F.transform("value", lambda x: F.floor(F.greatest(F.least(x * SCALE, F.lit(bound)), F.lit(-bound))).cast("bigint"))
    return kept.filter(F.size("value") == length).select("vec_id", "label", scaled.alias("vector"))


def first_codebooks(vectors: DataFrame) -> np.ndarray:
    """Parts of the vectors with the smallest ids (of equal ids, in the order of the components): part, entry, component."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).select("vector").collect()
    data = np.array([r.vector for r in rows], np.int64)
    return data.reshape(len(rows), PARTS, -1).transpose(1, 0, 2).copy() if rows else np.empty((PARTS, 0, 0), np.int64)


def _distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of each part to each entry, exact: in doubles only where no sum passes 2^53."""
    most = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * int(most) ** 2 * max(parts.shape[1], 1) < 1 << 53:
        a, b = parts.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(parts), len(entries)), np.int64)
    for c in range(parts.shape[1]):
        out += (parts[:, c, None] - entries[None, :, c]) ** 2
    return out


def assign(parts: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lowest of equally near ones, and its distance.

    ``code`` -1 stands for parts without an entry yet.
    """
    code, distance = code.copy(), distance.copy()
    again = (code < 0) | moved[code]
    rows = np.flatnonzero(again)
    if len(rows):
        found = _distances(parts[rows], entries)
        code[rows] = found.argmin(1)
        distance[rows] = found[np.arange(len(rows)), code[rows]]
    rows, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(rows) and len(active):
        found = _distances(parts[rows], entries[active])
        best = found.argmin(1)
        near, entry = found[np.arange(len(rows)), best], active[best]
        better = (near < distance[rows]) | ((near == distance[rows]) & (entry < code[rows]))
        code[rows[better]], distance[rows[better]] = entry[better], near[better]
    return code, distance


def _assigned(state: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n = len(batch)
            vectors = batch.column("vector").flatten().to_numpy().reshape(n, PARTS, -1)
            old = [batch.column(c).flatten().to_numpy().reshape(n, PARTS) for c in ("code", "distance")]
            new = [assign(vectors[:, p], books[p], moved[p], old[0][:, p], old[1][:, p]) for p in range(PARTS)]
            ends = pa.array(np.arange(n + 1) * PARTS, pa.int32())
            code, distance = (pa.array(np.stack(x, 1).ravel(), t) for x, t in zip(zip(*new, strict=True), (pa.int32(), pa.int64()), strict=True))
            lists = [pa.ListArray.from_arrays(ends, x) for x in (code, distance)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "vector")), *lists], ["vec_id", "label", "vector", "code", "distance"])

    return map_batches(state, run, _STATE)


def _sums(state: DataFrame, entries: int, width: int) -> DataFrame:
    """The number of parts of each entry, and their sum in each component; a row per entry and task before they are added."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS * entries, width), object)
        counts = np.zeros(PARTS * entries, np.int64)
        for batch in batches:
            n = len(batch)
            vectors = batch.column("vector").flatten().to_numpy().reshape(n, PARTS, width)
            code = batch.column("code").flatten().to_numpy().reshape(n, PARTS)
            for p in range(PARTS):
                at = code[:, p].astype(np.int64) + p * entries
                counts += np.bincount(at, minlength=PARTS * entries)
                for c in range(width):
                    # halves of 31 bits: their sums over a batch are exact in doubles
                    high, low = vectors[:, p, c] >> 31, vectors[:, p, c] & 0x7FFFFFFF
                    sums = [np.bincount(at, x, PARTS * entries).astype(np.int64).astype(object) for x in (high, low)]
                    total[:, c] += sums[0] * (1 << 31) + sums[1]
        used = np.flatnonzero(counts)
        rows = pa.array([[Decimal(int(x)) for x in total[i]] for i in used], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), rows], ["at", "n", "sums"])

    parts = map_batches(state.select("vector", "code"), run, "at int, n bigint, sums array<decimal(38,0)>")
    each = parts.select("at", "n", F.posexplode("sums").alias("component", "value"))
    return each.groupBy("at", "component").agg(F.sum("n").alias("n"), F.sum("value").cast("decimal(38,0)").alias("value"))


def refine(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Each vector with its code (an entry for each part) and exact distances, and the codebooks, after some rounds."""
    books = first_codebooks(vectors)
    entries, width = books.shape[1], books.shape[2]
    none = [F.array(*[F.lit(-1).cast(t)] * PARTS) for t in ("int", "bigint")]
    state = vectors.select("vec_id", "label", "vector", none[0].alias("code"), none[1].alias("distance"))
    if not entries:
        return state, books
    moved = np.ones((PARTS, entries), bool)
    for _ in range(rounds):
        state = stage(_assigned(state, books, moved), "lloyd")
        after = books.copy()
        for row in _sums(state, entries, width).collect():
            after[row["at"] // entries, row["at"] % entries, row["component"]] = int(row["value"]) // row["n"]
        moved, books = (after != books).any(2), after
    return stage(_assigned(state, books, moved), "lloyd"), books


def digest(books: np.ndarray) -> str:
    """The digest of all components by part, entry and position, in decimal."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code (two hexadecimal digits for each part), error, label_error and codebooks_sha256.

    A row for each vector kept (see ``integer_vectors``), repeated rows and ids included; null
    ids come after all others.  Fewer than ``ENTRIES`` vectors make smaller codebooks, none make no
    rows.  Null labels are one label.  Other columns are left aside.  Errors of a label that pass a
    long are given as the largest long.
    """
    state, books = refine(integer_vectors(rows, vector, label), rounds)
    code = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    error = F.aggregate("distance", F.lit(0).cast("bigint"), lambda a, d: a + d)
    out = state.select("vec_id", "label", code.alias("code"), error.alias("error"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("bigint")
    labels = out.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    joined = out.join(labels, out["label"].eqNullSafe(labels["of"]))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def query(spark, sf_dir):
    return encode(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds written out: full comparisons of every part with every entry."""
    steps = [
        """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 1024) AS BIGINT)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""p AS (SELECT vec_id, label, part, vec[part * len(vec) // {PARTS} + 1 : (part + 1) * len(vec) // {PARTS}] AS x FROM v, range({PARTS}) r(part))""",
        f"""b0 AS (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, x AS c FROM p
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {ENTRIES}))""",
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, label, part, any_value(x) AS x, min({{'d': d, 'e': entry}}) AS best FROM (
  SELECT p.*, entry, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p JOIN b{i} USING (part)
) GROUP BY vec_id, label, part)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS (SELECT part, entry, list(mean ORDER BY pos) AS c FROM (
  SELECT part, best.e AS entry, pos, CAST(floor(sum(x[pos])::HUGEINT::DOUBLE / count(*)) AS BIGINT) AS mean
  FROM a{i}, unnest(range(1, len(x) + 1)) u(pos) GROUP BY ALL) GROUP BY ALL)""")
            steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{i}.c, b{i}.c) AS c FROM b{i} LEFT JOIN m{i} USING (part, entry))""")
    return f"""WITH {",".join(steps)},
e AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id, label),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM e, s"""


SQL = _sql()
