"""Quality classifier: logistic regression on hashed word n-grams, fitted by FTRL-proximal updates.

The fit is one pass after another over a bounded sample, in one task that holds the weights and
the sample's features; scoring is a sparse dot product for each row, wherever it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import id_remainder, map_batches, table

#: Weights, the longest n-gram, labelled rows the model is fitted on at most, and passes over them.
DIMENSIONS, LONGEST, SAMPLE_ROWS, PASSES = 1 << 20, 2, 12_000, 8
#: FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 4.0, 1.0, 1e-4, 1e-4

_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BIAS, _SAME = 0, 1


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's word n-grams: root of the count, scaled to length one, and a bias.

    A word that follows itself is one feature whatever the word.
    """
    words = text.split() if text else []
    if not words:
        return np.array([_BIAS]), np.array([1.0])
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    parts = [one]
    for n in range(2, LONGEST + 1):
        if len(words) >= n:
            grams = parts[-1][:-1] * _FACTOR + one[n - 1 :]
            if n == 2:
                grams = np.where(one[:-1] == one[1:], np.uint64(_SAME) * _FACTOR, grams)
            parts.append(grams)
    hashes = np.concatenate(parts)
    hashes = (hashes ^ hashes >> np.uint64(29)) * _MIX
    slots, counts = np.unique((hashes >> np.uint64(40)).astype(np.int64) % (DIMENSIONS - 1) + 1, return_counts=True)
    values = np.sqrt(counts)
    values /= np.sqrt((values**2).sum())
    return np.append(slots, _BIAS), np.append(values, 1.0)


@dataclass
class Ftrl:
    """Follow the regularised leader: z gathers the gradients, n their squares."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls) -> Ftrl:
        return cls(np.zeros(DIMENSIONS), np.zeros(DIMENSIONS))

    def weights(self, slots: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(slots)
        gradient = (sigmoid(w @ values) - label) * values
        n = self.n[slots]
        step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA
        self.z[slots] += gradient - step * w
        self.n[slots] = n + gradient**2


def sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(x, -35, 35))))


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights from at most SAMPLE_ROWS rows of ``docs`` (doc_id, text) with a quality in ``labels``.

    The rows are those with the smallest digests of the id, and of an id that repeats the text with
    the smallest digest; rows without an id, and ids with both labels, teach nothing.  Without labels all weights are zero and every score is a half.
    """
    known = (
        labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other")).filter("label = other").select("doc_id", "label")
    )
    digest = F.xxhash64("doc_id")
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").withColumn("digest", digest).orderBy("digest", "doc_id").limit(SAMPLE_ROWS)
    rows = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "digest", "label", F.col("text").cast("string").cast("binary").alias("text"))
    # one row of each id, found map-side: a repeated id is no more than a row of the sample
    sample = rows.groupBy("doc_id", "digest", "label").agg(F.min(F.struct(F.xxhash64("text").alias("of_text"), "text")).alias("least")).select("digest", "label", "least.text")

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column("text")]
            made = [pa.array([r[i].astype(kind).tobytes() for r in rows], pa.binary()) for i, kind in ((0, "<i4"), (1, "<f4"))]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("label"), *made], ["digest", "label", "slots", "values"])

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for label, slots, values in zip(*(batch.column(c).to_pylist() for c in ("label", "slots", "values")), strict=True):
                rows.append((label, np.frombuffer(slots, "<i4"), np.frombuffer(values, "<f4")))
        model = Ftrl.empty()
        for _ in range(PASSES):
            for label, slots, values in rows:
                model.update(slots, values.astype(float), label)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype("<f4").tobytes()], pa.binary())], ["weights"])

    extracted = map_batches(sample, extract, "digest bigint, label int, slots binary, values binary")
    # the sample is bounded; its order is that of the digests, so the fit doesn't depend on the partitions
    fitted = map_batches(extracted.repartition(1).sortWithinPartitions("digest", "slots"), fit, "weights binary").collect()
    return np.frombuffer(bytes(fitted[0]["weights"]), "<f4") if fitted else np.zeros(DIMENSIONS, "<f4")


def classify(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """Add score for each row's whole text; an input column of this name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    others = docs.drop("score")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema] + ["score double"])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column(text):
                slots, values = features((t.as_py() or "").encode("utf-8", "replace"))
                out.append(sigmoid(float(shared.value[slots] @ values)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "score"])

    return map_batches(others, score, schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("fold", id_remainder("doc_id", 5))
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 5) != 0)
    weights = train(docs.filter("fold <> 0").select("doc_id", "text"), labels)
    scored = classify(docs.select("doc_id", "text", (F.col("fold") == 0).alias("held_out")), weights)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
