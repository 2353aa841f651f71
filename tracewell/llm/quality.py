"""Quality rules: how far a text's characters and common words are from its language's.

Two histograms of a text, of character classes and of the language's common words, are
compared with the language's own by Jensen-Shannon distance.  A text is kept if its own
language, or another one of many documents, is near enough in both; a text whose language has
no histograms is never judged by those of others.  Histograms of few words are noisy, a text's
and a small language's: the limit is wider for them, and short texts aren't judged at all.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_batches, once_per_worker, table

#: Common words of a language, and words that a task holds before it hands on their counts so far.
COMMON_WORDS, TASK_WORDS = 40, 1 << 18
#: Documents that a language needs for its histograms to speak for texts of another label too.
LEAST_DOCUMENTS = 20
#: Distances from which a text is refused; the noise of histograms of n and m words adds NOISE * sqrt(1 / n + 1 / m).
CHARACTER_LIMIT, WORD_LIMIT, NOISE = 0.30, 0.24, 1.3
#: Characters and words that a text needs for the comparison.
LEAST_CHARACTERS, LEAST_WORDS = 200, 50
#: A document's share in its language's histograms, as an integer.
UNIT = 1_000_000

SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
CLASSES = ("space", "lower", "upper", "letter", "digit", "stop", "mark", "cry", "symbol", "other")
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"


def _class_of(c: str) -> int:
    if c in SPACES:
        return 0
    if c.isalpha():
        return 1 if c.islower() else 2 if c.isupper() else 3
    if c.isdigit():
        return 4
    for i, marks in ((5, ".,"), (6, ";:?'\"()-"), (7, "!"), (8, SYMBOLS)):
        if c in marks:
            return i
    return 9


def _class_table() -> np.ndarray:
    return np.array([_class_of(chr(i)) for i in range(0x110000)], np.uint8)


def character_counts(text: str) -> np.ndarray:
    classes = once_per_worker("character classes", _class_table)
    return np.bincount(classes[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")], minlength=len(CLASSES))


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words within a window of ``width`` words that the text holds twice or more."""
    if len(words) < width:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    windows = codes[: len(codes) - width + 1]
    for i in range(1, width):
        windows = np.unique(windows, return_inverse=True)[1] * np.int64(len(numbers)) + codes[i : len(codes) - width + 1 + i]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(words), bool)
    for i in range(width):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    seen, again = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            again += line in seen
            seen.add(line)
    return again


def base_measures(text: bytes, words: list[bytes], decoded: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    repeats = repeated_words(words)
    n = len(words)
    return (
        n, len(decoded) - sum(map(decoded.count, SPACES)), sum(map(decoded.count, SYMBOLS)), duplicate_lines(text), repeats,
        n < 50 or 100 * repeats > 50 * n,
    )


@dataclass
class Reference:
    """A language's histograms: of character classes, and of its common words with all others last.

    ``spread`` is 1 / m for histograms as noisy as those of m words.
    """

    characters: np.ndarray
    words: dict[bytes, int]
    shares: np.ndarray
    documents: int
    spread: float

    def word_counts(self, counts: Counter, total: int) -> np.ndarray:
        out = np.zeros(len(self.words) + 1)
        for w, i in self.words.items():
            out[i] = counts.get(w, 0)
        out[-1] = total - out.sum()
        return out


def divergence(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance, from 0 to 1; 0 where one of the two is empty."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2
    parts = [(x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (p, q)]
    return math.sqrt(max(0.0, sum(parts) / 2))


def near(text: str, words: list[bytes], reference: Reference, counts: Counter, classes: np.ndarray) -> bool:
    if len(text) >= LEAST_CHARACTERS and divergence(classes.astype(float), reference.characters) > CHARACTER_LIMIT:
        return False
    if len(words) < LEAST_WORDS:
        return True
    return divergence(reference.word_counts(counts, len(words)), reference.shares) <= WORD_LIMIT + NOISE * math.sqrt(1 / len(words) + reference.spread)


def language_references(docs: DataFrame) -> dict[str, Reference]:
    """Histograms of each value of ``lang``, from all documents that pass the base rules.

    Each document has the same weight, and all words are counted, as integers, so the result
    doesn't depend on partitions.  Tasks hand on their sums, and of the totals a task's COMMON_WORDS
    most frequent of a language; what comes to the driver is a few dozen rows a language.
    """
    schema = "lang string, kind int, feature binary, weight bigint"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, dict[bytes, int]]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (classes, words) in held.items():
                for kind, sums in enumerate(({str(i).encode(): int(v) for i, v in enumerate(classes) if v}, words)):
                    n = len(sums)
                    columns = [lang] * n, [kind] * n, list(sums.keys()), list(sums.values())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.binary(), pa.int64()), strict=True)], ["lang", "kind", "feature", "weight"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                data = text.as_py() or b""
                words = data.split()
                if lang is None or len(words) < 50 or 2 * repeated_words(words) > len(words):
                    continue
                classes, weights = held.setdefault(lang, (np.zeros(len(CLASSES) + 2, np.int64), defaultdict(int)))
                own = character_counts(data.decode("utf-8", "replace"))
                classes[:-2] += own * UNIT // own.sum()
                classes[-2:] += 1, UNIT // len(words)
                before = len(weights)
                for w, n in Counter(data.lower().split()).items():
                    weights[w] += n * UNIT // len(words)
                size += len(weights) - before
                if size > TASK_WORDS:
                    yield from flush()
                    size = 0
        yield from flush()

    source = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))
    sums = map_batches(source, count, schema).groupBy("lang", "kind", "feature").agg(F.sum("weight").alias("weight"))
    first = Window.partitionBy("lang", "kind").orderBy(F.desc("weight"), "feature")
    top = sums.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= COMMON_WORDS)
    rows: dict[str, tuple[np.ndarray, list[tuple[bytes, int]]]] = {}
    for r in top.orderBy("lang", "kind", "rank").collect():
        classes, words = rows.setdefault(r["lang"], (np.zeros(len(CLASSES) + 2), []))
        if r["kind"] == 0:
            classes[int(bytes(r["feature"]))] = r["weight"]
        else:
            words.append((bytes(r["feature"]), r["weight"]))
    out = {}
    for lang, (classes, words) in rows.items():
        documents = classes[-2]
        shares = np.array([w for _, w in words] + [max(0.0, documents * UNIT - sum(w for _, w in words))])
        # documents weigh the same, so the variance is the mean of theirs over their number
        spread = classes[-1] / UNIT / documents**2
        out[lang] = Reference(classes[:-2], {w: i for i, (w, _) in enumerate(words)}, shares, int(documents), spread)
    return out


def judge(docs: DataFrame, references: dict[str, Reference], text: str = "text", lang: str | None = None) -> DataFrame:
    """Add the measures of each row's whole text and whether it is kept.

    Input columns of the measures' names are replaced.  A null or empty text has no words and
    fails the base rules.  ``lang`` is the column (a string) with each text's language: where it
    is null or has no reference the base rules alone decide.  Without it all texts are taken to
    be of the languages of ``references``; if there are none the base rules alone decide.
    """
    shared = docs.sparkSession.sparkContext.broadcast(references)
    names = [f.split(" ")[0] for f in MEASURES.split(", ")]
    others = docs.drop(*[n for n in names if n != text])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema] + [MEASURES])

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 5 + [pa.bool_()] * 2
        known = shared.value
        of_many = {k: r for k, r in known.items() if r.documents >= LEAST_DOCUMENTS}
        for batch in batches:
            rows = []
            langs = batch.column(lang).to_pylist() if lang else [None] * batch.num_rows
            for value, label in zip(batch.column(text), langs, strict=True):
                decoded = value.as_py() or ""
                data = decoded.encode("utf-8", "replace")
                words = data.split()
                base = base_measures(data, words, decoded)
                kept = not base[-1]
                if kept and (label in known if lang else known):
                    counts, classes = Counter(data.lower().split()), character_counts(decoded)
                    compared = {label: known[label], **of_many} if lang else known
                    kept = any(near(decoded, words, r, counts, classes) for r in compared.values())
                rows.append((*base, kept))
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return map_batches(others, measure, schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    judged = judge(docs.select("doc_id", "text", F.col("lang").cast("string").alias("__lang")), language_references(docs), lang="__lang")
    return judged.drop("text", "__lang")
