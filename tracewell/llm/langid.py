"""Language identification: known words first, then ever shorter character n-grams.

Each known word has a logarithmic frequency in each language.  An unknown word is scored by
the longest of its character n-grams that are known, from five characters down to one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_remainder, map_batches, table

#: Labelled rows the model is fitted on at most, words kept of each language, and the longest n-gram.
SAMPLE_ROWS, WORDS, LONGEST = 20_000, 10_000, 5
#: Words whose scores a task remembers.
REMEMBERED = 150_000
#: Words of evidence at which a score stops growing.
EVIDENCE = 20
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter:
    """Runs of letters, lower-cased, with their counts."""
    out: Counter = Counter()
    for token, n in Counter(text.lower().split()).items():
        if token.isalpha():
            out[token] += n
        else:
            for run in _WORD.findall(token):  # has numerals too that are no decimal digits
                for word in (run,) if run.isalpha() else "".join(c if c.isalpha() else " " for c in run).split():
                    out[word] += n
    return out


def grams(word: str, n: int) -> Iterator[str]:
    framed = f"^{word}$"
    return (framed[i : i + n] for i in range(len(framed) - n + 1))


class Backoff:
    """Log frequencies of words and n-grams by language: a row of a matrix for each."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        sizes = range(LONGEST + 1)  # 0: words
        self.places: list[dict[str, int]] = [{} for _ in sizes]
        entries: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in sizes]
        for column, lang in enumerate(self.languages):
            for word, n in counts[lang].items():
                for size in sizes:
                    for key in (word,) if size == 0 else grams(word, size):
                        place = self.places[size].setdefault(key, len(self.places[size]))
                        for held, value in zip(entries[size], (place, column, n), strict=True):
                            held.append(value)
        self.rows = []
        for places, (row, column, n) in zip(self.places, entries, strict=True):
            sums = np.zeros((len(places), len(self.languages)))
            np.add.at(sums, (row, column), n)
            self.rows.append(np.log((sums + 0.5) / (sums.sum(0) + 0.5 * len(places))))
        self._forget()

    def _forget(self) -> None:
        """What is remembered of words: a row of a matrix each, -1 for none."""
        self.memory: dict[str, int] = {}
        self.remembered = np.empty((0, len(self.languages)))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("memory", "remembered")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    @property
    def tables(self) -> list[dict[str, np.ndarray]]:
        """Rows by word (first) and by n-gram of each length."""
        return [{key: rows[place] for key, place in places.items()} for places, rows in zip(self.places, self.rows, strict=True)]

    def score(self, word: str) -> np.ndarray | None:
        """The word's log frequency by language; None where not even a character of it is known."""
        known = self.places[0].get(word)
        if known is not None:
            return self.rows[0][known]
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            found = [r for g in grams(word, n) if (r := self.places[n].get(g)) is not None]
            if found and (n > 1 or len(found) > 2):  # of the frame alone nothing follows
                return sum(map(self.rows[n].__getitem__, found)) / len(found)
        return None

    def _row(self, word: str) -> np.ndarray | None:
        place = self.memory.get(word)
        if place is not None:
            return self.remembered[place] if place >= 0 else None
        row = self.score(word)
        if len(self.memory) < REMEMBERED and len(word) < 40:
            if row is not None and len(self.memory) >= len(self.remembered):
                self.remembered = np.resize(self.remembered, (max(1024, 2 * len(self.memory) + 2), len(self.languages)))
            self.memory[word] = -1 if row is None else len(self.memory)
            if row is not None:
                self.remembered[self.memory[word]] = row
        return row

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its share of the evidence; `und` without a letter.

        A text with letters of which none is known gets the first language and an even share.
        """
        words = words_of(text) if text else None
        if not words or not self.languages:
            return UNDETERMINED, 0.0
        total, weight = np.zeros(len(self.languages)), 0
        for word, n in words.items():
            row = self._row(word)
            if row is not None:
                total += n * row
                weight += n
        if not weight:
            return self.languages[0], 1 / len(self.languages)
        mean = total / weight * min(weight, EVIDENCE)
        share = np.exp(mean - mean.max())
        best = int(share.argmax())
        return self.languages[best], float(share[best] / share.sum())


def train(docs: DataFrame) -> Backoff:
    """Fit on at most SAMPLE_ROWS rows with an id and a language, those with the smallest digests of the id.

    Of rows that repeat an id one is taken.
    """
    digest = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    labelled = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    chosen = labelled.select("doc_id").withColumn("digest", digest).orderBy("digest", "doc_id").limit(SAMPLE_ROWS).select("doc_id").distinct()
    rows = labelled.join(F.broadcast(chosen), "doc_id", "left_semi")
    least = F.min(F.struct(F.xxhash64("text").alias("of_text"), F.col("lang").cast("string").alias("lang"), "text")).alias("least")
    sample = rows.groupBy("doc_id").agg(least).select("least.lang", "least.text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                held.setdefault(lang, Counter()).update(words_of(text.as_py()))
            rows = [(lang, w, n) for lang, words in held.items() for w, n in words.items()]
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()), strict=True)], ["lang", "word", "n"])

    sums = map_batches(sample, count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    counts: dict[str, dict[str, int]] = {}
    for r in sums.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= WORDS).toArrow().to_pylist():
        counts.setdefault(r["lang"], {})[r["word"]] = r["n"]
    return Backoff(counts)


def identify(docs: DataFrame, model: Backoff, text: str = "text") -> DataFrame:
    """Add lang_pred and score for each row's whole text; input columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = docs.drop("lang_pred", "score")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others.schema] + ["lang_pred string, score double"])

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(text)]
            made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "lang_pred", "score"])

    return map_batches(others, predict, schema)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("fold", id_remainder("doc_id", 3))
    model = train(docs.filter("fold <> 1"))
    found = identify(docs.select("doc_id", "text", (F.col("fold") == 1).alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
