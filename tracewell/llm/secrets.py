"""Secret scans: three shapes found by pattern, and random-looking strings found by character Markov models.

Both models are counts of character pairs, of random strings and of ordinary identifiers, taken
from labelled samples of the table itself: the values that the patterns find, and the words beside
them.  A candidate is a secret if its pairs are likelier under the first, by the logarithm of the
ratio.  Everything is a Column expression: matches are cut out by the same pattern that finds
them, and their places are the running lengths of what lies between.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import table

# The shapes that are always reported, as (kind, pattern, group of the value, its least length).
SHAPES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
KINDS = tuple(s[0] for s in SHAPES)

#: Characters of the models; candidates are runs of them of so many at least.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Identifiers are shorter than candidates, so that no candidate speaks for itself.
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_]{3,14}(?![A-Za-z0-9+/_=-])"
#: Documents that the samples are taken from at most, those with the smallest digests of the id.
SAMPLE_ROWS = 4096
#: Count that each character has in advance, weight of a character's own share beside its pairs, and the
#: log-likelihood ratio from which a candidate is a secret: in all, and by pair.
PRIOR, BACKOFF, LEAST_RATIO, LEAST_MEAN = 1.0, 20.0, 12.0, 0.75
MODEL_KIND = "markov"

SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _found(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, end, value) of the pattern's matches, in code points; guarded by a test that most texts fail."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    rows = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("between"), found.alias("found"), values.alias("value"))
    spans = F.aggregate(
        rows,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string>>)").alias("out")),
        lambda state, row: F.struct(
            (state["at"] + F.length(row["between"]) + F.length(row["found"])).cast("bigint").alias("at"),
            F.concat(state["out"], F.array(F.struct(
                (state["at"] + F.length(row["between"])).cast("bigint").alias("start"),
                (state["at"] + F.length(row["between"]) + F.length(row["found"])).cast("bigint").alias("end"), row["value"].alias("value"),
            ))).alias("out"),
        ),
        lambda state: state["out"],
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string>>)"))


def _long_enough(found: Column, least: int, field: str | None = None) -> Column:
    return F.filter(found, lambda x: F.length(x if field is None else x[field]) >= least)


def _named(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Spans of the three shapes, by start, then kind."""
    parts = [
        _named(_long_enough(_found(text, pattern, group), least, "value"), rank, kind)
        for rank, (kind, pattern, group, least) in enumerate(SHAPES)
    ]
    return F.array_sort(F.concat(*parts))


def _place(character: Column) -> Column:
    return F.instr(F.lit(ALPHABET), character) - 1


def pair_counts(docs: DataFrame, text: str) -> list[tuple[int, str, int]]:
    """(label, pair of characters, count): label 1 for values of the shapes, 0 for identifiers beside them."""
    value = F.coalesce(F.col(text), F.lit(""))
    random = F.concat(*[
        _long_enough(F.regexp_extract_all(value, F.lit(pattern), F.lit(group)), least) for _, pattern, group, least in SHAPES
    ])
    rest = value
    for _, pattern, _, _ in SHAPES:
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    labelled = [docs.select(F.lit(label).alias("label"), F.explode(words).alias("word")) for label, words in ((1, random), (0, ordinary))]
    words = labelled[0].unionByName(labelled[1])
    pairs = words.select("label", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("word") - 1, F.lit(1))), lambda i: F.substring(F.col("word"), i, F.lit(2)))).alias("pair"))
    known = pairs.filter(F.length("pair") == 2).groupBy("label", "pair").count()
    return [(r["label"], r["pair"], r["count"]) for r in known.collect() if set(r["pair"]) <= set(ALPHABET)]


def ratios(counts: Sequence[tuple[int, str, int]]) -> np.ndarray:
    """log P(next | character) of random strings minus that of identifiers, a square matrix laid flat."""
    size = len(ALPHABET)
    both = np.zeros((2, size, size))
    for label, pair, n in counts:
        both[label, ALPHABET.index(pair[0]), ALPHABET.index(pair[1])] += n
    single = both.sum(1) + PRIOR  # of the second character, whatever the first
    single /= single.sum(1, keepdims=True)
    chances = np.log((both + BACKOFF * single[:, None, :]) / (both.sum(2, keepdims=True) + BACKOFF))
    return (chances[1] - chances[0]).ravel()


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """The matrix of ratios from a bounded sample of documents; all near zero where there are none.

    Of rows that repeat an id one is taken.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    chosen = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("__key"), digest.alias("__digest")).orderBy("__digest").limit(SAMPLE_ROWS).select("__key").distinct()
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__key", "left_semi")
    sample = rows.groupBy("__key").agg(F.min(F.struct(F.xxhash64("__text").alias("of_text"), "__text")).alias("least")).select(F.col("least.__text").alias(text))
    return ratios(pair_counts(sample, text))


def _scored(value: Column, matrix: np.ndarray) -> Column:
    table_ = F.lit(np.round(matrix, 6))
    pairs = F.sequence(F.lit(1), F.length(value) - 1)
    return F.aggregate(pairs, F.lit(0.0), lambda total, i: total + F.get(
        table_, _place(F.substring(value, i, F.lit(1))) * len(ALPHABET) + _place(F.substring(value, i + 1, F.lit(1)))))


def model_spans(text: Column, base: Column, matrix: np.ndarray) -> Column:
    """Candidates with a letter whose pairs are those of random strings, outside the base spans."""
    found = F.filter(_found(text, CANDIDATE, 0), lambda c: c["value"].rlike("[A-Za-z]") & ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    random = F.filter(found, lambda c: _scored(c["value"], matrix) >= F.greatest(F.lit(LEAST_RATIO), (F.length(c["value"]) - 1) * LEAST_MEAN))
    return _named(random, len(KINDS), MODEL_KIND)


def scan(docs: DataFrame, matrix: np.ndarray, text: str = "text") -> DataFrame:
    """Add the columns base and spans (start, rank, kind, end); input columns of these names are replaced.

    Null and empty texts have none.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    with_base = docs.drop(*[c for c in ("base", "spans") if c != text]).withColumn("base", base_spans(value))
    return with_base.withColumn("spans", F.array_sort(F.concat("base", model_spans(value, F.col("base"), matrix))))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones joined, replaced by the name of its first kind."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<string>)").alias("parts"))
    cut = F.aggregate(spans, start, lambda state, s: F.when(
        s["start"] >= state["at"],
        F.struct(s["end"].alias("at"), F.concat(state["parts"], F.array(
            F.substring(text, state["at"].cast("int") + 1, (s["start"] - state["at"]).cast("int")), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("parts")),
    ).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["parts"].alias("parts"))))
    whole = F.transform(F.array(cut), lambda c: F.concat(
        F.array_join(c["parts"], ""), F.substring(text, c["at"].cast("int") + 1, F.lit(2**31 - 1))))[0]
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
