"""From raw documents to packed sequences: language, quality, near copies, secrets, packing.

Each stage reads what the stage before it kept, written as a table, and all but the last return
the columns of documents.  ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.llm import langid, ngram_join, packing, quality, secrets
from tracewell.llm.common import by_name, by_place, stage, table

#: Share of the evidence that a text's language needs.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts of a language that is told with some confidence, with that language as ``lang``.

    Texts without a letter go, null and empty ones among them.  Rows with null ids and repeated
    rows are judged like others.
    """
    rows, names = by_place(docs)
    found = langid.identify(rows, langid.train(docs), names["text"])
    kept = found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return by_name(kept, names, lang=F.col("lang_pred").cast(docs.schema["lang"].dataType))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts that pass the base rules and resemble their language's own histograms, where these exist."""
    rows, names = by_place(docs)
    judged = quality.judge(rows, quality.language_references(docs), names["text"], names["lang"])
    return by_name(judged.filter("kept"), names)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each component of near copies."""
    return ngram_join.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts by the names of their kinds; rows with null ids and repeated rows stay."""
    rows, names = by_place(docs)
    found = secrets.scan(rows, secrets.train(docs), names["text"])
    cleaned = secrets.redacted(F.col(names["text"]), F.col("spans"))
    return by_name(found, names, text=cleaned, n_chars=F.length(cleaned).cast("bigint"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the texts in sequences of fixed length, those of null ids and repeated rows too."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", language),
    ("quality", rules),
    ("near_copies", near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Tokenizers and fitted models are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
