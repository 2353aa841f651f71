"""Quality rules, the classifier and language ID: plain Python, held-out accuracy, odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import classifier, langid, quality

SF = "/root/testdata/sf0.01"
TEXTS = [
    None, "", " \n\t", "a b c a b c", "a b c\na b c\n\nx\n x\nx", "😀 é#*$%&|<> word\x0bword\x1cword", "tab\tfeed\x0cline\r\nline\r\n", "w " * 5000, "a a a", "one two", "\x85  x",
]


def plain_measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_measures_equal_plain_ones(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150).collect()
    rows = [(r.doc_id, r.text, "x") for r in docs] + [(10_000 + i, t, None) for i, t in enumerate(TEXTS)] + [(None, "x y z " * 30, "en")] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    out = quality.judge(df, {}).collect()
    assert len(out) == len(rows)
    for r in out:
        want = plain_measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, r.text
        assert r.kept == (not want[-1])


def test_divergence():
    a, b = np.array([3.0, 1.0, 0.0]), np.array([0.0, 0.0, 5.0])
    assert quality.divergence(a, 7 * a) == 0 and abs(quality.divergence(a, b) - 1) < 1e-12
    assert quality.divergence(a, np.zeros(3)) == 0
    assert abs(quality.divergence(a, np.array([1.0, 3.0, 0.0])) - 0.4344) < 1e-3


def test_rules_keep_prose_and_refuse_junk(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = [r for r in quality.query(spark, SF).collect() if r.doc_id in labels and not r.base_failed]
    good, bad = ([r.kept for r in out if labels[r.doc_id] == q] for q in (1, 0))
    assert sum(good) == len(good) and sum(bad) <= 0.1 * len(bad)


def test_rules_spare_languages_of_few_documents(spark):
    folder = "/root/testdata/sf0.001"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = [r for r in quality.query(spark, folder).collect() if not r.base_failed and langs[r.doc_id] in ("es", "fr")]
    assert all(sum(langs[r.doc_id] == x for r in out) < quality.LEAST_DOCUMENTS for x in ("es", "fr"))
    assert all(r.kept for r in out if labels.get(r.doc_id) == 1)
    assert sum(r.kept for r in out) == 31 and len(out) == 35


@pytest.mark.parametrize("few", [1, 2, 7, 19])
def test_rules_with_a_language_of_few_documents(spark, few):
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").select("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    passed = quality.judge(docs.join(labels, "doc_id", "left_semi"), {}).filter("kept").select(*docs.columns)
    small = passed.filter("lang = 'es'").orderBy("doc_id").limit(few)
    other = passed.filter("lang = 'fr'").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang").limit(3)
    some = docs.filter("lang IN ('en', 'de')").unionByName(small).unionByName(other).localCheckpoint()
    references = quality.language_references(some)
    assert set(references) == {"en", "de", "es"} and references["es"].documents == few
    judged = quality.judge(some, references, lang="lang").filter("lang = 'es' OR lang IS NULL").collect()
    assert len(judged) == few + 3 and all(r.kept for r in judged)
    absent = quality.judge(small, {k: r for k, r in references.items() if k != "es"}, lang="lang").collect()
    assert len(absent) == few and all(r.kept for r in absent)


def test_word_histograms_count_all_words(spark):
    words = [f"{a}{b}" for a in "abcdefghij" for b in range(1200)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    total = Counter()
    for t in texts:
        for w, n in Counter(t.split()).items():
            total[w.encode()] += n * quality.UNIT // 100
    want = sorted(total.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON_WORDS]
    for partitions in (1, 3):
        r = quality.language_references(docs.coalesce(1) if partitions == 1 else docs.repartition(partitions))["en"]
        assert list(r.words) == [w for w, _ in want] and list(r.shares[:-1]) == [v for _, v in want]
        assert r.shares.sum() == len(texts) * quality.UNIT


def test_rules_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert quality.language_references(empty) == {} and quality.judge(empty, {}).collect() == []


def test_classifier_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    out = [r for r in classifier.query(spark, "/root/testdata/sf0.1").collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_classifier_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "x", "x")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (7, None, 0), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    weights = classifier.train(docs.select("doc_id", "text"), labels)
    assert len(classifier.classify(docs, weights).collect()) == len(TEXTS) + 1
    nothing = classifier.train(docs.select("doc_id", "text"), labels.limit(0))
    assert {r.score for r in classifier.classify(docs, nothing).collect()} == {0.5}
    assert classifier.classify(docs.limit(0), weights).collect() == []


def test_classifier_takes_a_repeated_id_once(spark):
    once = spark.createDataFrame([(i, f"word{i % 7} good{i % 2} text") for i in range(30)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    again = once.unionByName(once.filter("doc_id = 3").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("n"))
    assert again.count() == 230
    assert np.array_equal(classifier.train(again, labels), classifier.train(once, labels))


def test_ftrl_equals_the_textbook_step():
    model = classifier.Ftrl.empty()
    slots, values = np.array([5, 9]), np.array([1.0, 0.5])
    model.update(slots, values, 1)
    g = (0.5 - 1) * values
    assert np.allclose(model.z[slots], g) and np.allclose(model.n[slots], g**2)
    want = -(g + classifier.L1) / ((classifier.BETA + np.abs(g)) / classifier.ALPHA + classifier.L2)
    assert np.allclose(model.weights(slots), want)


def test_languages_of_held_out_rows(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = langid.query(spark, SF).collect()
    assert len(out) == len(docs)
    held = [r for r in out if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.99


@pytest.fixture(scope="module")
def backoff():
    return langid.Backoff({"en": {"the": 9, "thing": 3, "house": 2}, "de": {"der": 9, "haus": 3, "schön": 2}})


@pytest.mark.parametrize(("text", "language"), [("the the", "en"), ("DER", "de"), ("thehouse", "en"), ("schönhaus", "de"), ("12 34 !", "und"), ("", "und"), (None, "und"), ("中文", "de")])
def test_backoff(backoff, text, language):
    found, score = backoff.predict(text)
    assert found == language and 0 <= score <= 1


def test_known_words_come_first_then_the_longest_known_grams(backoff):
    assert backoff.score("thing").tolist() == backoff.tables[0]["thing"].tolist()
    assert np.allclose(backoff.score("thingq"), np.mean([backoff.tables[5]["^thin"], backoff.tables[5]["thing"]], axis=0))
    assert np.allclose(backoff.score("zzoz"), backoff.tables[1]["o"] / 3 + (backoff.tables[1]["^"] + backoff.tables[1]["$"]) / 3)


def test_languages_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, score string")
    model = langid.train(empty)
    assert langid.identify(empty, model).collect() == [] and model.predict("words") == ("und", 0.0)
    odd = spark.createDataFrame([(1, "x", None, "s"), (None, "der mann", "de", "s"), (3, None, "de", "s"), (4, "the man", "en", "s")], empty.schema)
    assert len(langid.identify(odd, langid.train(odd)).collect()) == 4


@pytest.mark.parametrize("text", ["²", "½ ² Ⅷ", "12 34", "_ -", "", None, "①②"])
def test_numerals_are_no_letters(backoff, text):
    assert backoff.predict(text) == ("und", 0.0)


def test_a_repeated_id_is_one_row_of_the_model(spark):
    rows = [(i, "the house of words number " + "abcdefgh"[i % 8] * 3, "en") for i in range(20)] + [(i, "das haus der wörter", "de") for i in range(20, 40)]
    once = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    often = once.union(once.filter("doc_id = 3")).union(once.filter("doc_id = 3"))
    a, b = langid.train(once), langid.train(often)
    assert a.places == b.places and all((x == y).all() for x, y in zip(a.rows, b.rows, strict=True))


def test_clashing_names_in_the_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.withColumnRenamed("source", "__node").withColumns({"lang_pred": F.lit(7), "kept": F.lit("x"), "spans": F.lit(1), "c1": F.lit(2)})
    for _, step in corpus_pipeline.STAGES[:4]:
        out = step(spark, odd, SF)
        assert out.columns == odd.columns and out.count() > 0
