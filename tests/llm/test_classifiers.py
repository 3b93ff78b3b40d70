"""Language and toxicity: the recursions against sums over all cases, and held-out accuracy."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm.language import WORD_START, Pieces, expected_counts, fit_languages, predict_language, read_vocabulary, word_scores
from cohortloom.llm.queries_classify import VOCABULARY, op5_language, op10_toxicity
from cohortloom.llm.toxicity import fit_toxicity, score_toxicity
from cases import FOLDER, no_docs, odd_docs

PIECES = [WORD_START, "a", "b", "ab", "ba", WORD_START + "a", "aba", "c"]


def segmentations(word: str):
    text = WORD_START + word
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        out, now = [], text[0]
        for c, cut in zip(text[1:], cuts, strict=True):
            if cut:
                out.append(now)
                now = c
            else:
                now += c
        yield [*out, now]


def test_forward_sums_all_segmentations():
    p = np.random.default_rng(1).random((2, len(PIECES) + 1))
    words = ["a", "ab", "abab", "baab", "cab", "x", "aéb"]
    found = word_scores(words, Pieces(PIECES), p)
    for w, row in zip(words, found, strict=True):
        for language in range(2):
            total = 0.0
            for parts in segmentations(w):
                if all(x in PIECES or len(x) == 1 for x in parts):
                    total += math.prod(p[language][PIECES.index(x) if x in PIECES else -1] for x in parts)
            assert row[language] == pytest.approx(math.log(total))


def test_expected_counts_are_posterior_means():
    p = np.random.default_rng(2).random(len(PIECES) + 1)
    got = expected_counts(["abab", "x"], np.array([2.0, 1.0]), Pieces(PIECES), p)
    want = np.zeros(len(PIECES) + 1)
    for word, weight in (("abab", 2.0), ("x", 1.0)):
        ways = [[PIECES.index(x) if x in PIECES else len(PIECES) for x in s] for s in segmentations(word) if all(x in PIECES or len(x) == 1 for x in s)]
        mass = [math.prod(p[i] for i in way) for way in ways]
        for way, m in zip(ways, mass, strict=True):
            for i in way:
                want[i] += weight * m / sum(mass)
    assert got == pytest.approx(want)


def test_a_long_word_does_not_underflow():
    found = word_scores(["ab" * 3000], Pieces(PIECES), np.full((1, len(PIECES) + 1), 1e-3))
    assert np.isfinite(found).all() and found[0, 0] < -10_000


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = op5_language(spark, FOLDER).join(docs, "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()
    assert found.where("score < 0 OR score > 1").isEmpty()


def test_odd_rows_and_unlabelled_corpora(spark):
    docs = odd_docs(spark)
    vocabulary = read_vocabulary(VOCABULARY)
    found = predict_language(docs, fit_languages(docs, vocabulary))
    rows = found.select("row.text", "lang_pred", found["score"].alias("s")).collect()
    assert len(rows) == docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    empty = fit_languages(no_docs(spark), vocabulary)
    assert {r.lang_pred for r in predict_language(docs, empty).collect()} == {"und"}
    assert predict_language(no_docs(spark), empty).count() == 0


def test_languages_are_fitted_on_every_labelled_row(spark):
    docs = spark.range(30_001).select(
        F.when(F.col("id") == 17, "c aba").when(F.col("id") == 18, F.lit(None)).otherwise("a A ab").alias("text"), F.when(F.col("id") != 19, "xx").alias("lang")
    )
    found = fit_languages(docs, PIECES, rounds=1, smoothing=0.0)
    weights = {"a": 2 * 29_998.0, "ab": 29_998.0, "c": 1.0, "aba": 1.0}
    counts = expected_counts(list(weights), np.array(list(weights.values())), Pieces(PIECES), np.full(len(PIECES) + 1, 1 / (len(PIECES) + 1)))
    assert found.languages == ["xx"] and found.probability[0] == pytest.approx(counts / counts.sum())


def test_held_out_toxicity(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = op10_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    mean = {r["toxic"]: r["m"] for r in found.where("held_out").groupBy("toxic").agg(F.avg("score").alias("m")).collect()}
    assert mean[1] > mean[0] + 0.2
    assert found.where("NOT held_out AND toxic <> predicted").count() <= 0.05 * found.where("NOT held_out").count()


def test_toxicity_of_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(0, 1), (5, 1), (7, 0), (7, 0), (8, 0), (9, None), (None, 1), (10, 0), (12, 1)], "doc_id long, toxic int")
    scored = score_toxicity(docs, fit_toxicity(docs, labels)).select("row.text", F.col("score").alias("s")).collect()
    assert len(scored) == docs.count() and all(0 <= r.s <= 1 for r in scored)
    assert len({r.s for r in scored if not (r.text or "").strip()}) == 1
    one_class = fit_toxicity(docs, labels.where("toxic = 0"))
    assert all(r["score"] < 0.01 for r in score_toxicity(docs, one_class).select("score").collect())
    assert score_toxicity(no_docs(spark), one_class).count() == 0
    assert not fit_toxicity(no_docs(spark), labels).weights.any()


def test_ratios_come_from_all_labelled_texts(spark):
    """Counts of n-grams by class against plain Python, and a sample bound that leaves them as they are."""
    from cohortloom.llm.text import utf8
    from cohortloom.llm.toxicity import _gram_counts, gram_features

    texts = [("you fool", 1), ("kind words", 0), ("You  FOOL", 1), ("a", 0), ("", 1), ("words words", 0)] * 3
    rows = spark.createDataFrame([(t, y) for t, y in texts], "text string, label int").repartition(3)
    found = {(y, r.feature): n for r in _gram_counts(rows, (3, 4), 16).collect() for y, n in ((0, r.n0), (1, r.n1)) if n}
    want = {}
    for t, y in texts:
        data, offsets = utf8(pa.array([t]))
        for f in {int(x) for _, g in gram_features(data, offsets, (3, 4), 16) for x in g}:
            want[y, f] = want.get((y, f), 0) + 1
    assert found == want


def test_languages_beyond_the_first_block_of_a_batch(spark):
    texts = {"en": "the quick brown fox", "de": "der schnelle braune Fuchs", None: "123 !", "": None}
    kinds = list(texts)
    docs = spark.createDataFrame([(i, texts[kinds[i % 4]], kinds[i % 4]) for i in range(3000)], "doc_id long, text string, lang string").coalesce(1)
    model = fit_languages(docs.where("lang IN ('en', 'de')"), read_vocabulary(VOCABULARY))
    found = {r["doc_id"]: r["lang_pred"] for r in predict_language(docs, model).select("row.doc_id", "lang_pred").collect()}
    assert found == {i: kinds[i % 4] if i % 4 < 2 else "und" for i in range(3000)}
