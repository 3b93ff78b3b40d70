"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The features of a text are the distinct hashed character n-grams of its words. Each is scaled by the
logarithm of how much more often it stands in texts of class 1 than of class 0, and a sparse
logistic regression is fitted on the scaled features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import LOWER, SPACE, mixed, own, utf8

#: Most labels that are broadcast to pick the labelled texts.
BROADCAST_LABELS = 2_000_000
#: Partitions of the training sample.
TRAINING_PARTITIONS = 8
_MULTIPLIER = np.uint64(0x100000001B3)


def gram_features(data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: rows and hashed features of all n-grams of lower-case bytes inside a word, with its borders.

    White space counts as the border of a word; n-grams start at a border or inside and never span one in the middle.
    """
    framed = np.full(len(data) + len(offsets), 0x20, np.uint8)  # a blank before every row and after the last
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    framed[np.arange(len(data)) + rows + 1] = LOWER[data]
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    blank = SPACE[framed]
    framed[blank] = 0x20
    codes = mixed(framed.astype(np.uint64) + np.uint64(1))
    for n in sizes:
        count = len(framed) - n + 1
        if count <= 0:
            continue
        value = np.zeros(count, np.uint64)
        inner = np.zeros(count, bool)
        for i in range(n):
            value = value * _MULTIPLIER + codes[i : i + count]
            if 0 < i < n - 1:
                inner |= blank[i : i + count]
        at = np.flatnonzero(~inner)
        at = at[at < len(row_of)]
        yield row_of[at], (mixed(value[at] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of each hashed n-gram, the ratio included, and the intercept."""

    sizes: tuple[int, ...]
    bits: int
    weights: np.ndarray
    intercept: float


def _vectors(docs: DataFrame, sizes: tuple[int, ...], bits: int) -> DataFrame:
    """``label`` and the sorted distinct features of each text, read whole."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                data, offsets = utf8(part["text"])
                pairs = [rows.astype(np.int64) << bits | found for rows, found in gram_features(data, offsets, sizes, bits)]
                pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
                ends = np.searchsorted(pairs >> bits, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((pairs & ((1 << bits) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part["label"], lists], ["label", "features"])

    return docs.select("text", F.col("label").cast("double").alias("label")).mapInArrow(features, "label double, features array<int>")


def _gram_counts(rows: DataFrame, sizes: tuple[int, ...], bits: int) -> DataFrame:
    """``feature, n0, n1``: the texts of each class that have an n-gram; a task adds up its texts before anything moves."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                data, offsets = utf8(part["text"])
                pairs = [rows.astype(np.int64) << bits | found for rows, found in gram_features(data, offsets, sizes, bits)]
                pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
                label = part["label"].to_numpy()[pairs >> bits].astype(np.int64)
                seen += np.bincount(label << bits | (pairs & ((1 << bits) - 1)), minlength=2 << bits).reshape(2, -1)
        feature = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(feature.astype(np.int32)), *(pa.array(n[feature]) for n in seen)], ["feature", "n0", "n1"])

    counted = rows.select("text", F.col("label").cast("long").alias("label")).mapInArrow(counts, "feature int, n0 long, n1 long")
    return counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic",
    sizes: tuple[int, ...] = (3, 4, 5), bits: int = 18, most_rows: int = 8_000, penalty: float = 0.0005, rounds: int = 80,
) -> ToxicityModel:
    """Fit on labelled texts: 0 or 1 in ``label``; others, null ids and repeated labels of an id count once or not at all.

    The log-count ratios come from all labelled texts. The regression is fitted on a bounded sample of about
    ``most_rows`` labelled rows, half of them of each class where there are enough, chosen by a hash of the id.
    Labels meet the documents in the scan up to ``BROADCAST_LABELS`` of them, and in a shuffle beyond.
    With one class only, the model gives that class's share everywhere.
    """
    spark = docs.sparkSession
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    marked = marked.groupBy("id").agg(F.max("label").alias("label"))
    count = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(count) < 2:
        return ToxicityModel(sizes, bits, np.zeros(1 << bits), 20.0 if 1 in count else -20.0)
    rate = F.when(F.col("label") == 1, min(1.0, most_rows / 2 / count[1])).otherwise(min(1.0, most_rows / 2 / count[0]))
    chosen = marked.where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1_000_000)) < rate * 1_000_000)
    # bounded by most_rows, whatever the input
    few = spark.createDataFrame(chosen.toArrow(), marked.schema)
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    every = F.broadcast(marked) if sum(count.values()) <= BROADCAST_LABELS else marked
    # at most a row a feature, whatever the input
    present = _gram_counts(known.join(every, "id"), sizes, bits).toArrow()
    seen = np.ones((2, 1 << bits))  # add-one smoothing
    seen[:, present["feature"].to_numpy()] += np.stack([present["n0"].to_numpy(), present["n1"].to_numpy()])
    del present
    vectors = _vectors(known.join(F.broadcast(few), "id"), sizes, bits).persist()
    try:
        found = vectors.groupBy("label").count().collect()
        if len(found) < 2:
            return ToxicityModel(sizes, bits, np.zeros(1 << bits), 20.0 if found and found[0]["label"] == 1 else -20.0)
        ratio = np.log(seen[1] / seen[1].sum()) - np.log(seen[0] / seen[0].sum())
        # what no text of the sample has keeps the weight 0, so it needs no place in the gradients
        used = np.sort(vectors.select(F.explode("features").alias("feature")).distinct().toArrow()["feature"].to_numpy())
        place = np.zeros(1 << bits, np.int32)
        place[used] = np.arange(len(used), dtype=np.int32)
        size, shared = max(1, len(used)), spark.sparkContext.broadcast((place, ratio))

        @F.udf(VectorUDT())
        def scaled(features: list[int]) -> SparseVector:
            place, ratio = shared.value
            return Vectors.sparse(size, place[features], ratio[features])

        weight = F.when(F.col("label") == 1, 1.0 / max(1, [r["count"] for r in found if r["label"] == 1][0])).otherwise(1.0 / max(1, [r["count"] for r in found if r["label"] == 0][0]))
        training = vectors.select("label", scaled("features").alias("features"), (weight * sum(r["count"] for r in found) / 2).alias("weight"))
        training = training.coalesce(TRAINING_PARTITIONS)  # the rows are a bounded sample, and each partition returns a whole gradient
        learner = LogisticRegression(maxIter=rounds, regParam=penalty, elasticNetParam=1.0, standardization=False, weightCol="weight", aggregationDepth=2)
        fitted = learner.fit(training)
    finally:
        vectors.unpersist()
    weights = np.zeros(1 << bits)
    weights[used] = fitted.coefficients.toArray()[: len(used)] * ratio[used]
    return ToxicityModel(sizes, bits, weights, float(fitted.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, with ``score`` in [0, 1].

    A null text counts as the empty one, which scores what the intercept says. Texts are read whole;
    an n-gram counts once however often it stands in a text. Rows are not moved.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key, plain = own("row"), own("text")
    given = docs.select(F.struct("*").alias(key), F.col(text).alias(plain))
    row = given.schema.simpleString()[len(f"struct<{key}:") :].rsplit(f",{plain}:", 1)[0]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        some, bits = known.weights != 0, known.bits
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                data, offsets = utf8(batch[plain])
                hits = []
                for rows, found in gram_features(data, offsets, known.sizes, bits):
                    use = some[found]
                    hits.append(rows[use].astype(np.int64) << bits | found[use])
                pairs = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
                total = known.intercept + np.bincount(pairs >> bits, known.weights[pairs & ((1 << bits) - 1)], minlength=batch.num_rows)
                yield pa.RecordBatch.from_arrays([batch[key], pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], ["row", "score"])

    return given.mapInArrow(score, f"row {row}, score double")
