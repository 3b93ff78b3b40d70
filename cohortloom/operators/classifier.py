"""Distributed training of a boosted-tree classifier, and batch scoring."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.numeric import real_or_null, round_decimal
from cohortloom.session import ensure_checkpoint_dir


# Stands for a missing feature inside the trees, which take no NULL or NaN: the lowest
# double there is, so that a split can part the missing rows from the others.
MISSING_VALUE = -sys.float_info.max


def _inputs(features: Sequence[str]) -> list[Column]:
    return [F.coalesce(real_or_null(c), F.lit(MISSING_VALUE)).alias(c) for c in features]


@dataclass(frozen=True)
class BoostingSettings:
    """Settings of the boosted trees.

    ``row_share`` is drawn per tree and ``feature_share`` per node. Splits need
    ``min_rows`` rows on each side and at least ``min_gain``.
    """

    trees: int = 300
    depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_rows: int = 5
    min_gain: float = 0.0
    seed: int = 42


def training_set(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    split: str | None = None,
    split_value: str = "train",
) -> DataFrame:
    """Features, label and weight of one split, as doubles; other columns are pruned."""
    rows = df if split is None else df.where(F.col(split) == split_value)
    return rows.select(
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label).cast("double").alias(label),
        *([F.col(weight).cast("double").alias(weight)] if weight else []),
    ).where(F.col(label).isNotNull())


def bounded_rows(rows: DataFrame, key: Sequence[str], most_rows: int) -> DataFrame:
    """About ``most_rows`` rows at most, chosen by a hash of the key: the bound of a training sample.

    Training passes over its rows for every level of every tree; this sets what that costs.
    """
    total = rows.count()
    if total <= most_rows:
        return rows
    place = F.pmod(F.xxhash64(*[F.col(name) for name in key]), F.lit(1_000_000))
    return rows.where(place < F.lit(int(1_000_000 * most_rows / total)))


def train_boosted_trees(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    settings: BoostingSettings = BoostingSettings(),
    partitions: int | None = None,
) -> PipelineModel:
    """Fit on the executors; long runs cut their lineage in the shared folder.

    The assembled rows are kept in memory and on disk while fitting,
    because training first passes over them several times; a lost executor's
    part is computed again. ``partitions`` deals the rows out evenly first. Row
    sampling is seeded per partition, so the same number of partitions is part
    of a repeatable fit.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    trees = GBTClassifier(
        featuresCol="features",
        labelCol=label,
        maxIter=settings.trees,
        maxDepth=settings.depth,
        stepSize=settings.learning_rate,
        subsamplingRate=settings.row_share,
        featureSubsetStrategy=str(settings.feature_share),
        minInstancesPerNode=settings.min_rows,
        minInfoGain=settings.min_gain,
        seed=settings.seed,
        checkpointInterval=10,
    )
    if weight:
        trees = trees.setWeightCol(weight)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    rows = rows.select(*_inputs(features), label, *([weight] if weight else []))
    spread = rows.repartition(partitions) if partitions else rows
    inputs = assembler.transform(spread).select("features", label, *([weight] if weight else []))
    inputs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel([assembler, trees.fit(inputs)])
    finally:
        inputs.unpersist()


def save_model(model: PipelineModel, path: str) -> str:
    """Write a fitted model to shared storage, for another job to score with; returns the path."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """The model that ``save_model`` wrote, for instance where an alias resolves to."""
    return PipelineModel.load(path)


def training_curve(
    model: PipelineModel, df: DataFrame, features: Sequence[str], label: str
) -> DataFrame:
    """(tree_count, loss): logistic loss on the given rows after each tree.

    Rows without the weight column the trees were fitted with weigh the same.
    """
    assembler, trees = model.stages
    columns = [*_inputs(features), F.col(label).cast("double").alias(label)]
    if trees.isSet(trees.weightCol):
        weight = trees.getWeightCol()
        given = F.col(weight) if weight in df.columns else F.lit(1.0)
        columns.append(given.cast("double").alias(weight))
    rows = df.select(*columns).where(F.col(label).isNotNull())
    losses = trees.evaluateEachIteration(assembler.transform(rows))
    curve = [(i + 1, float(loss)) for i, loss in enumerate(losses)]
    return df.sparkSession.createDataFrame(curve, "tree_count int, loss double")


def feature_importance(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance): one row per model input."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(features, weights)]
    return spark.createDataFrame(rows, "feature string, importance double")


def scored_columns(
    probability: Column,
    label: Column | None,
    names: tuple[str, str] = ("negative", "positive"),
    digits: int = 4,
    prediction: Column | None = None,
    rounding=round_decimal,
    raw: str | None = None,
) -> list[Column]:
    """Class, probability, text label, confidence, and correctness where a label is known.

    ``raw`` names a further column for the unrounded probability, which exact
    metrics need.
    """
    chosen = (probability > 0.5).cast("int") if prediction is None else prediction.cast("int")
    confidence = F.when(probability >= 0.5, probability).otherwise(1 - probability)
    columns = [
        chosen.alias("prediction"),
        rounding(probability, digits).alias("prediction_prob"),
        F.when(chosen == 1, names[1]).when(chosen == 0, names[0]).alias("prediction_label"),
        rounding(confidence, digits).alias("confidence"),
    ]
    if raw is not None:
        columns.append(probability.alias(raw))
    if label is not None:
        columns += [label.cast("int").alias("actual_label"), (chosen == label.cast("int")).alias("is_correct")]
    return columns


def score_with(
    df: DataFrame,
    probability: Column,
    label: str | None,
    passthrough: Sequence[str] = (),
    metadata: Sequence[Column] = (),
    **options,
) -> DataFrame:
    """Batch scoring by an expression: predictions, passed-through columns, metadata."""
    actual = F.col(label) if label else None
    return df.select(*passthrough, *scored_columns(probability, actual, **options), *metadata)


def score_model(
    model: PipelineModel,
    df: DataFrame,
    features: Sequence[str],
    label: str | None,
    passthrough: Sequence[str] = (),
    metadata: Sequence[Column] = (),
    **options,
) -> DataFrame:
    """Batch scoring by a fitted model, on the executors."""
    kept = list(dict.fromkeys([*passthrough, *([label] if label else [])]))
    inputs = df.select(
        *[F.col(c).alias(f"__kept_{c}") for c in kept],
        *_inputs(features),
    )
    scored = model.transform(inputs).select(
        *[F.col(f"__kept_{c}").alias(c) for c in kept],
        vector_to_array("probability")[1].alias("__probability"),
        F.col("prediction").alias("__prediction"),
    )
    return score_with(
        scored,
        F.col("__probability"),
        label,
        passthrough,
        metadata,
        prediction=F.col("__prediction"),
        **options,
    )
