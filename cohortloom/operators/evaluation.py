"""Class weights and exact metrics of a binary classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite_or_null, ratio
from cohortloom.operators.ordered import column_summary, range_count, running_counts


def balanced_weight(
    df: DataFrame, label: str, classes: Sequence[int] = (0, 1), output: str = "sample_weight"
) -> DataFrame:
    """Rows with weight ``n / (k * n_c)``: every class present weighs the same in total.

    The class counts come from one aggregate used as a scalar subquery. A join
    on the label would shuffle the whole table onto as many keys as there are
    classes. Labels outside ``classes`` get NULL.
    """
    counts = df.agg(
        F.struct(*[F.count_if(F.col(label) == c).alias(f"c{i}") for i, c in enumerate(classes)])
    ).scalar()
    sizes = [counts.getField(f"c{i}").cast("double") for i in range(len(classes))]
    total = sum(sizes[1:], sizes[0])
    present = sum([(s > 0).cast("int") for s in sizes[1:]], (sizes[0] > 0).cast("int"))
    weight = F.lit(None).cast("double")
    for value, size in zip(classes, sizes):
        weight = F.when(F.col(label) == value, F.try_divide(total, present * size)).otherwise(weight)
    return df.withColumn(output, weight)


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    actual, predicted = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((actual == 0) & (predicted == 0)).alias("tn"),
        F.count_if((actual == 0) & (predicted == 1)).alias("fp"),
        F.count_if((actual == 1) & (predicted == 0)).alias("fn"),
        F.count_if((actual == 1) & (predicted == 1)).alias("tp"),
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def _metrics(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    samples = tn + fp + fn + tp
    return {
        "accuracy": _or_zero(tp + tn, samples),
        "precision": _or_zero(tp, tp + fp),
        "recall": _or_zero(tp, tp + fn),
        "f1_score": _or_zero(2 * tp, 2 * tp + fp + fn),
        "positive_rate": _or_zero(tp + fn, samples),
        "samples": samples,
    }


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1_score, positive_rate, samples.

    A metric whose denominator is zero is 0.
    """
    counts = confusion_matrix(df, label, prediction)
    metrics = _metrics(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return counts.select(*[value.alias(name) for name, value in metrics.items()])


#: Stands for a score in rows that have none, so that they are counted in the same pass.
UNSCORED = "__unscored"


def _ranked(
    df: DataFrame,
    label: str,
    score: str,
    extra: Mapping[str, Column],
    ranges: int | None,
    splits: Sequence[float] | None,
) -> DataFrame:
    """Running class counts by score, with further row counts alongside, those of rows without a score under ``UNSCORED``."""
    if splits is None:
        splits = column_summary(df, [score], ranges=range_count(df, ranges))[score].splits
    classes = {"pos": F.col(label) == 1, "neg": F.col(label) == 0}
    if not extra:
        return running_counts(df, [score], classes, {score: splits})
    rows = df.withColumn(UNSCORED, F.when(finite_or_null(score).isNull(), F.lit(0.0)))
    return running_counts(rows, [score, UNSCORED], {**classes, **extra}, {score: splits, UNSCORED: []})


def _area() -> Column:
    scored = F.col("feature") != UNSCORED
    pos, neg = (F.when(scored, F.col(c)).otherwise(0).cast("double") for c in ("pos", "neg"))
    below = F.col("neg_below").cast("double")
    pairs = F.sum(pos) * F.sum(neg)
    return F.try_divide(F.sum(pos * (below + neg / 2)), pairs)


def roc_auc(
    df: DataFrame,
    label: str,
    score: str,
    ranges: int | None = None,
    splits: Sequence[float] | None = None,
) -> DataFrame:
    """One row: exact area under the ROC curve, ties counted half.

    NULL when only one class is present. ``splits`` are range limits known from
    an earlier run; they save the pass that looks for them, and the area is the
    same for any increasing limits.
    """
    return _ranked(df, label, score, {}, ranges, splits).agg(_area().alias("roc_auc"))


def run_record(
    scored: DataFrame,
    label: str,
    prediction: str,
    score: str,
    constants: Mapping[str, str],
    created_at: Column,
    ranges: int | None = None,
    splits: Sequence[float] | None = None,
) -> DataFrame:
    """One run-log row: constants, every metric, status ``trained``, time.

    The confusion counts ride along with the ranking, so the metrics and the
    area come from the same pass. Rows without a score have no rank, but their
    predictions count like all others.
    """
    actual, predicted = F.col(label), F.col(prediction)
    cells = {
        "tn": (actual == 0) & (predicted == 0),
        "fp": (actual == 0) & (predicted == 1),
        "fn": (actual == 1) & (predicted == 0),
        "tp": (actual == 1) & (predicted == 1),
    }
    sums = _ranked(scored, label, score, cells, ranges, splits).agg(
        _area().alias("roc_auc"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cells]
    )
    metrics = _metrics(*[F.col(c) for c in cells])
    return sums.select(
        *[F.lit(value).alias(name) for name, value in constants.items()],
        *[metrics[m].alias(m) for m in ("precision", "recall", "f1_score")],
        "roc_auc",
        metrics["accuracy"].alias("accuracy"),
        F.lit("trained").alias("status"),
        F.lit(None).cast("string").alias("model_version"),
        created_at.alias("created_at"),
    )
