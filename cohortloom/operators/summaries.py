"""Cohort summaries, latest rows and ordered picks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import ratio, real_or_null, round_decimal


def class_balance(df: DataFrame, label: str, digits: int = 2, rounding=round_decimal) -> DataFrame:
    """(label, row_count, percentage), ordered by label.

    The total is a scalar subquery over the grouped counts, so both share one
    scan and one shuffle and no second pass over the rows is needed.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    share = F.col("row_count").cast("double") * F.lit(100.0) / total
    return counts.select(label, "row_count", rounding(share, digits).alias("percentage")).orderBy(label)


def cohort_profile(
    df: DataFrame, cohorts: Mapping[str, Column], label: Column, means: Mapping[str, Column]
) -> DataFrame:
    """One row: total, rows per cohort, label sum and rate, means."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(test).alias(f"{name}_rows") for name, test in cohorts.items()],
        F.sum(label.cast("long")).alias("positives"),
        F.count_if(label == 0).alias("negatives"),
        F.avg(label.cast("double")).alias("positive_rate"),
        *[F.avg(value).alias(f"avg_{name}") for name, value in means.items()],
    )


def version_summary(
    df: DataFrame,
    version: str,
    correct: Column,
    means: Mapping[str, Column],
    mean_digits: int = 1,
    rounding=round_decimal,
) -> DataFrame:
    """Rows, accuracy in percent and feature means per data version, ordered."""
    accuracy = F.avg(correct.cast("double")) * 100
    return (
        df.groupBy(version)
        .agg(
            F.count(F.lit(1)).alias("total"),
            rounding(accuracy, 2).alias("accuracy_pct"),
            *[rounding(F.avg(v.cast("double")), mean_digits).alias(n) for n, v in means.items()],
        )
        .orderBy(version)
    )


def score_summary(
    df: DataFrame, prediction: str = "prediction", correct: str = "is_correct", confidence: str = "confidence"
) -> DataFrame:
    """One row for a scored batch: counts, accuracy, mean confidence."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(prediction) == 1).alias("positives"),
        F.count_if(F.col(prediction) == 0).alias("negatives"),
        F.count_if(F.col(correct)).alias("correct"),
        ratio(F.count_if(F.col(correct)), F.count(F.lit(1))).alias("accuracy"),
        F.avg(confidence).alias("avg_confidence"),
    )


def mean_shift(df: DataFrame, features: Sequence[str], is_reference: Column) -> DataFrame:
    """(feature, ref_mean, cur_mean, difference, direction).

    Conditional means in one global aggregate; only its single row is turned
    into one row per feature. No change counts as down.
    """
    means = df.agg(
        *[F.avg(F.when(is_reference, real_or_null(c))).alias(f"r{i}") for i, c in enumerate(features)],
        *[F.avg(F.when(~is_reference, real_or_null(c))).alias(f"c{i}") for i, c in enumerate(features)],
    )
    rows = means.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("feature"),
                        F.col(f"r{i}").alias("ref_mean"),
                        F.col(f"c{i}").alias("cur_mean"),
                    )
                    for i, name in enumerate(features)
                ]
            )
        )
    )
    gap = F.col("cur_mean") - F.col("ref_mean")
    return rows.select(
        "feature",
        "ref_mean",
        "cur_mean",
        gap.alias("difference"),
        F.when(gap > 0, "up").when(gap.isNotNull(), "down").alias("direction"),
    )


def label_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, row_count, positive_rate): counts per label and the overall rate of 1."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
    rate = counts.agg(
        F.try_divide(
            F.sum(F.when(F.col(label) == 1, F.col("row_count")).otherwise(0)).cast("double"),
            F.sum(F.when(F.col(label).isNotNull(), F.col("row_count"))).cast("double"),
        )
    ).scalar()
    return counts.select(label, "row_count", rate.alias("positive_rate"))


def accuracy_drop(df: DataFrame, correct: Column, baseline: float, limit: float) -> DataFrame:
    """One row: accuracy, its drop below the baseline in points, and the alert."""
    accuracy = df.agg(F.avg(correct.cast("double")).alias("accuracy"))
    drop = F.lit(float(baseline)) - F.col("accuracy")
    return accuracy.select(
        "accuracy",
        F.lit(float(baseline)).alias("baseline"),
        (drop * 100).alias("drop_points"),
        (drop > F.lit(float(limit))).alias("alert"),
    )


def latest_row(df: DataFrame, at: str, tie_break: str) -> DataFrame:
    """The newest row; equal times are settled by the larger tie-break."""
    return df.orderBy(F.col(at).desc(), F.col(tie_break).desc()).limit(1)


def latest_row_per_group(df: DataFrame, group: str, at: str, tie_break: str) -> DataFrame:
    """The newest row of each group, as an aggregate that combines before the shuffle."""
    rest = [name for name in df.columns if name != group]
    picked = df.groupBy(group).agg(
        F.max_by(F.struct(*rest), F.struct(at, tie_break)).alias("__row")
    )
    return picked.select(
        *[F.col(n) if n == group else F.col(f"__row.{n}").alias(n) for n in df.columns]
    )


def top_rows(df: DataFrame, by: str, tie_break: str, k: int) -> DataFrame:
    """The k rows with the largest value, ties in name order."""
    return df.orderBy(F.col(by).desc(), F.col(tie_break).asc()).limit(k)


def preview(df: DataFrame, order: Sequence[str], rows: int = 3) -> DataFrame:
    """The first rows in a stated order, so that every run shows the same ones."""
    return df.orderBy(*order).limit(rows)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one job."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
