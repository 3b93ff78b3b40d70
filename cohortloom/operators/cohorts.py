"""Stored profiles of a cohort, so that a drift run reads the current cohort only.

A profile has one row per (feature, value) with the number of rows that have it, and the value range
the value falls in. It is as exact as the cohort: every distance taken from it equals the one taken from
the rows. Profiles of parts of a cohort merge into the profile of the whole. A feature
with few values costs a row for each; ``digits`` keeps the profile of a continuous feature small, at an
error of at most half a unit of the last digit in each value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite_or_null, round_floor
from cohortloom.operators.drift import Monitor, drift_scores
from cohortloom.operators.ordered import column_summary, range_count

PROFILE = ["feature", "low", "high", "value", "category", "n"]


def _limits_of(features: Sequence[str], splits: Mapping[str, Sequence[float]]) -> Column:
    """The range limits of the feature in a row, from minus to plus infinity."""
    limits = [[float("-inf"), *splits.get(c, []), float("inf")] for c in features]
    cases = F.lit(None).cast("array<double>")
    for name, values in zip(features, limits):
        cases = F.when(F.col("feature") == name, F.array(*[F.lit(x) for x in values])).otherwise(cases)
    return cases


def _ranged(values: DataFrame, features: Sequence[str], splits: Mapping[str, Sequence[float]]) -> DataFrame:
    """Numeric rows with the limits of the range that their value falls in; the upper one is outside."""
    limits = _limits_of(features, splits)
    above = F.size(F.filter(limits, lambda x: x <= F.col("value")))
    return values.select(
        "feature",
        F.when(F.col("value").isNotNull(), F.element_at(limits, above)).alias("low"),
        F.when(F.col("value").isNotNull(), F.element_at(limits, above + 1)).alias("high"),
        "value", "category", "n",
    )


def _counts(df: DataFrame, columns: Mapping[str, Column], name: str) -> DataFrame:
    """(feature, ``name``, n): the rows of every value of the columns."""
    # short names while the rows are counted
    places = {f"{i}": c for i, c in enumerate(columns)}
    long = df.select(*[columns[c].alias(i) for i, c in places.items()]).unpivot([], list(places), "place", name)
    counted = long.where(F.col(name).isNotNull()).groupBy("place", name).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("place").cast("int") + 1).alias("feature"), name, "n")


def profile_cohort(
    df: DataFrame,
    numbers: Sequence[str],
    texts: Sequence[str] = (),
    ranges: int | None = None,
    splits: Mapping[str, Sequence[float]] | None = None,
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """(feature, low, high, value, category, n) of the named columns; NULL, NaN and infinite numbers and NULL texts are left out.

    ``splits`` are range limits known from another profile (:func:`profile_splits`).
    """
    if splits is None:
        found = column_summary(df, numbers, ranges=range_count(df, ranges)) if numbers else {}
        splits = {c: found[c].splits for c in numbers}
    digits = digits or {}
    value = {c: round_floor(finite_or_null(c), digits[c]) if c in digits else finite_or_null(c) for c in numbers}
    parts = []
    if numbers:
        parts.append(_counts(df, value, "value").select("feature", "value", F.lit(None).cast("string").alias("category"), "n"))
    if texts:
        parts.append(_counts(df, {c: F.col(c).cast("string") for c in texts}, "category").select("feature", F.lit(None).cast("double").alias("value"), "category", "n"))
    counts = reduce(DataFrame.unionByName, parts)
    return _ranged(counts, list(numbers), splits)


def profile_splits(profile: DataFrame) -> dict[str, list[float]]:
    """The range limits of a profile's features: at most features x ranges numbers."""
    rows = profile.where(F.col("value").isNotNull()).groupBy("feature").agg(F.array_union(F.collect_set("low"), F.collect_set("high")).alias("limits"))
    return {r.feature: sorted(x for x in r.limits if abs(x) != float("inf")) for r in rows.collect()}


def merge_profiles(*profiles: DataFrame, splits: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """The profile of all their rows together, in the ranges of the first one or as given.

    Counts of equal values add up, so the order and grouping of merges do not matter.
    """
    splits = profile_splits(profiles[0]) if splits is None else splits
    every = reduce(DataFrame.unionByName, [p.select(*PROFILE) for p in profiles])
    counts = every.groupBy("feature", "value", "category").agg(F.sum("n").alias("n"))
    return _ranged(counts, list(splits), splits)


def _both_cohorts(profile: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """The profile's rows, one feature each, below the current rows; ``n`` says how many rows a row stands for."""
    texts = {c for c, kind in current.dtypes if kind in ("string", "boolean") or kind.startswith(("varchar", "char"))}
    kinds = {c: "string" if c in texts else "double" for c in features}
    here = profile.where(F.col("feature").isin(list(features)))
    reference = here.select(
        *[F.when(F.col("feature") == c, F.col("category") if c in texts else F.col("value")).cast(kinds[c]).alias(c) for c in features],
        F.col("n").alias("__n"), F.lit(True).alias("__is_reference"),
    )
    rows = current.select(*[F.col(c).cast(kinds[c]).alias(c) for c in features], F.lit(1).cast("long").alias("__n"), F.lit(False).alias("__is_reference"))
    return reference.unionByName(rows)


def drift_from_profile(
    profile: DataFrame,
    current: DataFrame,
    monitors: Sequence[Monitor],
    *,
    bins: int = 10,
    floor: float = 1e-4,
    splits: Mapping[str, Sequence[float]] | None = None,
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """(feature, statistic, drift_score, drift_detected), as ``drift_scores`` gives of the rows themselves.

    The current cohort is scanned; of the reference only its profile is read. ``splits``
    are the profile's limits where they are at hand. A feature that the profile lacks has no score. ``digits`` are those
    that the profile was made with: the current values are rounded alike.
    """
    features = list(dict.fromkeys(m.feature for m in monitors))
    for name, places in (digits or {}).items():
        current = current.withColumn(name, round_floor(finite_or_null(name), places))
    splits = profile_splits(profile) if splits is None else splits
    splits = {c: splits.get(c, []) for c in features}
    both = _both_cohorts(profile, current, features)
    return drift_scores(both, F.col("__is_reference"), monitors, bins=bins, floor=floor, splits=splits, count="__n")
