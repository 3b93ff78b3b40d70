"""Compare two data versions and report severity and action."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.cohorts import drift_from_profile
from cohortloom.functions.numeric import round_decimal
from cohortloom.operators.classifier import score_with
from cohortloom.operators.drift import Monitor, drift_log, drift_scores
from cohortloom.operators.shift import DiscreteShift, QuantileShift, Shift, shift_cohort
from cohortloom.plans.medallion import FeatureRules, gold_features
from cohortloom.sources.published import append_logged


def monitor_versions(
    df: DataFrame,
    version: str,
    reference: str,
    current: str,
    monitors: Sequence[Monitor],
    detected_at: Column,
    constants: Mapping[str, str],
    bins: int = 10,
    ranges: int | None = None,
) -> DataFrame:
    """Drift-log rows for two versions kept in one table.

    Only the two versions and the monitored columns are scanned.
    """
    names = list(dict.fromkeys(m.feature for m in monitors))
    rows = df.where(F.col(version).isin(reference, current)).select(version, *names)
    scores = drift_scores(rows, F.col(version) == reference, monitors, bins=bins, ranges=ranges)
    tags = {**constants, "reference_version": reference, "current_version": current}
    return drift_log(scores, detected_at, tags)


def monitor_against_profile(
    profile: DataFrame,
    df: DataFrame,
    version: str,
    current: str,
    monitors: Sequence[Monitor],
    detected_at: Column,
    constants: Mapping[str, str],
    reference: str,
    bins: int = 10,
) -> DataFrame:
    """The same log rows, the reference taken from its stored profile: only the current version is scanned."""
    names = list(dict.fromkeys(m.feature for m in monitors))
    rows = df.where(F.col(version) == current).select(*names)
    scores = drift_from_profile(profile, rows, monitors, bins=bins)
    tags = {**constants, "reference_version": reference, "current_version": current}
    return drift_log(scores, detected_at, tags)


def shift_flow(
    rows: DataFrame,
    shifts: Mapping[str, Shift | DiscreteShift | QuantileShift],
    where: Column,
    reference: str,
    current: str,
    relabel: Callable[[DataFrame], DataFrame],
    rules: FeatureRules,
    probability: Column,
    label: str,
    monitors: Sequence[Monitor],
    detected_at: Column,
    constants: Mapping[str, str],
    path: str,
    version: str = "data_version",
    rounding=round_decimal,
) -> DataFrame:
    """From a shift to its drift log in one run: shift, label, derive the features again, score, log, compare.

    The predictions of both versions, with the monitored columns, are appended to the prediction log at ``path``;
    what is compared is what the log holds. Each row of the drift log also has the accuracy
    of the two versions and the drop between them.
    """
    moved = relabel(shift_cohort(rows, shifts, where, current, version))
    features = gold_features(moved, rules, rounding=rounding)
    names = list(dict.fromkeys([version, *[m.feature for m in monitors]]))
    scored = score_with(features, probability, label, names, rounding=rounding)
    log = append_logged(scored, path).where(F.col(version).isin(reference, current))
    right = lambda name: F.avg(F.when(F.col(version) == name, F.col("is_correct").cast("double"))).alias(name)
    accuracy = log.agg(F.struct(right(reference), right(current))).scalar()
    drift = monitor_versions(log, version, reference, current, monitors, detected_at, constants)
    before, after = accuracy.getField(reference), accuracy.getField(current)
    return drift.select("*", before.alias("accuracy_reference"), after.alias("accuracy_current"), (before - after).alias("accuracy_drop"))
