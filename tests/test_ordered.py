"""Ordered statistics against brute force, on values chosen to be awkward."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortloom.operators.drift import (
    Monitor,
    chi_square,
    dataset_drift,
    drift_log,
    drift_report,
    drift_scores,
    jensen_shannon,
    ordered_distances,
    population_stability,
    recommended_action,
    severity,
)
from cohortloom.operators.evaluation import roc_auc
from cohortloom.operators.ordered import column_summary
from cohortloom.operators.splits import split_by_position

NAN, INF = float("nan"), float("inf")


def brute_distances(ref, cur):
    ref = np.array([v for v in ref if v is not None and math.isfinite(v)])
    cur = np.array([v for v in cur if v is not None and math.isfinite(v)])
    if not len(ref) or not len(cur):
        return None
    at = np.unique(np.concatenate([ref, cur]))
    f = np.searchsorted(np.sort(ref), at, side="right") / len(ref)
    g = np.searchsorted(np.sort(cur), at, side="right") / len(cur)
    area = float(np.sum(np.abs(f - g)[:-1] * np.diff(at)))
    return area, area / max(ref.std(), 0.001), float(np.max(np.abs(f - g)))


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def cohorts(spark, ref, cur):
    rows = [(v, True) for v in ref] + [(v, False) for v in cur]
    return spark.createDataFrame(rows, "x double, is_ref boolean").repartition(3)


def distances(spark, ref, cur, ranges=5):
    rows = ordered_distances(cohorts(spark, ref, cur), ["x"], F.col("is_ref"), ranges).collect()
    return (rows[0].wasserstein, rows[0].wasserstein_norm, rows[0].ks) if rows else None


CASES = {
    "smooth": ([random.Random(1).gauss(0, 1) for _ in range(400)], [random.Random(2).gauss(1, 2) for _ in range(300)]),
    "hot value": ([0.0] * 500 + list(map(float, range(100))), [0.0] * 50 + list(map(float, range(50, 300)))),
    "constant": ([3.0] * 40, [3.0] * 10),
    "disjoint": ([1.0, 2.0, 3.0], [10.0, 11.0]),
    "missing": ([1.0, None, NAN, 4.0, INF], [2.0, -INF, None, 8.0]),
    "signed zero": ([0.0, -0.0, 1.0], [-0.0, 2.0]),
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("ranges", [2, 7])
def test_distances_match_brute_force(spark, case, ranges):
    ref, cur = CASES[case]
    assert distances(spark, ref, cur, ranges) == pytest.approx(brute_distances(ref, cur), rel=1e-9, abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.integers(-20, 20).map(lambda v: v / 4), min_size=1, max_size=60),
    st.lists(st.integers(-20, 20).map(lambda v: v / 4), min_size=1, max_size=60),
)
def test_distances_match_brute_force_on_any_values(spark, ref, cur):
    assert distances(spark, ref, cur) == pytest.approx(brute_distances(ref, cur), rel=1e-9, abs=1e-12)


def test_features_do_not_disturb_each_other(spark):
    a, b = CASES["smooth"], CASES["hot value"]
    n = 300
    rows = [(a[0][i], b[0][i], True) for i in range(n)] + [(a[1][i], b[1][i], False) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, is_ref boolean")
    got = {r.feature: (r.wasserstein, r.wasserstein_norm, r.ks) for r in ordered_distances(df, ["a", "b"], F.col("is_ref"), 6).collect()}
    assert got["a"] == pytest.approx(brute_distances(a[0][:n], a[1][:n]), rel=1e-9)
    assert got["b"] == pytest.approx(brute_distances(b[0][:n], b[1][:n]), rel=1e-9)


def test_empty_cohort_has_no_distance(spark):
    row = ordered_distances(cohorts(spark, [1.0, 2.0], []), ["x"], F.col("is_ref"), 3).first()
    assert row.wasserstein is None and row.ks is None


@pytest.mark.parametrize(
    "pairs",
    [
        [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)],
        [(0.5, i % 2) for i in range(30)],
        [(float(i % 7), (i * 5) % 3 % 2) for i in range(200)],
        [(0.0, 0)] * 300 + [(0.0, 1)] * 50 + [(i / 100, i % 2) for i in range(150)],
    ],
)
def test_auc_matches_brute_force(spark, pairs):
    df = spark.createDataFrame([(float(s), y) for s, y in pairs], "s double, y int")
    assert roc_auc(df, "y", "s", 5).first().roc_auc == pytest.approx(brute_auc(pairs), rel=1e-12)


@pytest.mark.parametrize("splits", [[], [0.0], [1.0, 2.5, 4.0], [-9.0, 99.0], [float(i) for i in range(7)]])
def test_any_range_limits_give_the_same_result(spark, splits):
    pairs = [(float(i % 7), (i * 5) % 3 % 2) for i in range(200)]
    df = spark.createDataFrame(pairs, "s double, y int")
    assert roc_auc(df, "y", "s", splits=splits).first().roc_auc == pytest.approx(brute_auc(pairs), rel=1e-12)
    ref, cur = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    scores = drift_scores(cohorts(spark, ref, cur), F.col("is_ref"), [Monitor("x")], splits={"x": splits})
    assert scores.first().drift_score == pytest.approx(brute_distances(ref, cur)[1], rel=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.2, 1), (0.3, 1)], "s double, y int")
    assert roc_auc(df, "y", "s", 5).first().roc_auc is None


@pytest.mark.parametrize("n, share", [(1000, 0.8), (7, 0.8), (1, 0.8), (10, 1.0), (10, 0.0)])
def test_positional_split_is_exact(spark, n, share):
    df = spark.range(n).select((F.col("id") * 3 - 5).alias("k")).repartition(4)
    got = {r.k: r.data_split for r in split_by_position(df, "k", share, ranges=5).collect()}
    first = set(sorted(got)[: int(n * share)])
    assert got == {k: "train" if k in first else "validation" for k in got}


def test_positional_split_of_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "k double")
    assert {r.k: r.data_split for r in split_by_position(df, "k", 0.5, ranges=2).collect()} == {1.0: "train", 2.0: "validation", None: None}


def test_positional_split_of_keys_that_share_a_double(spark):
    df = spark.range(100).select((F.col("id") + F.lit(2**60)).alias("k"))
    got = {r.k - 2**60: r.data_split for r in split_by_position(df, "k", 0.8).collect()}
    assert got == {i: "train" if i < 80 else "validation" for i in range(100)}
    assert {r.data_split for r in split_by_position(df, "k", 0.0).collect()} == {"validation"}
    assert {r.data_split for r in split_by_position(df, "k", 1.0).collect()} == {"train"}


def test_positional_split_leaves_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (NAN,), (INF,), (-INF,)], "k double")
    got = sorted((str(r.k), r.data_split) for r in split_by_position(df, "k", 0.5, ranges=2).collect())
    assert got == [("-inf", None), ("1.0", "train"), ("2.0", "validation"), ("inf", None), ("nan", None)]


def test_features_without_values_have_rows(spark):
    df = spark.createDataFrame([(True, 1.0, None, None), (False, 2.0, None, None)], "r boolean, a double, b double, c string")
    monitors = [Monitor("a", "ks"), Monitor("b", "wasserstein"), Monitor("b", "psi"), Monitor("c", "js")]
    got = {(r.feature, r.statistic): r.drift_score for r in drift_scores(df, F.col("r"), monitors).collect()}
    assert got == {("a", "ks"): 1.0, ("b", "wasserstein"): None, ("b", "psi"): None, ("c", "js"): None}


def test_split_points_are_increasing_and_balanced(spark):
    df = spark.range(10000).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"), F.lit(None).cast("double").alias("c"))
    found = column_summary(df, ["a", "b", "c"], ["a"], 10)
    assert len(found["a"].splits) == 9 and found["a"].splits == sorted(set(found["a"].splits))
    assert max(abs(s - 1000 * (i + 1)) for i, s in enumerate(found["a"].splits)) < 400
    assert (found["a"].low, found["a"].high) == (0.0, 9999.0)
    assert found["b"].splits == [1.0] and found["c"].splits == []


def plan_text(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_ordered_plan_reuses_its_shuffle_and_has_no_single_task_window(spark):
    df = spark.range(5000).select((F.col("id") % 977).cast("double").alias("x"), (F.col("id") % 2 == 0).alias("is_ref"))
    plan = plan_text(ordered_distances(df, ["x"], F.col("is_ref"), 4))
    assert "ReusedExchange" in plan
    assert "SinglePartition" not in plan


def test_drift_scores_scan_once_per_family_and_only_their_columns(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    monitors = [Monitor("l_quantity"), Monitor("l_extendedprice", "ks"), Monitor("l_tax", "psi"), Monitor("l_returnflag", "js")]
    plan = plan_text(drift_scores(lines, F.col("l_linestatus") == "F", monitors))
    scans = sorted(part.split("]")[0] for part in plan.split("FileScan parquet [")[1:])
    columns = [sorted(c.split("#")[0] for c in s.split(",")) for s in scans]
    assert columns == [["l_extendedprice", "l_linestatus", "l_quantity"], ["l_linestatus", "l_returnflag", "l_tax"]]
    assert plan.count("ReusedExchange") >= 2 and "Cartesian" not in plan and "NestedLoop" not in plan


def brute_psi(ref, cur, bins=10, floor=1e-4):
    low, high = min(ref + cur), max(ref + cur)
    place = lambda v: 0 if high == low else min(int((v - low) / (high - low) * bins), bins - 1)
    total = 0.0
    for b in {place(v) for v in ref + cur}:
        p = max(sum(place(v) == b for v in ref) / len(ref), floor)
        q = max(sum(place(v) == b for v in cur) / len(cur), floor)
        total += (p - q) * math.log(p / q)
    return total


@pytest.mark.parametrize("case", ["smooth", "hot value", "constant", "disjoint"])
def test_psi_matches_brute_force(spark, case):
    ref, cur = CASES[case]
    got = population_stability(cohorts(spark, ref, cur), ["x"], F.col("is_ref")).first().psi
    assert got == pytest.approx(brute_psi(ref, cur), abs=1e-9)


def test_psi_with_given_edges(spark):
    df = cohorts(spark, [1.0, 2.0, 3.0, 4.0], [3.0, 4.0, 5.0, None])
    got = population_stability(df, ["x"], F.col("is_ref"), edges={"x": [2.5]}).first().psi
    p, q = [0.5, 0.5], [1e-4, 1.0]
    assert got == pytest.approx(sum((a - b) * math.log(a / b) for a, b in zip(p, q)))


def test_category_statistics(spark):
    rows = [("a", True)] * 3 + [("b", True)] + [("a", False)] + [("c", False)] * 3 + [(None, False)]
    df = spark.createDataFrame(rows, "c string, is_ref boolean")
    p, q = {"a": 0.75, "b": 0.25, "c": 0}, {"a": 0.25, "b": 0, "c": 0.75}
    js = 0.0
    for k in p:
        m = (p[k] + q[k]) / 2
        js += sum(0.5 * s * math.log(s / m) for s in (p[k], q[k]) if s)
    assert jensen_shannon(df, ["c"], F.col("is_ref")).first().js == pytest.approx(math.sqrt(js))
    chi = chi_square(df, ["c"], F.col("is_ref")).first()
    expected = sum((o - e) ** 2 / e for o, e in [(3, 2), (1, 2), (1, 0.5), (0, 0.5), (0, 1.5), (3, 1.5)])
    assert (chi.chi2, chi.degrees) == (pytest.approx(expected), 2)


def test_missing_numbers_are_no_category(spark):
    rows = [(1.0, True), (2.0, True), (NAN, True), (1.0, False), (2.0, False), (None, False)]
    df = spark.createDataFrame(rows, "c double, is_ref boolean")
    assert chi_square(df, ["c"], F.col("is_ref")).first().degrees == 1
    assert jensen_shannon(df, ["c"], F.col("is_ref")).first().js == pytest.approx(0.0, abs=1e-9)


def test_equal_categories_have_distance_zero(spark):
    df = spark.createDataFrame([("a", True), ("b", True), ("a", False), ("b", False)], "c string, is_ref boolean")
    assert jensen_shannon(df, ["c"], F.col("is_ref")).first().js == pytest.approx(0.0, abs=1e-9)


def test_severity_and_action_share_the_unrounded_limits(spark):
    values = [0.35, 0.34996, 0.25, 0.2, 0.1, 0.0999, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    got = df.orderBy("i").select(severity(F.col("s")).alias("a"), recommended_action(F.col("s")).alias("b")).collect()
    assert [r.a for r in got] == ["CRITICAL", "SEVERE", "SEVERE", "MODERATE", "WARNING", "STABLE", None]
    assert [r.b for r in got] == ["IMMEDIATE_ROLLBACK", "RETRAIN", "RETRAIN", "SCHEDULE_RETRAIN", "MONITOR", "NO_ACTION", None]


def test_log_has_one_row_per_monitor_and_repeats_the_summary(spark):
    rows = [(float(i), float(i % 4), "a", True) for i in range(40)] + [(float(i + 30), float(i % 4), "b", False) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y double, c string, is_ref boolean")
    monitors = [Monitor("x", "wasserstein"), Monitor("x", "psi"), Monitor("y", "ks"), Monitor("c", "js")]
    scores = drift_scores(df, F.col("is_ref"), monitors)
    log = drift_log(scores, F.expr("timestamp_ntz'2024-01-01 00:00:00'"), {"environment": "dev"}).collect()
    assert sorted((r.feature, r.statistic) for r in log) == [("c", "js"), ("x", "psi"), ("x", "wasserstein"), ("y", "ks")]
    assert len({(r.max_score, r.recommended_action, r.dataset_drifted) for r in log}) == 1
    assert {r.feature: r.drift_detected for r in log if r.statistic in ("ks", "js")} == {"y": False, "c": True}
    summary = dataset_drift(scores).first()
    assert (summary.monitored, summary.drifted, summary.dataset_drifted) == (4, 3, True)
    assert summary.max_score == max(r.drift_score for r in log)


def test_report_picks_one_detection(spark):
    log = spark.createDataFrame(
        [("t1", "a", "ks", 0.1, True, "WARNING", "MONITOR"), ("t2", "a", "ks", 0.3, True, "SEVERE", "RETRAIN"), ("t2", "b", "ks", None, None, None, "RETRAIN")],
        "detected_at string, feature string, statistic string, drift_score double, drift_detected boolean, severity string, recommended_action string",
    )
    assert [r.feature for r in drift_report(log, F.lit("t2")).collect()] == ["a", "b"]


def test_only_distances_can_be_monitored():
    with pytest.raises(ValueError):
        Monitor("x", "chi2")


def test_profile_equals_the_rows_and_halves_merge_to_the_whole(spark):
    from cohortloom.operators.cohorts import PROFILE, drift_from_profile, merge_profiles, profile_cohort, profile_splits

    rows = spark.createDataFrame(
        [(float(i * 7919 % 37) / 4, float("nan") if i % 11 == 0 else (i * 104729 % 9973) / 9973, None if i % 7 == 0 else f"c{i * i % 5}", i % 3 == 0, i) for i in range(3000)],
        "a double, b double, c string, ref boolean, id long",
    )
    current = rows.where("not ref").withColumn("a", F.col("a") * 1.3).withColumn("b", F.col("b") + 0.05)
    both = rows.where("ref").unionByName(current)
    monitors = [Monitor("a"), Monitor("a", "psi"), Monitor("b", "ks"), Monitor("b"), Monitor("c", "js"), Monitor("b", "psi")]
    want = {(r.feature, r.statistic): r.drift_score for r in drift_scores(both, F.col("ref"), monitors).collect()}
    profile = profile_cohort(rows.where("ref"), ["a", "b"], ["c"], ranges=6)
    got = {(r.feature, r.statistic): r.drift_score for r in drift_from_profile(profile, current, monitors).collect()}
    assert got == pytest.approx(want, abs=1e-12) and len(got) == 6
    one, two = (profile_cohort(rows.where(f"ref and id % 2 = {k}"), ["a", "b"], ["c"], ranges=n) for k, n in ((0, 6), (1, 4)))
    merged = merge_profiles(two, one, splits=profile_splits(profile))
    key = lambda df: sorted(map(str, df.select(*PROFILE).collect()))
    assert key(merged) == key(profile)
    assert profile.where("value < low or value >= high").isEmpty()
    assert {r.feature: r.n for r in profile.groupBy("feature").agg(F.sum("n").alias("n")).collect()} == {
        "a": 1000, "b": rows.where("ref and not isnan(b)").count(), "c": rows.where("ref and c is not null").count()}
    rounded = profile_cohort(rows.where("ref"), ["b"], digits={"b": 2})
    assert rounded.count() <= 101
    near = drift_from_profile(rounded, current, [Monitor("b", "ks")], digits={"b": 2}).first().drift_score
    assert near == pytest.approx(want["b", "ks"], abs=0.01)


def test_profile_of_nothing_has_no_scores(spark):
    from cohortloom.operators.cohorts import drift_from_profile, profile_cohort

    rows = spark.createDataFrame([(1.0, "x")], "a double, c string")
    empty = profile_cohort(rows.where("a > 5"), ["a"], ["c"])
    found = drift_from_profile(empty, rows, [Monitor("a"), Monitor("c", "js")]).collect()
    assert len(found) == 2 and all(r.drift_score is None for r in found)


def test_missing_values_are_in_no_bin(spark):
    rows = [(float(i % 10), True) for i in range(100)] + [(float(i % 10), False) for i in range(100)]
    holes = rows + [(None, False)] * 50 + [(NAN, False)] * 50 + [(INF, True)] * 9
    psi = [population_stability(spark.createDataFrame(r, "x double, ref boolean"), ["x"], F.col("ref")).first().psi for r in (rows, holes)]
    assert psi == pytest.approx([0.0, 0.0], abs=1e-12)


def test_the_first_half_of_the_baseline_is_profiled_once(spark, monkeypatch):
    import catalogue.monitoring as queries

    read = []

    def splits(profile):
        read.extend(profile.inputFiles())
        return profile_splits(profile)

    from cohortloom.operators.cohorts import profile_splits

    monkeypatch.setattr(queries, "profile_splits", splits)
    monkeypatch.setattr("cohortloom.operators.cohorts.profile_splits", splits)
    assert queries._line_profile(spark, "/root/testdata/sf0.001").count() > 0
    assert read and all("half-profile" in path for path in read)
