import pytest
from pyspark.sql import functions as F

from cohortloom.operators.lifecycle import (
    GateFailed,
    NoRunFound,
    alias_resolution,
    gate_events,
    notification_record,
    require_gate,
    require_latest_run,
    status_current,
    threshold_gate,
)
from cohortloom.operators.summaries import (
    accuracy_drop,
    class_balance,
    label_counts,
    latest_row_per_group,
    mean_shift,
    top_rows,
)

RUNS = [("r1", "dev", "trained", 1, 0.9, 0.95, 0.9), ("r2", "dev", "trained", 1, 0.8, 0.95, 0.9), ("r3", "dev", "trained", 0, 0.9, None, 0.9)]
SCHEMA = "run_id string, environment string, status string, created_at int, precision double, roc_auc double, f1_score double"


def test_latest_run_settles_ties_and_reports_absence(spark):
    runs = spark.createDataFrame(RUNS, SCHEMA)
    assert require_latest_run(runs, "created_at", "run_id", environment="dev", status="trained").first().run_id == "r2"
    with pytest.raises(NoRunFound):
        require_latest_run(runs, "created_at", "run_id", environment="prod")


def test_gate_fails_on_low_and_on_missing_metrics(spark):
    runs = spark.createDataFrame(RUNS, SCHEMA)
    rows = threshold_gate(runs, "run_id").collect()
    assert {r.run_id: r.all_passed for r in rows} == {"r1": True, "r2": False, "r3": False}
    assert [(r.metric, r.passed) for r in rows if r.run_id == "r3"] == [("precision", True), ("roc_auc", False), ("f1_score", True)]
    events = {r.run_id: (r.status, r.model_version) for r in gate_events(runs, "run_id", F.lit(2), F.lit("7")).collect()}
    assert events == {"r1": ("registered", "7"), "r2": ("rejected", None), "r3": ("rejected", None)}


def test_status_is_the_last_event_and_keeps_the_version(spark):
    events = spark.createDataFrame(
        [("r", "trained", 1, 1, None), ("r", "registered", 2, 2, "5"), ("r", "notified", 2, 3, None), ("q", "trained", 9, 4, None)],
        "run_id string, status string, at int, seq int, version string",
    )
    got = {r.run_id: (r.status, r.model_version) for r in status_current(events, "run_id", "status", "at", "seq", F.col("version")).collect()}
    assert got == {"r": ("notified", "5"), "q": ("trained", None)}


def test_notification_text(spark):
    run = spark.createDataFrame([("r", "3", 0.91234)], "run_id string, model_version string, precision double")
    row = notification_record(run, "run_id", "model_version", {"precision": "precision"}, {"environment": "dev"}).first()
    assert row.message == "training complete: run=r version=3 precision=0.9123" and row.status == "notified"


def test_aliases(spark):
    log = spark.createDataFrame([("m", 1, 1), ("m", 2, 2), ("m", 3, 2), ("n", 4, 1)], "model string, version int, at int")
    got = {r.model: (r.champion, r.baseline, r.challenger) for r in alias_resolution(log, "model", "version", "at", "version").collect()}
    assert got == {"m": (1, 1, 3), "n": (4, 4, None)}


def test_latest_per_group_with_one_hot_group(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("g"), (F.col("id") % 50).alias("at"), "id")
    got = latest_row_per_group(df, "g", "at", "id")
    assert got.columns == df.columns and got.count() == 6001
    assert got.where("g = -1").first().at == 49


def test_class_balance_shares_one_shuffle(spark):
    df = spark.createDataFrame([("a",)] * 2 + [("b",)] + [(None,)], "y string")
    balance = class_balance(df, "y")
    assert [tuple(r) for r in balance.collect()] == [(None, 1, 25.0), ("a", 2, 50.0), ("b", 1, 25.0)]
    assert class_balance(df.limit(0), "y").collect() == []


def test_mean_shift_directions(spark):
    df = spark.createDataFrame([(1.0, 1.0, True), (3.0, 1.0, False), (float("nan"), 1.0, False)], "a double, b double, is_ref boolean")
    got = {r.feature: (r.difference, r.direction) for r in mean_shift(df, ["a", "b"], F.col("is_ref")).collect()}
    assert got == {"a": (2.0, "up"), "b": (0.0, "down")}
    empty = mean_shift(df.where("is_ref"), ["a"], F.col("is_ref")).first()
    assert empty.cur_mean is None and empty.direction is None


def test_label_counts_and_accuracy_drop(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (None,)], "y int")
    assert {r.y: r.row_count for r in label_counts(df, "y").collect()} == {1: 2, 0: 1, None: 1}
    assert label_counts(df, "y").first().positive_rate == pytest.approx(2 / 3)
    drop = accuracy_drop(df.where("y is not null"), F.col("y") == 1, 0.9496, 0.05).first()
    assert drop.alert and drop.drop_points == pytest.approx((0.9496 - 2 / 3) * 100)


def test_top_rows_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "f string, v double")
    assert [r.f for r in top_rows(df, "v", "f", 2).collect()] == ["c", "a"]


def test_a_failed_gate_stops_the_flow(spark):
    runs = spark.createDataFrame([("a", 0.9, 0.9), ("b", 0.9, None)], "run_id string, precision double, roc_auc double")
    assert require_gate(runs.where("run_id = 'a'"), "run_id", {"precision": 0.5, "roc_auc": 0.5}).count() == 1
    with pytest.raises(GateFailed, match="b: roc_auc"):
        require_gate(runs, "run_id", {"precision": 0.5, "roc_auc": 0.5})
