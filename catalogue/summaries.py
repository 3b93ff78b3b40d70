"""Summaries, latest rows and run lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import moment, num, query, rounded, sql_round
from cohortloom.functions.numeric import round_floor
from cohortloom.operators.lifecycle import (
    alias_resolution,
    gate_events,
    latest_run,
    notification_record,
    status_current,
    threshold_gate,
)
from cohortloom.operators.run_state import (
    add_states,
    alias_states,
    aliases_of_states,
    compact_states,
    kept_states,
    merge_status_states,
    status_of_states,
    status_states,
)
from cohortloom.operators.summaries import (
    accuracy_drop,
    class_balance,
    cohort_profile,
    label_counts,
    latest_row_per_group,
    mean_shift,
    version_summary,
)
from cohortloom.session import fresh_path
from cohortloom.sources.tables import fixture

CUT = "2000-01-01 00:00:00"


@query(
    "class_balance",
    f"""
    SELECT l_returnflag, count(*) AS row_count,
           {sql_round('CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM lineitem)', 2)} AS percentage
    FROM lineitem GROUP BY l_returnflag ORDER BY l_returnflag
    """,
)
def flag_balance(spark, folder):
    return class_balance(fixture(spark, folder, "lineitem", ["l_returnflag"]), "l_returnflag", rounding=round_floor)


@query(
    "cohort_profile",
    f"""
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE l_orderkey % 5 < 4) AS train_rows,
           count(*) FILTER (WHERE l_orderkey % 5 >= 4) AS validation_rows,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positives,
           count(*) FILTER (WHERE l_returnflag <> 'R') AS negatives,
           {sql_round("avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)", 6)} AS positive_rate,
           {sql_round('avg(l_extendedprice)', 4)} AS avg_price,
           {sql_round('avg(l_quantity)', 4)} AS avg_quantity
    FROM lineitem
    """,
)
def line_profile(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_returnflag", "l_extendedprice", "l_quantity"])
    train = F.pmod("l_orderkey", F.lit(5)) < 4
    profile = cohort_profile(
        lines,
        {"train": train, "validation": ~train},
        (F.col("l_returnflag") == "R").cast("int"),
        {"price": F.col("l_extendedprice"), "quantity": F.col("l_quantity")},
    )
    return rounded(profile, {"positive_rate": 6, "avg_price": 4, "avg_quantity": 4})


VERSION_SQL = f"CASE WHEN l_shipdate < TIMESTAMP '{CUT}' THEN 'baseline_v1' ELSE 'current_v1' END"


def _versioned_lines(spark, folder):
    lines = fixture(spark, folder, "lineitem")
    version = F.when(F.col("l_shipdate") < moment(CUT), "baseline_v1").otherwise("current_v1")
    return lines.select("*", version.alias("data_version"))


@query(
    "version_summary",
    f"""
    SELECT {VERSION_SQL} AS data_version, count(*) AS total,
           {sql_round("avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) * 100", 2)} AS accuracy_pct,
           {sql_round('avg(l_extendedprice)', 1)} AS avg_price,
           {sql_round('avg(l_quantity)', 1)} AS avg_quantity
    FROM lineitem GROUP BY 1 ORDER BY 1
    """,
)
def line_versions(spark, folder):
    return version_summary(
        _versioned_lines(spark, folder),
        "data_version",
        F.col("l_returnflag") == "R",
        {"avg_price": F.col("l_extendedprice"), "avg_quantity": F.col("l_quantity")},
        rounding=round_floor,
    )


SHIFTED = ["l_quantity", "l_extendedprice", "l_discount"]


def _mean_sql(feature):
    ref = f"avg({feature}) FILTER (WHERE l_shipdate < TIMESTAMP '{CUT}')"
    cur = f"avg({feature}) FILTER (WHERE l_shipdate >= TIMESTAMP '{CUT}')"
    return (
        f"SELECT '{feature}' AS feature, {sql_round(ref, 6)} AS ref_mean, {sql_round(cur, 6)} AS cur_mean, "
        f"{sql_round(f'{cur} - {ref}', 6)} AS difference, "
        f"CASE WHEN {cur} - {ref} > 0 THEN 'up' ELSE 'down' END AS direction FROM lineitem"
    )


@query("mean_shift", " UNION ALL ".join(_mean_sql(f) for f in SHIFTED))
def line_mean_shift(spark, folder):
    lines = fixture(spark, folder, "lineitem", [*SHIFTED, "l_shipdate"])
    shift = mean_shift(lines, SHIFTED, F.col("l_shipdate") < moment(CUT))
    return rounded(shift, {"ref_mean": 6, "cur_mean": 6, "difference": 6})


@query(
    "label_counts",
    f"""
    SELECT quality, count(*) AS row_count,
           {sql_round('(SELECT avg(CAST(quality AS DOUBLE)) FROM labels)', 6)} AS positive_rate
    FROM labels GROUP BY quality
    """,
)
def quality_labels(spark, folder):
    return rounded(label_counts(fixture(spark, folder, "labels", ["quality"]), "quality"), {"positive_rate": 6})


@query(
    "accuracy_drop",
    f"""
    WITH a AS (SELECT avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS accuracy FROM lineitem)
    SELECT {sql_round('accuracy', 6)} AS accuracy, {num(0.9496)} AS baseline,
           {sql_round(f'({num(0.9496)} - accuracy) * 100', 4)} AS drop_points,
           {num(0.9496)} - accuracy > {num(0.05)} AS alert
    FROM a
    """,
)
def line_accuracy_drop(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_returnflag"])
    drop = accuracy_drop(lines, F.col("l_returnflag") == "R", 0.9496, 0.05)
    return rounded(drop, {"accuracy": 6, "drop_points": 4})


RUN_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "latest_run",
    f"""
    SELECT {', '.join(RUN_COLUMNS)} FROM orders
    WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1
    """,
)
def newest_run(spark, folder):
    runs = fixture(spark, folder, "orders", RUN_COLUMNS)
    return latest_run(runs, "o_orderdate", "o_orderkey", o_orderpriority="1-URGENT", o_orderstatus="F")


@query(
    "latest_run_per_group",
    f"""
    SELECT {', '.join(RUN_COLUMNS)} FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderstatus = 'F') WHERE rn = 1
    """,
)
def newest_run_per_group(spark, folder):
    runs = fixture(spark, folder, "orders", RUN_COLUMNS).where(F.col("o_orderstatus") == "F")
    return latest_row_per_group(runs, "o_custkey", "o_orderdate", "o_orderkey")


METRIC_SQL = (
    f"o_orderkey AS run_id, o_totalprice / {num(500000.0)} AS precision, "
    f"{num(0.5)} + o_totalprice / {num(1000000.0)} AS roc_auc, "
    f"CAST(o_custkey % 100 AS DOUBLE) / {num(100.0)} AS f1_score"
)
MINIMUMS = {"precision": 0.85, "roc_auc": 0.90, "f1_score": 0.85}


def _runs(spark, folder):
    """Orders as a run log, with metrics made from their columns."""
    return fixture(spark, folder, "orders", RUN_COLUMNS).select(
        F.col("o_orderkey").alias("run_id"),
        (F.col("o_totalprice") / 500000.0).alias("precision"),
        (F.lit(0.5) + F.col("o_totalprice") / 1000000.0).alias("roc_auc"),
        (F.pmod("o_custkey", F.lit(100)).cast("double") / 100.0).alias("f1_score"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_custkey").alias("model_version"),
    )


GATE = " AND ".join(f"{m} >= {num(v)}" for m, v in MINIMUMS.items())


@query(
    "threshold_gate",
    f"WITH r AS (SELECT {METRIC_SQL} FROM orders) "
    + " UNION ALL ".join(
        f"SELECT run_id, '{m}' AS metric, {m} AS metric_value, {num(v)} AS minimum, {m} >= {num(v)} AS passed, "
        f"({GATE}) AS all_passed FROM r"
        for m, v in MINIMUMS.items()
    ),
)
def gated_runs(spark, folder):
    return threshold_gate(_runs(spark, folder), "run_id", MINIMUMS)


@query(
    "gate_events",
    f"""
    WITH r AS (SELECT {METRIC_SQL}, o_custkey, o_orderdate FROM orders)
    SELECT run_id, CASE WHEN {GATE} THEN 'registered' ELSE 'rejected' END AS status,
           CASE WHEN {GATE} THEN o_custkey END AS model_version, o_orderdate AS changed_at FROM r
    """,
)
def gate_outcomes(spark, folder):
    return gate_events(
        _runs(spark, folder), "run_id", F.col("created_at"), F.col("model_version"), MINIMUMS
    )


@query(
    "status_current",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS changed_at
    FROM events GROUP BY user_id
    """,
)
def current_status(spark, folder):
    events = fixture(spark, folder, "events", ["user_id", "event_type", "ts", "event_id"])
    return status_current(events, "user_id", "event_type", "ts", "event_id")


@query(
    "status_registered",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS changed_at,
           arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS model_version
    FROM events GROUP BY user_id
    """,
)
def registered_status(spark, folder):
    events = fixture(spark, folder, "events", ["user_id", "event_type", "ts", "event_id"])
    version = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    return status_current(events, "user_id", "event_type", "ts", "event_id", version)


@query(
    "status_incremental",
    """
    SELECT user_id, arg_max(event_type, (ts, event_id)) AS status, max(ts) AS changed_at,
           arg_max(event_id, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS model_version
    FROM events GROUP BY user_id
    """,
)
def incremental_status(spark, folder):
    """Three batches out of order in time, the second twice, the first two compacted; the state is that of all events."""
    events = fixture(spark, folder, "events", ["user_id", "event_type", "ts", "event_id"])
    version = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    batches = [status_states(events.where(F.pmod("event_id", F.lit(3)) == k), "user_id", "event_type", "ts", "event_id", version) for k in (2, 0, 1)]
    path, compacted = fresh_path(spark, "states"), fresh_path(spark, "states")
    for number in (0, 1, 1):
        add_states(batches[number], path, number)
    compact_states(spark, path, merge_status_states(kept_states(spark, path, batches[0]), "user_id"), 1, compacted)
    add_states(batches[2], compacted, 2)
    return status_of_states(kept_states(spark, compacted, batches[0]), "user_id")


@query(
    "alias_incremental",
    """
    SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS champion,
           arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS baseline,
           CASE WHEN count(*) > 1 THEN arg_max(o_orderkey, (o_orderdate, o_orderkey)) END AS challenger,
           CAST(count(*) AS BIGINT) AS versions
    FROM orders GROUP BY o_custkey
    """,
)
def incremental_aliases(spark, folder):
    orders = fixture(spark, folder, "orders", ["o_custkey", "o_orderkey", "o_orderdate"])
    path = fresh_path(spark, "aliases")
    for number in (0, 1):
        states = alias_states(orders.where(F.pmod("o_orderkey", F.lit(2)) == 1 - number), "o_custkey", "o_orderkey", "o_orderdate", "o_orderkey")
        add_states(states, path, number)
    return aliases_of_states(kept_states(spark, path, states), "o_custkey")


@query(
    "notification_record",
    f"""
    WITH r AS (SELECT {METRIC_SQL}, o_custkey AS model_version FROM orders WHERE o_orderstatus = 'F'
               ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
    SELECT 'dev' AS environment, run_id, model_version, precision, roc_auc,
           'training complete: run=' || run_id || ' version=' || model_version ||
           printf(' precision=%.4f', precision) || printf(' auc=%.4f', roc_auc) AS message,
           'notified' AS status
    FROM r
    """,
)
def run_notification(spark, folder):
    run = latest_run(_runs(spark, folder), "created_at", "run_id", status="F")
    return notification_record(
        run, "run_id", "model_version", {"precision": "precision", "roc_auc": "auc"}, {"environment": "dev"}
    )


@query(
    "alias_resolution",
    """
    SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS champion,
           arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS baseline,
           CASE WHEN count(*) > 1 THEN arg_max(o_orderkey, (o_orderdate, o_orderkey)) END AS challenger,
           count(*) AS versions
    FROM orders GROUP BY o_custkey
    """,
)
def version_aliases(spark, folder):
    orders = fixture(spark, folder, "orders", ["o_custkey", "o_orderkey", "o_orderdate"])
    return alias_resolution(orders, "o_custkey", "o_orderkey", "o_orderdate", "o_orderkey")
