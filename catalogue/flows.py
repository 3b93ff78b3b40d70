"""Whole flows over written tables: raw to features, scoring to drift, run to registration."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.columns import BOUNDS, IN_BOUNDS
from catalogue.features import LABEL_TERMS_SQL, gold_input, line_feature_rules
from catalogue.models import FEATURES, LOGIT_SQL, RUN_SQL, line_run, line_trainable, returned_probability
from catalogue.monitoring import DETECTED, SCORES_SQL, SHIFTED_SQL, shifted_lines
from catalogue.registry import moment, num, query, rounded, sql_round
from cohortloom.functions.numeric import round_floor
from cohortloom.operators.classifier import score_with, training_set
from cohortloom.operators.columns import cohort_filter
from cohortloom.operators.drift import Monitor, drift_report
from cohortloom.operators.lifecycle import gate_events, require_latest_run, status_current
from cohortloom.operators.summaries import table_counts, version_summary
from cohortloom.plans.medallion import CleaningRules, clean_table, gold_features
from cohortloom.plans.monitoring import monitor_versions
from cohortloom.session import fresh_path
from cohortloom.sources.sinks import append_conformed, append_evolving, reference_snapshot, write_table
from cohortloom.sources.tables import fixture


@query(
    "layer_build",
    f"""
    WITH raw AS (SELECT l.*, p_type FROM lineitem l JOIN part ON l_partkey = p_partkey),
    clean AS (SELECT DISTINCT * FROM raw WHERE {IN_BOUNDS})
    SELECT 'raw' AS table_name, count(*) AS row_count FROM raw
    UNION ALL SELECT 'clean', count(*) FROM clean
    UNION ALL SELECT 'gold', count(*) FROM clean
    UNION ALL SELECT 'reference', count(*) FROM clean WHERE l_orderkey % 5 < 4
    """,
)
def layer_build(spark, folder):
    raw = gold_input(spark, folder)
    rules = CleaningRules(["l_quantity", "l_discount"], BOUNDS, {}, ["p_type"], {"table_version": "v1.0"})
    clean = write_table(clean_table(raw, rules), fresh_path(spark, "clean"), partition_by=["data_split"])
    gold = write_table(
        gold_features(clean, line_feature_rules()), fresh_path(spark, "gold"), partition_by=["data_split"]
    )
    reference = reference_snapshot(gold, fresh_path(spark, "gold-reference"))
    return table_counts({"raw": raw, "clean": clean, "gold": gold, "reference": reference})


@query(
    "training_set",
    f"""
    SELECT {', '.join(FEATURES)},
           CAST(greatest(least({LABEL_TERMS_SQL}, 1.0), 0.0) >= 0.5 AS DOUBLE) AS label
    FROM lineitem WHERE l_orderkey % 5 < 4
    """,
)
def line_training_set(spark, folder):
    return training_set(line_trainable(spark, folder), FEATURES, "label", split="data_split")


def prediction_log(spark, folder):
    """Scored lines of both versions in one table: the baseline first, then the shifted ones conformed to it."""
    lines = shifted_lines(spark, folder).select(
        "*", (F.col("l_returnflag") == "R").cast("int").alias("returned")
    )
    kept = ["l_quantity", "l_extendedprice", "data_version"]

    def scored(version):
        rows = cohort_filter(lines, data_version=version)
        return score_with(rows, returned_probability(), "returned", kept, rounding=round_floor)

    path = fresh_path(spark, "prediction-log")
    write_table(scored("baseline_v1"), path)
    loose = scored("drift_v1").withColumn("prediction", F.col("prediction").cast("long"))
    return append_conformed(loose, path)


@query(
    "prediction_log_summary",
    f"""
    WITH {SHIFTED_SQL}, scored AS (
      SELECT CASE WHEN is_ref THEN 'baseline_v1' ELSE 'drift_v1' END AS data_version, l_quantity, l_extendedprice,
             CAST({LOGIT_SQL} > 0.5 AS INTEGER) = CAST(l_returnflag = 'R' AS INTEGER) AS is_correct FROM shifted)
    SELECT data_version, count(*) AS total, {sql_round('avg(CAST(is_correct AS DOUBLE)) * 100', 2)} AS accuracy_pct,
           {sql_round('avg(l_extendedprice)', 1)} AS avg_price, {sql_round('avg(l_quantity)', 1)} AS avg_quantity
    FROM scored GROUP BY 1 ORDER BY 1
    """,
)
def prediction_log_summary(spark, folder):
    return version_summary(
        prediction_log(spark, folder),
        "data_version",
        F.col("is_correct"),
        {"avg_price": F.col("l_extendedprice"), "avg_quantity": F.col("l_quantity")},
        rounding=round_floor,
    )


@query(
    "prediction_log_drift",
    f"""
    WITH {SCORES_SQL}
    SELECT feature, statistic, {sql_round('score', 6)} AS drift_score, score >= 0.1 AS drift_detected,
           CASE WHEN score >= 0.35 THEN 'CRITICAL' WHEN score >= 0.25 THEN 'SEVERE' WHEN score >= 0.2 THEN 'MODERATE'
                WHEN score >= 0.1 THEN 'WARNING' ELSE 'STABLE' END AS severity,
           CASE WHEN max(score) OVER () >= 0.35 THEN 'IMMEDIATE_ROLLBACK' WHEN max(score) OVER () >= 0.25 THEN 'RETRAIN'
                WHEN max(score) OVER () >= 0.2 THEN 'SCHEDULE_RETRAIN' WHEN max(score) OVER () >= 0.1 THEN 'MONITOR'
                ELSE 'NO_ACTION' END AS recommended_action
    FROM scores WHERE feature IN ('l_quantity', 'l_extendedprice') ORDER BY score DESC
    """,
)
def prediction_log_drift(spark, folder):
    log = monitor_versions(
        prediction_log(spark, folder),
        "data_version",
        "baseline_v1",
        "drift_v1",
        [Monitor("l_quantity"), Monitor("l_extendedprice")],
        moment(DETECTED),
        {"environment": "dev"},
    )
    return rounded(drift_report(log, moment(DETECTED)), {"drift_score": 6})


@query(
    "run_lifecycle",
    f"""
    WITH {RUN_SQL}, r AS (SELECT precision >= {num(0.2)} AND roc_auc >= {num(0.4)} AS passed FROM metrics, auc)
    SELECT 'run-1' AS run_id, 'trained' AS status, TIMESTAMP '2024-01-01 00:00:00' AS changed_at,
           CAST(NULL AS VARCHAR) AS model_version FROM r
    UNION ALL
    SELECT 'run-2', CASE WHEN passed THEN 'registered' ELSE 'rejected' END, TIMESTAMP '2024-01-03 00:00:00',
           CASE WHEN passed THEN '2' END FROM r
    """,
)
def run_lifecycle(spark, folder):
    runs, events = fresh_path(spark, "runs"), fresh_path(spark, "status-events")
    first = line_run(spark, folder)
    logged = write_table(first, runs)
    second = logged.select(
        *[
            F.lit("run-2").alias(c) if c == "run_id" else moment("2024-01-02 00:00:00").alias(c) if c == "created_at" else F.col(c)
            for c in logged.columns
        ]
    )
    log = append_evolving(second, runs, schema=logged.schema)
    trained = log.select("run_id", "status", "model_version", F.col("created_at").alias("changed_at"))
    write_table(trained, events)
    newest = require_latest_run(log, "created_at", "run_id", environment="dev", status="trained")
    outcome = gate_events(
        newest, "run_id", moment("2024-01-03 00:00:00"), F.lit("2"), {"precision": 0.2, "roc_auc": 0.4}
    )
    history = append_conformed(outcome, events)
    return status_current(history, "run_id", "status", "changed_at", "status", F.col("model_version")).select(
        "run_id", "status", "changed_at", "model_version"
    )
