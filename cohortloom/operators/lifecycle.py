"""Run logs: quality gate, status events, notifications, version aliases.

Status changes are rows appended to an event log, never updates in place; the
current state of a run is its latest event.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.columns import cohort_filter
from cohortloom.operators.summaries import latest_row

# The smallest metrics with which a run may be registered.
MINIMUMS = {"precision": 0.85, "roc_auc": 0.90, "f1_score": 0.85}


class NoRunFound(LookupError):
    """No run is in the wanted state."""


def latest_run(runs: DataFrame, at: str, tie_break: str, **state: object) -> DataFrame:
    """The newest run whose columns have the given values; empty if there is none."""
    return latest_row(cohort_filter(runs, **state), at, tie_break)


def require_latest_run(runs: DataFrame, at: str, tie_break: str, **state: object) -> DataFrame:
    """``latest_run``, but an error when no run is in the state."""
    found = latest_run(runs, at, tie_break, **state)
    row = found.collect()  # one at most; the runs are read once
    if not row:
        raise NoRunFound(f"no run with {state}")
    return runs.sparkSession.createDataFrame(row, found.schema)


class GateFailed(RuntimeError):
    """A run is below a minimum."""


def require_gate(runs: DataFrame, run_id: str, minimums: Mapping[str, float] | None = None) -> DataFrame:
    """The runs, or an error that names the metrics of each run that fail: stops a flow."""
    failed = threshold_gate(runs, run_id, minimums or MINIMUMS).where("NOT passed").collect()
    if failed:
        raise GateFailed("; ".join(f"{r[run_id]}: {r['metric']} {r['metric_value']} < {r['minimum']}" for r in failed))
    return runs


def meets(minimums: Mapping[str, float] = MINIMUMS) -> Column:
    """Every metric is at least its minimum; a NULL or NaN metric fails."""
    return reduce(
        and_,
        [
            F.coalesce((F.col(m) >= F.lit(float(low))) & ~F.isnan(F.col(m)), F.lit(False))
            for m, low in minimums.items()
        ],
    )


def threshold_gate(
    runs: DataFrame, run_id: str, minimums: Mapping[str, float] = MINIMUMS
) -> DataFrame:
    """(run_id, metric, metric_value, minimum, passed, all_passed): one row per run and metric.

    Metrics and minimums are few and known, so they are literals in the row's
    own projection; nothing is joined or shuffled.
    """
    entries = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(m).cast("double").alias("metric_value"),
            F.lit(float(low)).alias("minimum"),
            meets({m: low}).alias("passed"),
        )
        for m, low in minimums.items()
    ]
    verdict = meets(minimums).alias("all_passed")
    return runs.select(run_id, verdict, F.inline(F.array(*entries))).select(
        run_id, "metric", "metric_value", "minimum", "passed", "all_passed"
    )


def gate_events(
    runs: DataFrame, run_id: str, at: Column, version: Column, minimums: Mapping[str, float] = MINIMUMS
) -> DataFrame:
    """The events that follow the gate: registered with a version, or rejected."""
    passed = meets(minimums)
    return runs.select(
        run_id,
        F.when(passed, "registered").otherwise("rejected").alias("status"),
        F.when(passed, version).alias("model_version"),
        at.alias("changed_at"),
    )


def status_current(
    events: DataFrame, run_id: str, status: str, at: str, tie_break: str, version: Column | None = None
) -> DataFrame:
    """(run_id, status, changed_at, model_version): state of each run after all events.

    The version is the latest one set, even if later events carry none. All
    picks combine before the shuffle, so a run with very many events is cheap.
    """
    order = F.struct(at, tie_break)
    picks = [F.max_by(status, order).alias("status"), F.max(at).alias("changed_at")]
    if version is not None:
        picks.append(F.max_by(version, F.when(version.isNotNull(), order)).alias("model_version"))
    return events.groupBy(run_id).agg(*picks)


def notification_record(
    run: DataFrame, run_id: str, version: str, metrics: Mapping[str, str], constants: Mapping[str, str]
) -> DataFrame:
    """One record per run: constants, id, version, metrics with 4 digits, message, new status."""
    texts = [F.format_string(f"{label}=%.4f", F.col(m).cast("double")) for m, label in metrics.items()]
    return run.select(
        *[F.lit(v).alias(n) for n, v in constants.items()],
        run_id,
        version,
        *[F.col(m).cast("double").alias(m) for m in metrics],
        F.concat_ws(
            " ",
            F.lit("training complete:"),
            F.concat(F.lit("run="), F.col(run_id).cast("string")),
            F.concat(F.lit("version="), F.col(version).cast("string")),
            *texts,
        ).alias("message"),
        F.lit("notified").alias("status"),
    )


def alias_resolution(
    registrations: DataFrame, model: str, version: str, at: str, tie_break: str
) -> DataFrame:
    """(model, champion, baseline, challenger, versions).

    The first registered version is champion and baseline; the newest later one
    is challenger, NULL while there is only one.
    """
    order = F.struct(at, tie_break)
    found = registrations.groupBy(model).agg(
        F.min_by(version, order).alias("champion"),
        F.max_by(version, order).alias("newest"),
        F.count(F.lit(1)).alias("versions"),
    )
    return found.select(
        model,
        "champion",
        F.col("champion").alias("baseline"),
        F.when(F.col("versions") > 1, F.col("newest")).alias("challenger"),
        "versions",
    )
