"""Shifted cohorts, drift statistics, drift log and time profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.features import LABEL_TERMS_SQL, label_terms
from catalogue.registry import moment, num, query, rounded, sql_round
from cohortloom.functions.scoring import label_from_score, label_score
from cohortloom.operators.cohorts import drift_from_profile, merge_profiles, profile_cohort, profile_splits
from cohortloom.operators.drift import (
    Monitor,
    chi_square,
    dataset_drift,
    drift_long,
    drift_report,
    drift_scores,
    jensen_shannon,
    kolmogorov_smirnov,
    population_stability,
    severity,
    wasserstein,
)
from cohortloom.operators.shift import Shift, shift_cohort
from cohortloom.operators.summaries import top_rows
from cohortloom.plans.monitoring import monitor_against_profile, monitor_versions
from cohortloom.session import fresh_path
from cohortloom.sources.sinks import append_evolving, write_table
from cohortloom.sources.tables import fixture
from cohortloom.streaming.profile import drain_to_table, keep_partials, merged_profile, window_profile, window_profile_stream

CUT = "2000-01-01 00:00:00"
DETECTED = "2024-01-01 00:00:00"
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORIES = ["l_returnflag", "l_linestatus"]
SHIFTS = {
    "l_quantity": Shift(scale=1.2, low=1.0, high=55.0),
    "l_extendedprice": Shift(scale=1.2),
    "l_tax": Shift(offset=0.01),
}
MONITORS = [
    Monitor("l_quantity", "wasserstein"),
    Monitor("l_extendedprice", "wasserstein"),
    Monitor("l_discount", "ks"),
    Monitor("l_tax", "psi"),
    Monitor("l_returnflag", "js"),
]


def shifted_lines(spark, folder):
    """Lines in two versions: shipped before the cut as they are, later ones shifted."""
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", *NUMERIC, *CATEGORIES, "l_shipdate"])
    current = F.col("l_shipdate") >= moment(CUT)
    versioned = lines.select("*", F.lit("baseline_v1").alias("data_version"))
    return shift_cohort(versioned, SHIFTS, current, "drift_v1")


def is_reference():
    return F.col("data_version") == "baseline_v1"


SHIFTED_SQL = f"""shifted AS (
  SELECT l_orderkey, is_ref, l_discount, l_returnflag, l_linestatus, l_shipdate,
         CASE WHEN is_ref THEN l_quantity
              ELSE greatest(least(l_quantity * {num(1.2)} + {num(0.0)}, {num(55.0)}), {num(1.0)}) END AS l_quantity,
         CASE WHEN is_ref THEN l_extendedprice ELSE l_extendedprice * {num(1.2)} + {num(0.0)} END AS l_extendedprice,
         CASE WHEN is_ref THEN l_tax ELSE l_tax * {num(1.0)} + {num(0.01)} END AS l_tax
  FROM (SELECT *, l_shipdate < TIMESTAMP '{CUT}' AS is_ref FROM lineitem))"""


def _long_sql(features, cast=""):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}{cast} AS value, is_ref FROM shifted" for c in features)


COUNTS_SQL = f"""
  {SHIFTED_SQL}, long AS ({_long_sql(NUMERIC)}),
  counts AS (SELECT feature, value, CAST(count(*) FILTER (WHERE is_ref) AS DOUBLE) AS r,
                    CAST(count(*) FILTER (WHERE NOT is_ref) AS DOUBLE) AS c FROM long GROUP BY 1, 2),
  curve AS (SELECT feature, lead(value) OVER w - value AS gap,
                   abs(sum(r) OVER w / sum(r) OVER p - sum(c) OVER w / sum(c) OVER p) AS d
            FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature)),
  spread AS (SELECT feature, greatest(stddev_pop(value), 0.001) AS s FROM long WHERE is_ref GROUP BY 1),
  ordered AS (SELECT feature, sum(d * coalesce(gap, 0)) AS w, max(d) AS ks FROM curve GROUP BY 1)"""
BINS_SQL = """
  box AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM long GROUP BY 1),
  bins AS (SELECT l.feature, least(floor((value - lo) / (hi - lo) * 10), 9) AS bin,
                  CAST(count(*) FILTER (WHERE is_ref) AS DOUBLE) AS r,
                  CAST(count(*) FILTER (WHERE NOT is_ref) AS DOUBLE) AS c
           FROM long l JOIN box b ON l.feature = b.feature GROUP BY 1, 2),
  shares AS (SELECT feature, greatest(r / sum(r) OVER p, 1e-4) AS p, greatest(c / sum(c) OVER p, 1e-4) AS q
             FROM bins WINDOW p AS (PARTITION BY feature)),
  psi AS (SELECT feature, sum((p - q) * ln(p / q)) AS psi FROM shares GROUP BY 1)"""
CATEGORY_SQL = f"""
  clong AS ({_long_sql(CATEGORIES)}),
  cats AS (SELECT feature, value, CAST(count(*) FILTER (WHERE is_ref) AS DOUBLE) AS r,
                  CAST(count(*) FILTER (WHERE NOT is_ref) AS DOUBLE) AS c FROM clong GROUP BY 1, 2),
  totals AS (SELECT feature, r, c, sum(r) OVER p AS tr, sum(c) OVER p AS tc FROM cats
             WINDOW p AS (PARTITION BY feature)),
  js AS (SELECT feature, sqrt(greatest(sum(
           (CASE WHEN r > 0 THEN r / tr * ln(r / tr / ((r / tr + c / tc) / 2)) ELSE 0 END
          + CASE WHEN c > 0 THEN c / tc * ln(c / tc / ((r / tr + c / tc) / 2)) ELSE 0 END) / 2), 0)) AS js
         FROM totals GROUP BY 1)"""


@query(
    "shift_cohort",
    f"""
    WITH {SHIFTED_SQL}
    SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax,
           CASE WHEN is_ref THEN 'baseline_v1' ELSE 'drift_v1' END AS data_version,
           CAST(greatest(least({LABEL_TERMS_SQL}
                - CASE WHEN l_extendedprice > 60000 THEN {num(0.15)} ELSE {num(0.0)} END, 1.0), 0.0) >= 0.5
                AS INTEGER) AS label
    FROM shifted
    """,
)
def relabelled_shift(spark, folder):
    score = label_score(label_terms(), [(F.col("l_extendedprice") > 60000, 0.15)])
    return shifted_lines(spark, folder).select(
        "l_orderkey", *NUMERIC, "data_version", label_from_score(score).alias("label")
    )


@query(
    "drift_long",
    f"WITH {SHIFTED_SQL}, long AS ({_long_sql(NUMERIC)}) SELECT feature, value, is_ref AS is_reference FROM long",
)
def long_cohorts(spark, folder):
    return drift_long(shifted_lines(spark, folder), NUMERIC, is_reference())


@query(
    "drift_wasserstein",
    f"""
    WITH {COUNTS_SQL}
    SELECT o.feature, {sql_round('w', 6)} AS wasserstein, {sql_round('w / s', 6)} AS wasserstein_norm
    FROM ordered o JOIN spread s ON o.feature = s.feature
    """,
)
def line_wasserstein(spark, folder):
    result = wasserstein(shifted_lines(spark, folder), NUMERIC, is_reference())
    return rounded(result, {"wasserstein": 6, "wasserstein_norm": 6})


@query("drift_ks", f"WITH {COUNTS_SQL} SELECT feature, {sql_round('ks', 6)} AS ks FROM ordered")
def line_ks(spark, folder):
    return rounded(kolmogorov_smirnov(shifted_lines(spark, folder), NUMERIC, is_reference()), {"ks": 6})


@query(
    "drift_psi",
    f"WITH {SHIFTED_SQL}, long AS ({_long_sql(NUMERIC)}), {BINS_SQL} SELECT feature, {sql_round('psi', 6)} AS psi FROM psi",
)
def line_psi(spark, folder):
    return rounded(population_stability(shifted_lines(spark, folder), NUMERIC, is_reference()), {"psi": 6})


@query("drift_js", f"WITH {SHIFTED_SQL}, {CATEGORY_SQL} SELECT feature, {sql_round('js', 6)} AS js FROM js")
def line_js(spark, folder):
    return rounded(jensen_shannon(shifted_lines(spark, folder), CATEGORIES, is_reference()), {"js": 6})


@query(
    "drift_chi2",
    f"""
    WITH {SHIFTED_SQL}, {CATEGORY_SQL},
    e AS (SELECT feature, r, c, tr * (r + c) / (tr + tc) AS er, tc * (r + c) / (tr + tc) AS ec FROM totals)
    SELECT feature, {sql_round('sum((r - er) * (r - er) / er + (c - ec) * (c - ec) / ec)', 6)} AS chi2,
           count(*) - 1 AS degrees
    FROM e GROUP BY 1
    """,
)
def line_chi2(spark, folder):
    return rounded(chi_square(shifted_lines(spark, folder), CATEGORIES, is_reference()), {"chi2": 6})


def _ladder(score, column):
    steps = {
        "severity": [("0.35", "CRITICAL"), ("0.25", "SEVERE"), ("0.20", "MODERATE"), ("0.10", "WARNING")],
        "action": [("0.35", "IMMEDIATE_ROLLBACK"), ("0.25", "RETRAIN"), ("0.20", "SCHEDULE_RETRAIN"), ("0.10", "MONITOR")],
    }[column]
    calm = {"severity": "STABLE", "action": "NO_ACTION"}[column]
    arms = " ".join(f"WHEN {score} >= {limit} THEN '{name}'" for limit, name in steps)
    return f"CASE {arms} ELSE '{calm}' END"


SCORES_SQL = f"""
  {COUNTS_SQL}, {BINS_SQL}, {CATEGORY_SQL},
  scores AS (
    SELECT o.feature, 'wasserstein' AS statistic, w / s AS score FROM ordered o JOIN spread s ON o.feature = s.feature
    WHERE o.feature IN ('l_quantity', 'l_extendedprice')
    UNION ALL SELECT feature, 'ks', ks FROM ordered WHERE feature = 'l_discount'
    UNION ALL SELECT feature, 'psi', psi FROM psi WHERE feature = 'l_tax'
    UNION ALL SELECT feature, 'js', js FROM js WHERE feature = 'l_returnflag'),
  summary AS (SELECT count(*) AS monitored, count(*) FILTER (WHERE score >= 0.1) AS drifted,
                     avg(CAST(score >= 0.1 AS DOUBLE)) AS share, max(score) AS best,
                     arg_max(feature, score) AS max_feature FROM scores)"""


def line_scores(spark, folder):
    return drift_scores(shifted_lines(spark, folder), is_reference(), MONITORS)


@query(
    "drift_severity",
    f"""
    WITH {SCORES_SQL}
    SELECT feature, statistic, {sql_round('score', 6)} AS drift_score, score >= 0.1 AS drift_detected,
           {_ladder('score', 'severity')} AS severity FROM scores
    """,
)
def line_severity(spark, folder):
    scores = line_scores(spark, folder)
    return rounded(scores.select("*", severity(F.col("drift_score")).alias("severity")), {"drift_score": 6})


@query(
    "drift_severity_custom",
    f"""
    WITH {SCORES_SQL}
    SELECT feature, statistic, CASE WHEN score >= 0.25 THEN 'ALERT' WHEN score >= 0.05 THEN 'WATCH' ELSE 'QUIET' END AS severity
    FROM scores
    """,
)
def line_severity_custom(spark, folder):
    ladder = [(0.05, "WATCH", "LOOK"), (0.25, "ALERT", "STOP")]
    scores = line_scores(spark, folder)
    return scores.select("feature", "statistic", severity(F.col("drift_score"), ladder, "QUIET").alias("severity"))


@query(
    "drift_log_empty_feature",
    f"""
    WITH {SHIFTED_SQL}, {CATEGORY_SQL},
    scores AS (
      SELECT feature, 'js' AS statistic, js AS score FROM js WHERE feature = 'l_returnflag'
      UNION ALL SELECT 'no_number', 'wasserstein', NULL
      UNION ALL SELECT 'no_category', 'js', NULL)
    SELECT feature, statistic, {sql_round('score', 6)} AS drift_score, score >= 0.1 AS drift_detected,
           CASE WHEN score IS NOT NULL THEN {_ladder('score', 'severity')} END AS severity
    FROM scores
    """,
)
def log_with_empty_features(spark, folder):
    lines = shifted_lines(spark, folder).select(
        "*", F.lit(None).cast("double").alias("no_number"), F.lit(None).cast("string").alias("no_category")
    )
    monitors = [Monitor("l_returnflag", "js"), Monitor("no_number"), Monitor("no_category", "js")]
    log = monitor_versions(lines, "data_version", "baseline_v1", "drift_v1", monitors, moment(DETECTED), {"environment": "dev"})
    return rounded(log.select("feature", "statistic", "drift_score", "drift_detected", "severity"), {"drift_score": 6})


@query(
    "dataset_drift",
    f"""
    WITH {SCORES_SQL}
    SELECT monitored, drifted, {sql_round('share', 6)} AS share_drifted, share >= 0.5 AS dataset_drifted FROM summary
    """,
)
def line_dataset_drift(spark, folder):
    summary = dataset_drift(line_scores(spark, folder))
    return rounded(
        summary.select("monitored", "drifted", "share_drifted", "dataset_drifted"), {"share_drifted": 6}
    )


@query(
    "drift_action",
    f"""
    WITH {SCORES_SQL}
    SELECT {sql_round('best', 6)} AS max_score, max_feature, {_ladder('best', 'action')} AS recommended_action
    FROM summary
    """,
)
def line_action(spark, folder):
    summary = dataset_drift(line_scores(spark, folder))
    return rounded(summary.select("max_score", "max_feature", "recommended_action"), {"max_score": 6})


@query(
    "max_drift",
    f"WITH {SCORES_SQL} SELECT feature, {sql_round('score', 6)} AS drift_score FROM scores ORDER BY score DESC LIMIT 1",
)
def line_max_drift(spark, folder):
    worst = top_rows(line_scores(spark, folder), "drift_score", "feature", 1)
    return rounded(worst.select("feature", "drift_score"), {"drift_score": 6})


def line_log(spark, folder):
    return monitor_versions(
        shifted_lines(spark, folder),
        "data_version",
        "baseline_v1",
        "drift_v1",
        MONITORS,
        moment(DETECTED),
        {"environment": "dev"},
    )


LOG_SQL = f"""
  {SCORES_SQL},
  log AS (SELECT TIMESTAMP '{DETECTED}' AS detected_at, 'dev' AS environment, 'baseline_v1' AS reference_version,
                 'drift_v1' AS current_version, feature, statistic, {sql_round('score', 6)} AS drift_score,
                 score >= 0.1 AS drift_detected, {_ladder('score', 'severity')} AS severity,
                 {sql_round('best', 6)} AS max_score, {_ladder('best', 'action')} AS recommended_action,
                 share >= 0.5 AS dataset_drifted, 'new' AS status
          FROM scores, summary)"""


@query("drift_log", f"WITH {LOG_SQL} SELECT * FROM log")
def appended_log(spark, folder):
    log = rounded(line_log(spark, folder), {"drift_score": 6, "max_score": 6})
    return append_evolving(log, fresh_path(spark, "drift-log"))


@query(
    "drift_report",
    f"""
    WITH {LOG_SQL}
    SELECT feature, statistic, drift_score, drift_detected, severity, recommended_action FROM log
    ORDER BY drift_score DESC, feature
    """,
)
def line_report(spark, folder):
    return rounded(drift_report(line_log(spark, folder), moment(DETECTED)), {"drift_score": 6})


def _line_profile(spark, folder):
    """The baseline's profile, merged from two halves of its rows and stored by version."""
    baseline = shifted_lines(spark, folder).where(is_reference())
    halves = [baseline.where(F.pmod("l_orderkey", F.lit(2)) == k) for k in (0, 1)]
    first = write_table(profile_cohort(halves[0], NUMERIC, CATEGORIES), fresh_path(spark, "half-profile"))
    splits = profile_splits(first)
    merged = merge_profiles(first, profile_cohort(halves[1], NUMERIC, CATEGORIES, splits=splits), splits=splits)
    stored = write_table(merged.withColumn("data_version", F.lit("baseline_v1")), fresh_path(spark, "profiles"), partition_by=["data_version"])
    return stored.where("data_version = 'baseline_v1'").drop("data_version")


@query(
    "cohort_profile_merged",
    f"""
    WITH {SHIFTED_SQL}, long AS ({_long_sql(NUMERIC)}), clong AS ({_long_sql(CATEGORIES)})
    SELECT feature, value, CAST(NULL AS VARCHAR) AS category, count(*) AS n, TRUE AS in_range FROM long WHERE is_ref GROUP BY 1, 2
    UNION ALL SELECT feature, NULL, value, count(*), NULL FROM clong WHERE is_ref GROUP BY 1, 3
    """,
)
def line_profile(spark, folder):
    inside = (F.col("low") <= F.col("value")) & (F.col("value") < F.col("high"))
    return _line_profile(spark, folder).select("feature", "value", "category", "n", inside.alias("in_range"))


@query("drift_from_profile", f"WITH {SCORES_SQL} SELECT feature, statistic, {sql_round('score', 6)} AS drift_score, score >= 0.1 AS drift_detected FROM scores")
def scores_from_profile(spark, folder):
    """The scores of ``drift_scores``, the reference read from its stored profile only."""
    current = shifted_lines(spark, folder).where(~is_reference())
    return rounded(drift_from_profile(_line_profile(spark, folder), current, MONITORS), {"drift_score": 6})


@query("drift_log_from_profile", f"WITH {LOG_SQL} SELECT * FROM log")
def log_from_profile(spark, folder):
    log = monitor_against_profile(
        _line_profile(spark, folder), shifted_lines(spark, folder), "data_version", "drift_v1", MONITORS, moment(DETECTED), {"environment": "dev"}, "baseline_v1"
    )
    return append_evolving(rounded(log, {"drift_score": 6, "max_score": 6}), fresh_path(spark, "drift-log"))


PROFILE_SQL = f"""
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS row_count,
           {sql_round('avg(value)', 6)} AS avg_value, min(value) AS min_value, max(value) AS max_value
    FROM events GROUP BY 1, 2"""


@query("hourly_profile", PROFILE_SQL)
def hourly_profile(spark, folder):
    events = fixture(spark, folder, "events", ["ts", "event_type", "value"])
    return rounded(window_profile(events, "ts", "event_type", "value"), {"avg_value": 6})


@query(
    "hourly_profile_stream",
    f"""
    SELECT * FROM ({PROFILE_SQL}) WHERE window_start + INTERVAL 1 HOUR <=
      (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
    """,
)
def hourly_profile_stream(spark, folder):
    path = f"{folder}/events.parquet"
    # a stream source takes a folder or a pattern, not a single file; this pattern has no other match
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{folder}/events.parque[t]")
    profile = window_profile_stream(
        stream.select("ts", "event_type", "value"), "ts", "event_type", "value"
    )
    target = fresh_path(spark, "hourly")
    drain_to_table(profile, target, fresh_path(spark, "hourly-progress"))
    done = spark.read.parquet(target)
    return rounded(
        done.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), {"avg_value": 6}
    )


@query("hourly_profile_running", f"SELECT *, window_start + INTERVAL 1 HOUR + INTERVAL 10 MINUTE > (SELECT max(ts) FROM events) AS is_open FROM ({PROFILE_SQL})")
def hourly_profile_running(spark, folder):
    """The stream in several micro-batches, out of order; every window is given out, open ones marked."""
    source = fresh_path(spark, "events")
    fixture(spark, folder, "events", ["ts", "event_type", "value"]).repartition(4, "event_type").write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 1).parquet(source)
    partials = fresh_path(spark, "hourly-partials")
    keep_partials(stream, "ts", "event_type", "value", partials, fresh_path(spark, "hourly-progress"))
    done = merged_profile(spark, partials, "event_type").drop("late_rows")
    return rounded(done.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), {"avg_value": 6})
