"""The compound-study rules on study rows that are derived from the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import moment, num, query, rounded, sql_round
from cohortloom.functions.keys import split_by_mod, surrogate_key
from cohortloom.functions.numeric import round_floor
from cohortloom.functions.scoring import logistic
from cohortloom.operators.drift import drift_report
from cohortloom.operators.quality import range_profile
from cohortloom.operators.shift import QuantileShift, shift_cohort
from cohortloom.plans import compound_study as study
from cohortloom.plans.medallion import clean_table, gold_features
from cohortloom.plans.monitoring import monitor_versions, shift_flow
from cohortloom.session import fresh_path
from cohortloom.sources.published import write_feature_table
from cohortloom.sources.tables import fixture

DETECTED = "2024-01-01 00:00:00"
CELL_NAMES = ["NSCLC", "Breast", "CRC", "Leukemia", "Lymphoma", "other"]


def raw_rows(spark, folder):
    """Study rows made from the line items, one per line, with the line's key alongside."""
    lines = fixture(
        spark,
        folder,
        "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "l_shipdate"],
    )
    cell = F.element_at(F.array(*[F.lit(n) for n in CELL_NAMES]), (F.pmod("l_partkey", F.lit(6)) + 1).cast("int"))
    current = F.col("l_shipdate") >= moment("2000-01-01 00:00:00")
    rows = lines.select(
        (F.col("l_extendedprice") / 150.0 + 90.0).alias("molecular_weight"),
        (F.col("l_discount") * 100.0 - 4.0).alias("logP"),
        (F.col("l_linenumber") - 1).cast("long").alias("hbd_count"),
        F.pmod("l_orderkey", F.lit(12)).alias("hba_count"),
        F.pmod("l_suppkey", F.lit(10)).alias("rotatable_bonds"),
        (F.col("l_tax") * 1750.0 + 20.0).alias("tpsa"),
        F.concat(F.lit(" "), cell).alias("cell_line_type"),
        F.col("l_quantity").cast("long").alias("patient_age0"),
        F.pmod("l_partkey", F.lit(2)).alias("patient_gender"),
        F.pmod("l_suppkey", F.lit(4)).alias("ecog_performance_score"),
        (F.col("l_returnflag") == "R").cast("long").alias("prior_chemotherapy"),
        (F.pmod(F.col("l_partkey") * 7, F.lit(1000)) / 10.0).alias("biomarker_pdl1"),
        (F.pmod("l_orderkey", F.lit(300)) + 50.0).alias("dosage_mg"),
        (F.pmod("l_suppkey", F.lit(8)) + 1).alias("treatment_cycles"),
        split_by_mod("l_orderkey").alias("data_split"),
        F.when(current, "drift_v1").otherwise("baseline_v1").alias("data_version"),
        current.alias("is_drift"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )
    aged = rows.select(
        *[(F.col(c) + 25).alias("patient_age") if c == "patient_age0" else F.col(c) for c in rows.columns]
    )
    return study.with_outcome(aged, rounding=round_floor)


CELL_SQL = "CASE l_partkey % 6 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(CELL_NAMES)) + " END"
SCORE_SQL = (
    f"(1 - (molecular_weight - 150) / {num(350.0)}) * {num(0.25)} "
    f"+ (greatest(least(logP, 5.0), 0.0) / {num(5.0)}) * {num(0.2)} "
    f"+ (1 - CAST(ecog_performance_score AS DOUBLE) / {num(3.0)}) * {num(0.2)} "
    f"+ (biomarker_pdl1 / {num(100.0)}) * {num(0.15)} "
    f"+ (1 - CAST(patient_age - 25 AS DOUBLE) / {num(55.0)}) * {num(0.1)}"
)
RAW_SQL = f"""base AS (
  SELECT l_extendedprice / {num(150.0)} + {num(90.0)} AS molecular_weight,
         l_discount * {num(100.0)} - {num(4.0)} AS logP, CAST(l_linenumber - 1 AS BIGINT) AS hbd_count,
         l_orderkey % 12 AS hba_count, l_suppkey % 10 AS rotatable_bonds,
         l_tax * {num(1750.0)} + {num(20.0)} AS tpsa, ' ' || {CELL_SQL} AS cell_line_type,
         CAST(l_quantity AS BIGINT) + 25 AS patient_age, l_partkey % 2 AS patient_gender,
         l_suppkey % 4 AS ecog_performance_score, CAST(l_returnflag = 'R' AS BIGINT) AS prior_chemotherapy,
         CAST(l_partkey * 7 % 1000 AS DOUBLE) / {num(10.0)} AS biomarker_pdl1,
         CAST(l_orderkey % 300 AS DOUBLE) + {num(50.0)} AS dosage_mg, l_suppkey % 8 + 1 AS treatment_cycles,
         CASE WHEN l_orderkey % 5 < 4 THEN 'train' ELSE 'validation' END AS data_split,
         CASE WHEN l_shipdate >= TIMESTAMP '2000-01-01' THEN 'drift_v1' ELSE 'baseline_v1' END AS data_version,
         l_shipdate >= TIMESTAMP '2000-01-01' AS is_drift, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lineitem),
raw AS (SELECT *, {sql_round(f'greatest(least({SCORE_SQL}, 1.0), 0.0)', 4)} AS efficacy_score,
               CAST(greatest(least({SCORE_SQL}, 1.0), 0.0) >= 0.5 AS INTEGER) AS efficacy_label FROM base)"""
ACCEPTED_SQL = " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in study.ACCEPTED.items())
CLEAN_SQL = f"""clean AS (
  SELECT DISTINCT * REPLACE (upper(trim(cell_line_type)) AS cell_line_type,
                             CAST(patient_gender AS INTEGER) AS patient_gender,
                             CAST(prior_chemotherapy AS INTEGER) AS prior_chemotherapy),
         TRUE AS silver_processed, 'v1.0' AS silver_version
  FROM raw WHERE {ACCEPTED_SQL})"""
CELL_CODE_SQL = (
    "CASE cell_line_type " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in study.CELL_LINES.items()) + " ELSE 0 END"
)
NORM_SQL = ", ".join(
    f"{sql_round(f'(CAST({c} AS DOUBLE) - {num(low)}) / {num(high - low)}', 4)} AS {c}_norm"
    for c, (low, high) in study.SCALES.items()
)
DERIVED_SQL = f"""
  {CELL_CODE_SQL} AS cell_line_index,
  CASE WHEN patient_age < 40 THEN 0 WHEN patient_age < 60 THEN 1 ELSE 2 END AS age_group_index,
  CAST(CAST(molecular_weight < 500 AS INTEGER) + CAST(logP < 5 AS INTEGER) + CAST(hbd_count < 5 AS INTEGER)
       + CAST(hba_count < 10 AS INTEGER) AS DOUBLE) AS lipinski_score,
  {sql_round(f'CAST(patient_age AS DOUBLE) / {num(80.0)} * {num(0.4)} + CAST(ecog_performance_score AS DOUBLE) / {num(4.0)} * {num(0.4)} + CAST(prior_chemotherapy AS DOUBLE) * {num(0.2)}', 4)} AS patient_risk_score,
  {sql_round('tpsa / dosage_mg', 4)} AS dose_normalized_tpsa,
  CAST(biomarker_pdl1 > 50 AS INTEGER) AS high_pdl1_flag, {NORM_SQL}"""


@query("study_clean", f"WITH {RAW_SQL}, {CLEAN_SQL} SELECT * FROM clean")
def study_clean(spark, folder):
    return clean_table(raw_rows(spark, folder), study.cleaning_rules())


@query(
    "study_ranges",
    f"WITH {RAW_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM raw"
        for c in study.PROFILED
    ),
)
def study_ranges(spark, folder):
    return range_profile(raw_rows(spark, folder), study.PROFILED)


@query(
    "study_gold",
    f"""
    WITH {RAW_SQL}, {CLEAN_SQL}
    SELECT {', '.join(study.RAW_FEATURES)}, {DERIVED_SQL}, {', '.join(study.METADATA)} FROM clean
    """,
)
def study_gold(spark, folder):
    return gold_features(study_clean(spark, folder), study.feature_rules(round_floor), rounding=round_floor)


KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "molecular_weight_cents"]


@query(
    "study_feature_table",
    f"""
    WITH {RAW_SQL}, {CLEAN_SQL}
    SELECT sha256(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            CAST(floor((molecular_weight - 90) * 15000 + 0.5) AS BIGINT))) AS feature_id,
           {', '.join(study.RAW_FEATURES)}, {DERIVED_SQL}
    FROM clean
    """,
)
def study_feature_table(spark, folder):
    clean = study_clean(spark, folder).withColumn(
        "molecular_weight_cents", F.floor((F.col("molecular_weight") - 90) * 15000 + 0.5)
    )
    rules = study.feature_rules(round_floor)
    keyed = clean.select("*", surrogate_key(clean, KEY).alias("feature_id"))
    features = gold_features(
        keyed, study.FeatureRules(rules.raw, rules.derived, rules.bounds, ["feature_id"]), rounding=round_floor
    )
    return write_feature_table(features, ["feature_id"], rules.names(), fresh_path(spark, "study-features"))


ROW_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def shifted_rows(spark, folder):
    rows = raw_rows(spark, folder)
    moved = shift_cohort(rows, study.shifts(ROW_KEY), F.col("is_drift"), "drift_v1")
    return study.with_outcome(moved, heavy_penalty=True, rounding=round_floor)


def _shift_sql(column):
    s = study.shifts()[column]
    moved = f"CAST({column} AS DOUBLE) * {num(s.scale)} + {num(s.offset)}"
    if s.whole:
        moved = f"floor({moved} + {num(0.5)})"
    return (
        f"CASE WHEN is_drift THEN greatest(least({moved}, {num(float(s.high))}), {num(float(s.low))}) "
        f"ELSE CAST({column} AS DOUBLE) END AS {column}"
    )


COIN_SQL = f"('0x' || md5(concat_ws('|', {', '.join(ROW_KEY)}, 'shift'))[1:13])::BIGINT / {num(float(2**52))}"
ECOG_SQL = f"""CAST(CASE WHEN NOT is_drift THEN ecog_performance_score WHEN {COIN_SQL} < {num(0.2)} THEN 0
                WHEN {COIN_SQL} < {num(0.2 + 0.35)} THEN 1 WHEN {COIN_SQL} < {num(0.2 + 0.35 + 0.3)} THEN 2 ELSE 3 END AS BIGINT) AS ecog_performance_score"""
SHIFTED_SQL = f"moved AS (SELECT * REPLACE ({', '.join(_shift_sql(c) for c in study.shifts())}, {ECOG_SQL}) FROM base)"
PENALISED_SQL = (
    f"greatest(least({SCORE_SQL} - CASE WHEN molecular_weight > 500 THEN {num(0.15)} ELSE {num(0.0)} END, 1.0), 0.0)"
)


@query(
    "study_shift",
    f"""
    WITH {RAW_SQL}, {SHIFTED_SQL}
    SELECT l_orderkey, data_version, {', '.join(study.MONITORED)},
           {sql_round(PENALISED_SQL, 4)} AS efficacy_score, CAST({PENALISED_SQL} >= 0.5 AS INTEGER) AS efficacy_label
    FROM moved
    """,
)
def study_shift(spark, folder):
    return shifted_rows(spark, folder).select(
        "l_orderkey", "data_version", *study.MONITORED, "efficacy_score", "efficacy_label"
    )


@query(
    "study_shift_discrete",
    f"""
    WITH {RAW_SQL}
    SELECT {', '.join(ROW_KEY)}, is_drift, {_shift_sql("patient_age")}, {ECOG_SQL}
    FROM base
    """,
)
def study_shift_discrete(spark, folder):
    shifts = study.shifts(ROW_KEY)
    discrete = {c: shifts[c] for c in ("patient_age", "ecog_performance_score")}
    return shift_cohort(raw_rows(spark, folder), discrete, F.col("is_drift")).select(*ROW_KEY, "is_drift", "patient_age", "ecog_performance_score")


NUMBERS = [c for c in study.MONITORED if c != "ecog_performance_score"]
LONG_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, NOT is_drift AS is_ref FROM moved" for c in NUMBERS
)


SCORES_SQL = f"""
    long AS ({LONG_SQL}),
    counts AS (SELECT feature, value, CAST(count(*) FILTER (WHERE is_ref) AS DOUBLE) AS r,
                      CAST(count(*) FILTER (WHERE NOT is_ref) AS DOUBLE) AS c FROM long GROUP BY 1, 2),
    curve AS (SELECT feature, lead(value) OVER w - value AS gap,
                     abs(sum(r) OVER w / sum(r) OVER p - sum(c) OVER w / sum(c) OVER p) AS d
              FROM counts WINDOW w AS (PARTITION BY feature ORDER BY value), p AS (PARTITION BY feature)),
    spread AS (SELECT feature, greatest(stddev_pop(value), 0.001) AS s FROM long WHERE is_ref GROUP BY 1),
    areas AS (SELECT feature, sum(d * coalesce(gap, 0)) AS w FROM curve GROUP BY 1),
    cats AS (SELECT ecog_performance_score AS v, CAST(count(*) FILTER (WHERE NOT is_drift) AS DOUBLE) AS r,
                    CAST(count(*) FILTER (WHERE is_drift) AS DOUBLE) AS c FROM moved GROUP BY 1),
    shares AS (SELECT r / sum(r) OVER () AS p, c / sum(c) OVER () AS q FROM cats),
    scores AS (SELECT a.feature, 'wasserstein' AS statistic, w / s AS score FROM areas a JOIN spread s ON a.feature = s.feature
               UNION ALL
               SELECT 'ecog_performance_score', 'js',
                      sqrt(greatest(sum(p * ln(p / ((p + q) / 2)) + q * ln(q / ((p + q) / 2))) / 2, 0)) FROM shares)"""
LADDER_SQL = f"""{sql_round('score', 6)} AS drift_score, score >= 0.1 AS drift_detected,
           CASE WHEN score >= 0.35 THEN 'CRITICAL' WHEN score >= 0.25 THEN 'SEVERE' WHEN score >= 0.2 THEN 'MODERATE'
                WHEN score >= 0.1 THEN 'WARNING' ELSE 'STABLE' END AS severity,
           CASE WHEN max(score) OVER () >= 0.35 THEN 'IMMEDIATE_ROLLBACK' WHEN max(score) OVER () >= 0.25 THEN 'RETRAIN'
                WHEN max(score) OVER () >= 0.2 THEN 'SCHEDULE_RETRAIN' WHEN max(score) OVER () >= 0.1 THEN 'MONITOR'
                ELSE 'NO_ACTION' END AS recommended_action"""


@query("study_drift", f"WITH {RAW_SQL}, {SHIFTED_SQL}, {SCORES_SQL} SELECT feature, statistic, {LADDER_SQL} FROM scores ORDER BY score DESC")
def study_drift(spark, folder):
    log = monitor_versions(
        shifted_rows(spark, folder),
        "data_version",
        "baseline_v1",
        "drift_v1",
        study.monitors(),
        moment(DETECTED),
        {"environment": "dev"},
    )
    return rounded(drift_report(log, moment(DETECTED)), {"drift_score": 6})


LOGIT = [("molecular_weight_norm", -2.0), ("patient_age_norm", -0.5), ("biomarker_pdl1_norm", 1.5), ("ecog_performance_score", -0.25)]
LOGIT_SQL = f"({num(1.0)} / ({num(1.0)} + exp(-({num(0.75)} + ({' + '.join(f'{c} * {num(w)}' for c, w in LOGIT)})))))"


@query(
    "study_shift_flow",
    f"""
    WITH {RAW_SQL}, {SHIFTED_SQL}, {SCORES_SQL},
    labelled AS (SELECT *, CAST({PENALISED_SQL} >= 0.5 AS INTEGER) AS label FROM moved),
    scored AS (SELECT is_drift, label, CAST({LOGIT_SQL} > 0.5 AS INTEGER) AS prediction FROM (SELECT *, {NORM_SQL} FROM labelled)),
    right_ones AS (SELECT avg(CAST(prediction = label AS DOUBLE)) FILTER (WHERE NOT is_drift) AS before,
                          avg(CAST(prediction = label AS DOUBLE)) FILTER (WHERE is_drift) AS after FROM scored)
    SELECT feature, statistic, {LADDER_SQL}, {sql_round('before', 6)} AS accuracy_reference, {sql_round('after', 6)} AS accuracy_current,
           {sql_round('before - after', 6)} AS accuracy_drop
    FROM scores, right_ones
    """,
)
def study_shift_flow(spark, folder):
    """Shift, label, derive, score, log and compare in one run."""
    rules = study.feature_rules(round_floor)
    log = shift_flow(
        raw_rows(spark, folder), study.shifts(ROW_KEY), F.col("is_drift"), "baseline_v1", "drift_v1",
        lambda rows: study.with_outcome(rows, heavy_penalty=True, rounding=round_floor), rules, logistic(LOGIT, 0.75), study.LABEL,
        study.monitors(), moment(DETECTED), {"environment": "dev"}, fresh_path(spark, "prediction-log"), rounding=round_floor,
    )
    found = log.select("feature", "statistic", "drift_score", "drift_detected", "severity", "recommended_action", "accuracy_reference", "accuracy_current", "accuracy_drop")
    return rounded(found, {"drift_score": 6, "accuracy_reference": 6, "accuracy_current": 6, "accuracy_drop": 6})


WANTED = QuantileShift([(0.0, 200.0), (0.25, 380.0), (0.5, 460.0), (0.75, 530.0), (1.0, 700.0)], limits=[150.0, 250.0, 350.0, 450.0, 550.0, 650.0])


def _wanted_sql(share):
    arms = " ".join(
        f"WHEN {share} <= {num(q)} THEN {num(a)} + ({share} - {num(p)}) / {num(q - p)} * {num(b - a)}"
        for (p, a), (q, b) in zip(WANTED.wanted, WANTED.wanted[1:])
    )
    return f"CASE {arms} ELSE {num(WANTED.wanted[-1][1])} END"


@query(
    "study_shift_quantiles",
    f"""
    WITH {RAW_SQL},
    edge AS (SELECT min(molecular_weight) AS lo, max(molecular_weight) AS hi FROM base WHERE is_drift),
    l AS (SELECT unnest({WANTED.limits}::DOUBLE[]) AS x),
    inner_limits AS (SELECT x FROM l, edge WHERE lo < x AND x < hi),
    ranged AS (SELECT b.*, (SELECT count(*) FROM inner_limits WHERE x <= molecular_weight) AS r FROM base b),
    counts AS (SELECT r, count(*) FILTER (WHERE is_drift) AS n FROM ranged GROUP BY r),
    bounds AS (SELECT r, CAST(sum(n) OVER (ORDER BY r) - n AS DOUBLE) / sum(n) OVER () AS u0, CAST(n AS DOUBLE) / sum(n) OVER () AS w,
                      coalesce((SELECT max(x) FROM inner_limits i WHERE (SELECT count(*) FROM inner_limits j WHERE j.x <= i.x) = r), lo) AS a,
                      coalesce((SELECT min(x) FROM inner_limits i WHERE (SELECT count(*) FROM inner_limits j WHERE j.x <= i.x) = r + 1), hi) AS b
               FROM counts, edge),
    shares AS (SELECT m.*, u0 + (molecular_weight - a) / (b - a) * w AS share FROM ranged m JOIN bounds o ON o.r = m.r)
    SELECT {', '.join(ROW_KEY)}, is_drift, {sql_round(f"CASE WHEN is_drift THEN {_wanted_sql('share')} ELSE molecular_weight END", 6)} AS molecular_weight,
           {ECOG_SQL} FROM shares
    """,
)
def study_shift_quantiles(spark, folder):
    """Molecular weights moved to wanted quantiles, the performance score drawn anew, in one call."""
    shifts = {"molecular_weight": WANTED, "ecog_performance_score": study.shifts(ROW_KEY)["ecog_performance_score"]}
    moved = shift_cohort(raw_rows(spark, folder), shifts, F.col("is_drift"))
    return rounded(moved.select(*ROW_KEY, "is_drift", "molecular_weight", "ecog_performance_score"), {"molecular_weight": 6})
