"""Weights, training, scoring and metrics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from catalogue.features import LABEL_TERMS_SQL, label_terms
from catalogue.registry import moment, num, query, rounded, sql_round
from cohortloom.functions.keys import split_by_mod
from cohortloom.functions.numeric import round_floor
from cohortloom.functions.scoring import label_from_score, label_score, logistic
from cohortloom.operators.classifier import (
    BoostingSettings,
    feature_importance,
    load_model,
    save_model,
    score_model,
    score_with,
    train_boosted_trees,
    training_curve,
    training_set,
)
from cohortloom.operators.evaluation import (
    balanced_weight,
    classification_metrics,
    confusion_matrix,
    roc_auc,
    run_record,
)
from cohortloom.operators.lifecycle import threshold_gate
from cohortloom.operators.summaries import score_summary, top_rows
from cohortloom.plans.modelling import evaluate_run, train_and_score
from cohortloom.session import fresh_path
from cohortloom.sources.sinks import write_csv, write_table
from cohortloom.sources.tables import fixture

CREATED = "2024-01-01 00:00:00"


def _labelled(spark, folder):
    """Quality labels with the length of their document as score."""
    labels = fixture(spark, folder, "labels", ["doc_id", "quality"])
    documents = fixture(spark, folder, "documents", ["doc_id", "n_chars"])
    return labels.join(documents, "doc_id").select(
        "doc_id", "quality", "n_chars", (F.col("n_chars") >= 300).cast("int").alias("prediction")
    )


LABELLED_SQL = """labelled AS (
  SELECT l.doc_id, l.quality, d.n_chars, CAST(d.n_chars >= 300 AS INTEGER) AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
MATRIX_SQL = """matrix AS (
  SELECT count(*) FILTER (WHERE quality = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE quality = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE quality = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE quality = 1 AND prediction = 1) AS tp FROM labelled)"""


@query(
    "balanced_weight",
    """
    SELECT doc_id, quality,
           CAST((SELECT count(*) FROM labels) AS DOUBLE) /
           ((SELECT count(DISTINCT quality) FROM labels) * CAST(count(*) OVER (PARTITION BY quality) AS DOUBLE))
           AS sample_weight
    FROM labels
    """,
)
def label_weights(spark, folder):
    return balanced_weight(fixture(spark, folder, "labels", ["doc_id", "quality"]), "quality")


@query("confusion_matrix", f"WITH {LABELLED_SQL}, {MATRIX_SQL} SELECT tn, fp, fn, tp FROM matrix")
def label_confusion(spark, folder):
    return confusion_matrix(_labelled(spark, folder), "quality", "prediction")


METRICS_SQL = ", ".join(
    f"coalesce({sql_round(f'CAST({a} AS DOUBLE) / nullif({b}, 0)', 6)}, 0.0) AS {name}"
    for name, a, b in [
        ("accuracy", "(tp + tn)", "(tn + fp + fn + tp)"),
        ("precision", "tp", "(tp + fp)"),
        ("recall", "tp", "(tp + fn)"),
        ("f1_score", "(2 * tp)", "(2 * tp + fp + fn)"),
        ("positive_rate", "(tp + fn)", "(tn + fp + fn + tp)"),
    ]
)
METRIC_DIGITS = {c: 6 for c in ("accuracy", "precision", "recall", "f1_score", "positive_rate")}


@query(
    "classification_metrics",
    f"WITH {LABELLED_SQL}, {MATRIX_SQL} SELECT {METRICS_SQL}, tn + fp + fn + tp AS samples FROM matrix",
)
def label_metrics(spark, folder):
    return rounded(classification_metrics(_labelled(spark, folder), "quality", "prediction"), METRIC_DIGITS)


def _auc_sql(source, label, score):
    return f"""
    c AS (SELECT {score} AS s, CAST(count(*) FILTER (WHERE {label} = 1) AS DOUBLE) AS p,
                 CAST(count(*) FILTER (WHERE {label} = 0) AS DOUBLE) AS n FROM {source} GROUP BY 1),
    a AS (SELECT p, n, sum(n) OVER (ORDER BY s) - n AS below FROM c),
    auc AS (SELECT sum(p * (below + n / 2)) / (sum(p) * sum(n)) AS roc_auc FROM a)"""


@query(
    "roc_auc",
    f"WITH {LABELLED_SQL}, {_auc_sql('labelled', 'quality', 'n_chars')} SELECT {sql_round('roc_auc', 9)} AS roc_auc FROM auc",
)
def label_auc(spark, folder):
    return rounded(roc_auc(_labelled(spark, folder), "quality", "n_chars"), {"roc_auc": 9})


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LOGIT_SQL = (
    f"({num(1.0)} / ({num(1.0)} + exp(-({num(-0.4)} + ((l_quantity / {num(50.0)}) * {num(1.5)} "
    f"+ (l_extendedprice / {num(105000.0)}) * {num(-1.0)} + l_tax * {num(2.0)})))))"
)
SCORED_SQL = f"""scored AS (
  SELECT l_orderkey, l_quantity, {LOGIT_SQL} AS p, CAST(l_returnflag = 'R' AS INTEGER) AS actual FROM lineitem)"""


def returned_probability():
    return logistic(
        [(F.col("l_quantity") / 50.0, 1.5), (F.col("l_extendedprice") / 105000.0, -1.0), ("l_tax", 2.0)], -0.4
    )


def _scored(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_returnflag", *FEATURES])
    labelled = lines.select("*", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    return score_with(
        labelled, returned_probability(), "returned", ["l_orderkey", "l_quantity"], rounding=round_floor, raw="probability"
    )


@query(
    "score_logistic",
    f"""
    WITH {SCORED_SQL}
    SELECT l_orderkey, l_quantity, CAST(p > 0.5 AS INTEGER) AS prediction, {sql_round('p', 4)} AS prediction_prob,
           CASE WHEN p > 0.5 THEN 'positive' ELSE 'negative' END AS prediction_label,
           {sql_round('CASE WHEN p >= 0.5 THEN p ELSE 1 - p END', 4)} AS confidence,
           actual AS actual_label, CAST(p > 0.5 AS INTEGER) = actual AS is_correct
    FROM scored
    """,
)
def logistic_scores(spark, folder):
    return _scored(spark, folder).drop("probability")


@query(
    "score_summary",
    f"""
    WITH {SCORED_SQL}
    SELECT count(*) AS total, count(*) FILTER (WHERE p > 0.5) AS positives,
           count(*) FILTER (WHERE NOT p > 0.5) AS negatives,
           count(*) FILTER (WHERE CAST(p > 0.5 AS INTEGER) = actual) AS correct,
           {sql_round('avg(CAST(CAST(p > 0.5 AS INTEGER) = actual AS DOUBLE))', 6)} AS accuracy,
           {sql_round(f"avg({sql_round('CASE WHEN p >= 0.5 THEN p ELSE 1 - p END', 4)})", 6)} AS avg_confidence
    FROM scored
    """,
)
def logistic_summary(spark, folder):
    return rounded(score_summary(_scored(spark, folder)), {"accuracy": 6, "avg_confidence": 6})


@query(
    "roc_auc_lines",
    f"WITH {SCORED_SQL}, {_auc_sql('scored', 'actual', sql_round('p', 12))} "
    f"SELECT {sql_round('roc_auc', 9)} AS roc_auc FROM auc",
)
def line_auc(spark, folder):
    scored = _scored(spark, folder).withColumn("probability", round_floor("probability", 12))
    return rounded(roc_auc(scored, "actual_label", "probability"), {"roc_auc": 9})


RUN_SQL = f"""
    {SCORED_SQL}, labelled AS (SELECT actual AS quality, CAST(p > 0.5 AS INTEGER) AS prediction FROM scored),
    {MATRIX_SQL}, {_auc_sql('scored', 'actual', sql_round('p', 12))}, metrics AS (SELECT {METRICS_SQL} FROM matrix)"""


def _run(spark, folder):
    scored = _scored(spark, folder).withColumn("probability", round_floor("probability", 12))
    return run_record(
        scored,
        "actual_label",
        "prediction",
        "probability",
        {"run_id": "run-1", "environment": "dev"},
        moment(CREATED),
    )


@query(
    "run_record",
    f"""
    WITH {RUN_SQL}
    SELECT 'run-1' AS run_id, 'dev' AS environment, precision, recall, f1_score,
           {sql_round('roc_auc', 9)} AS roc_auc, accuracy, 'trained' AS status,
           CAST(NULL AS VARCHAR) AS model_version, TIMESTAMP '{CREATED}' AS created_at
    FROM metrics, auc
    """,
)
def line_run(spark, folder):
    digits = {c: 6 for c in ("precision", "recall", "f1_score", "accuracy")}
    return rounded(_run(spark, folder), {**digits, "roc_auc": 9})


@query(
    "run_gate",
    f"""
    WITH {RUN_SQL}, r AS (SELECT precision, roc_auc, f1_score FROM metrics, auc)
    SELECT 'run-1' AS run_id, 'precision' AS metric, precision AS metric_value, {num(0.2)} AS minimum,
           precision >= 0.2 AS passed, precision >= 0.2 AND roc_auc >= 0.9 AS all_passed FROM r
    UNION ALL
    SELECT 'run-1', 'roc_auc', {sql_round('roc_auc', 6)}, {num(0.9)}, roc_auc >= 0.9,
           precision >= 0.2 AND roc_auc >= 0.9 FROM r
    """,
)
def line_run_gate(spark, folder):
    gate = threshold_gate(_run(spark, folder), "run_id", {"precision": 0.2, "roc_auc": 0.9})
    return rounded(gate, {"metric_value": 6})


TRIAL = BoostingSettings(trees=5, depth=3, learning_rate=0.3)


def line_trainable(spark, folder, key=("l_orderkey",)):
    lines = fixture(spark, folder, "lineitem", [*key, *FEATURES])
    return lines.select(
        "*",
        label_from_score(label_score(label_terms())).alias("label"),
        split_by_mod("l_orderkey").alias("data_split"),
    )


def _model(spark, folder):
    train = training_set(line_trainable(spark, folder), FEATURES, "label", split="data_split")
    weighted = balanced_weight(train, "label")
    return train_boosted_trees(
        weighted, FEATURES, "label", "sample_weight", TRIAL
    )


@query("train_gbt")
def trained_run(spark, folder):
    _, scored = train_and_score(line_trainable(spark, folder), FEATURES, "label", "data_split", TRIAL)
    log = write_table(scored, fresh_path(spark, "predictions"))
    return evaluate_run(log, "run-1", "dev", moment(CREATED))


@query("score_gbt")
def tree_scores(spark, folder):
    rows = line_trainable(spark, folder)
    return score_model(_model(spark, folder), rows, FEATURES, "label", ["l_orderkey", "l_quantity"])


@query("training_curve")
def tree_curve(spark, folder):
    held_out = line_trainable(spark, folder).where("data_split <> 'train'")
    return training_curve(_model(spark, folder), held_out, FEATURES, "label")


@query("feature_importance")
def tree_importance(spark, folder):
    return feature_importance(spark, _model(spark, folder), FEATURES)


@query("top_importance")
def tree_top_importance(spark, folder):
    return top_rows(tree_importance(spark, folder), "importance", "feature", 3)


@query("importance_csv")
def tree_importance_csv(spark, folder):
    return write_csv(tree_importance(spark, folder).orderBy(F.desc("importance"), "feature"), fresh_path(spark, "importance"))


@query(
    "train_gbt_checks",
    """
    SELECT count(*) FILTER (WHERE l_orderkey % 5 >= 4) AS scored, TRUE AS metrics_in_range, TRUE AS above_chance
    FROM lineitem
    """,
)
def trained_run_checks(spark, folder):
    """Properties of a fit, not the trees: every held-out row scored, metrics in [0, 1], better than chance."""
    _, scored = train_and_score(line_trainable(spark, folder), FEATURES, "label", "data_split", TRIAL)
    log = write_table(scored, fresh_path(spark, "predictions"))
    run = evaluate_run(log, "run-1", "dev", moment(CREATED))
    metrics = ["precision", "recall", "f1_score", "roc_auc", "accuracy"]
    inside = reduce(and_, [F.col(m).between(0, 1) for m in metrics])
    return run.select(
        F.lit(log.count()).cast("long").alias("scored"), inside.alias("metrics_in_range"), (F.col("roc_auc") > 0.5).alias("above_chance")
    )


@query(
    "score_gbt_checks",
    f"""
    SELECT count(*) AS scored, CAST(sum(l_quantity) AS BIGINT) AS quantity,
           CAST(sum(CAST(greatest(least({LABEL_TERMS_SQL}, 1.0), 0.0) >= 0.5 AS INTEGER)) AS BIGINT) AS positives,
           TRUE AS probability_in_range, TRUE AS class_fits, TRUE AS confidence_fits, TRUE AS correctness_fits
    FROM lineitem
    """,
)
def tree_score_checks(spark, folder):
    """Every row scored once with its own columns and label; class, confidence and correctness follow from the probability."""
    rows = line_trainable(spark, folder)
    scored = score_model(_model(spark, folder), rows, FEATURES, "label", ["l_orderkey", "l_quantity"], raw="p")
    confidence = F.when(F.col("p") >= 0.5, F.col("p")).otherwise(1 - F.col("p"))
    return scored.agg(
        F.count(F.lit(1)).alias("scored"),
        F.sum("l_quantity").cast("long").alias("quantity"),
        F.sum("actual_label").alias("positives"),
        F.bool_and(F.col("p").between(0, 1)).alias("probability_in_range"),
        F.bool_and((F.col("prediction") == 1) == (F.col("p") > 0.5)).alias("class_fits"),
        F.bool_and(F.abs(F.col("confidence") - confidence) <= 0.0001).alias("confidence_fits"),
        F.bool_and(F.col("is_correct") == (F.col("prediction") == F.col("actual_label"))).alias("correctness_fits"),
    )


@query("training_curve_checks", f"SELECT CAST({TRIAL.trees} AS BIGINT) AS trees, TRUE AS in_order, TRUE AS falls")
def tree_curve_checks(spark, folder):
    """One loss for each tree, numbered from 1, and lower after the last tree than after the first."""
    curve = tree_curve(spark, folder)
    return curve.agg(
        F.count(F.lit(1)).alias("trees"),
        (F.min("tree_count").eqNullSafe(1) & (F.max("tree_count") == F.count(F.lit(1)))).alias("in_order"),
        (F.max_by("loss", "tree_count") < F.min_by("loss", "tree_count")).alias("falls"),
    )


@query(
    "feature_importance_checks",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS in_range, TRUE AS sums_to_one" for c in FEATURES),
)
def tree_importance_checks(spark, folder):
    """Every input named once; importances in [0, 1] that sum to 1."""
    found = tree_importance(spark, folder)
    total = found.agg(F.sum("importance")).scalar()
    return found.select(
        "feature", F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one")
    )


@query("top_importance_checks", "SELECT CAST(3 AS BIGINT) AS kept, TRUE AS are_the_largest")
def tree_top_checks(spark, folder):
    """Three rows, none of them smaller than one left out."""
    everything = write_table(tree_importance(spark, folder), fresh_path(spark, "importance"))
    top = top_rows(everything, "importance", "feature", 3)
    left = everything.join(top.select("feature"), "feature", "left_anti").agg(F.max("importance")).scalar()
    return top.agg(
        F.count(F.lit(1)).alias("kept"), F.coalesce(F.min("importance") >= left, F.lit(True)).alias("are_the_largest")
    )


@query("importance_csv_checks", f"SELECT CAST({len(FEATURES)} AS BIGINT) AS written, CAST(0 AS BIGINT) AS lost")
def importance_csv_checks(spark, folder):
    """The artefact reads back as the table that it was written from."""
    table = write_table(tree_importance(spark, folder), fresh_path(spark, "importance"))
    back = write_csv(table, fresh_path(spark, "importance-csv"))
    return back.agg(F.count(F.lit(1)).alias("written"), F.lit(table.exceptAll(back).count()).cast("long").alias("lost"))


@query(
    "csv_texts",
    """
    SELECT CAST(7 AS BIGINT) AS part, ' p' || chr(10) || '"q", ' || p_brand || ' ' AS p_brand, CAST(NULL AS VARCHAR) AS missing, '' AS empty, count(*) AS n
    FROM part GROUP BY p_brand
    """,
)
def csv_texts(spark, folder):
    """Blanks, line ends, quotes, NULL and the empty text survive the round trip."""
    parts = fixture(spark, folder, "part", ["p_brand"]).groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))
    rows = parts.select(
        F.lit(7).cast("long").alias("part"), F.concat(F.lit(' p\n"q", '), "p_brand", F.lit(" ")).alias("p_brand"),
        F.lit(None).cast("string").alias("missing"), F.lit("").alias("empty"), "n",
    )
    return write_csv(rows, fresh_path(spark, "texts"))


@query(
    "score_saved_model",
    "SELECT count(*) AS scored, TRUE AS same_scores, 'champion' AS alias FROM lineitem",
)
def score_saved_model(spark, folder):
    """A model saved by one job, found by its alias in the registration log, loaded and applied by another."""
    rows = line_trainable(spark, folder)
    model = _model(spark, folder)
    path = save_model(model, fresh_path(spark, "model"))
    log = write_table(
        spark.createDataFrame([("m", "champion", "1", "2024-01-01", path)], "model_name string, alias string, version string, registered_at string, path string"),
        fresh_path(spark, "registrations"),
    )
    found = log.where("alias = 'champion'").select("path").first()["path"]
    kept = ["l_orderkey", "l_quantity", "l_extendedprice"]
    again = score_model(load_model(found), rows, FEATURES, "label", kept)
    lost = score_model(model, rows, FEATURES, "label", kept).exceptAll(again).count()
    return again.agg(F.count(F.lit(1)).alias("scored"), F.lit(lost == 0).alias("same_scores"), F.lit("champion").alias("alias"))
