import pytest
from pyspark.sql import functions as F

from cohortloom.operators.classifier import (
    BoostingSettings,
    feature_importance,
    score_model,
    train_boosted_trees,
    training_curve,
    training_set,
)
from cohortloom.operators.evaluation import balanced_weight, classification_metrics, run_record
from cohortloom.session import shared_folder
from cohortloom.plans.modelling import evaluate_run, gate_run, train_and_score


def test_balanced_weights_even_out_the_classes(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2 + [(None,), (5,)], "y int")
    got = balanced_weight(df, "y").groupBy("y").agg(F.sum("sample_weight").alias("s"), F.max("sample_weight").alias("w"))
    rows = {r.y: (r.s, r.w) for r in got.collect()}
    assert rows[0] == pytest.approx((4.0, 8 / 12)) and rows[1] == pytest.approx((4.0, 2.0))
    assert rows[None] == (None, None) and rows[5] == (None, None)


def test_single_class_weighs_one(spark):
    df = spark.createDataFrame([(1,)] * 3, "y int")
    assert {r.sample_weight for r in balanced_weight(df, "y").collect()} == {1.0}


def test_weighting_does_not_shuffle_the_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("y"))
    plan = balanced_weight(df, "y")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "hashpartitioning" not in plan


def test_metrics_without_positives_are_zero(spark):
    row = classification_metrics(spark.createDataFrame([(0, 0), (0, 0)], "y int, p int"), "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (1.0, 0.0, 0.0, 0.0)


def test_run_record_agrees_with_the_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 1, 0.6), (0, 0, 0.1)], "y int, p int, s double")
    run = run_record(df, "y", "p", "s", {"run_id": "r"}, F.lit("t")).first()
    row = classification_metrics(df, "y", "p").first()
    for name in ("accuracy", "precision", "recall", "f1_score"):
        assert run[name] == row[name]
    assert run.roc_auc == 0.75 and run.status == "trained" and run.model_version is None


SETTINGS = BoostingSettings(trees=8, depth=3, learning_rate=0.3, feature_share=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    data = spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 1000.0).alias("noise"),
        F.when(F.col("id") % 5 < 4, "train").otherwise("validation").alias("data_split"),
        F.col("id").alias("key"),
    )
    return data.withColumn("y", (F.col("a") > 0.7).cast("int"))


def test_training_learns_scores_and_passes_the_gate(spark, rows):
    model, scored = train_and_score(rows, ["a", "noise"], "y", "data_split", SETTINGS, ["key"])
    assert scored.count() == rows.where("data_split <> 'train'").count()
    run = evaluate_run(scored, "run-1", "dev", F.lit("2024-01-01"))
    row = run.first()
    assert row.roc_auc > 0.99 and row.f1_score > 0.95
    event = gate_run(run, F.lit("2024-01-02"), F.lit("3")).first()
    assert (event.status, event.model_version) == ("registered", "3")
    weights = {r.feature: r.importance for r in feature_importance(spark, model, ["a", "noise"]).collect()}
    assert weights["a"] > 0.9 and sum(weights.values()) == pytest.approx(1.0)


def test_each_tree_lowers_the_loss_and_long_runs_are_checkpointed(spark, rows):
    train = training_set(rows, ["a", "noise"], "y", split="data_split")
    settings = BoostingSettings(trees=12, depth=2, learning_rate=0.3, row_share=1.0, feature_share=1.0)
    model = train_boosted_trees(train, ["a", "noise"], "y", settings=settings)
    curve = [r.loss for r in training_curve(model, rows, ["a", "noise"], "y").orderBy("tree_count").collect()]
    assert len(curve) == 12 and curve[-1] < curve[0] / 2
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + shared_folder(spark))


def test_scoring_columns_are_consistent(spark, rows):
    train = training_set(rows, ["a"], "y", split="data_split")
    model = train_boosted_trees(train, ["a"], "y", settings=SETTINGS)
    scored = score_model(model, rows, ["a"], "y", ["a", "key"], names=("no", "yes")).cache()
    assert scored.columns == ["a", "key", "prediction", "prediction_prob", "prediction_label", "confidence", "actual_label", "is_correct"]
    assert scored.where("confidence < 0.5 or (prediction = 1) <> (prediction_label = 'yes')").isEmpty()
    assert scored.where("is_correct <> (prediction = actual_label)").isEmpty()
    unlabelled = score_model(model, rows.drop("y"), ["a"], None, ["key"])
    assert unlabelled.columns == ["key", "prediction", "prediction_prob", "prediction_label", "confidence"]


def test_training_is_repeatable(spark, rows):
    train = training_set(rows, ["a", "noise"], "y", split="data_split")
    first, second = (
        train_boosted_trees(train, ["a", "noise"], "y", settings=SETTINGS).stages[-1].toDebugString for _ in range(2)
    )
    assert first.split("\n", 1)[1] == second.split("\n", 1)[1]


def test_missing_features_can_be_trained_and_scored(spark, rows):
    holes = rows.withColumn("a", F.when(F.col("key") % 10 == 0, None).otherwise(F.col("a")))
    model = train_boosted_trees(training_set(holes, ["a", "noise"], "y"), ["a", "noise"], "y", settings=SETTINGS)
    scored = score_model(model, holes, ["a", "noise"], "y")
    assert scored.count() == rows.count()
    assert scored.where("prediction is null").isEmpty()
