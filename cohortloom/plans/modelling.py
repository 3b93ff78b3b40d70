"""Train, score, evaluate and gate one run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.classifier import (
    BoostingSettings,
    score_model,
    train_boosted_trees,
    training_set,
)
from cohortloom.operators.evaluation import balanced_weight, run_record
from cohortloom.operators.lifecycle import MINIMUMS, gate_events


def train_and_score(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    split: str,
    settings: BoostingSettings = BoostingSettings(),
    passthrough: Sequence[str] = (),
    partitions: int | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on the train rows with balanced weights; score the others."""
    train = training_set(df, features, label, split=split)
    weighted = balanced_weight(train, label)
    model = train_boosted_trees(
        weighted, features, label, "sample_weight", settings, partitions
    )
    held_out = df.where(F.col(split) != "train")
    return model, score_model(model, held_out, features, label, passthrough, raw="probability")


def evaluate_run(
    scored: DataFrame, run_id: str, environment: str, created_at: Column, ranges: int | None = None
) -> DataFrame:
    """The run-log row of a scored hold-out."""
    return run_record(
        scored,
        "actual_label",
        "prediction",
        "probability",
        {"run_id": run_id, "environment": environment},
        created_at,
        ranges,
    )


def gate_run(
    run: DataFrame, at: Column, version: Column, minimums: Mapping[str, float] = MINIMUMS
) -> DataFrame:
    """The status event that follows from the run's metrics."""
    return gate_events(run, "run_id", at, version, minimums)
