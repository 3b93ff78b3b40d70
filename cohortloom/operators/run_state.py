"""Run states and aliases kept as compacted rows, brought up to date by new events only.

A state row holds, per run, the latest event and the latest event that set a version, each with its order.
Two state rows of a run merge to the later one of each, so states of any batches in any order,
late events included, merge to the state of all events. A batch costs its own events; reading merges one
row per batch and run, and :func:`compact_states` makes that one row per run again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.sources.published import remove_folder


def status_states(events: DataFrame, run_id: str, status: str, at: str, tie_break: str, version: Column | None = None) -> DataFrame:
    """(run_id, latest, versioned): one state row per run of the events."""
    number = F.lit(None).cast("string") if version is None else version
    return events.groupBy(run_id).agg(
        F.max(F.struct(F.col(at).alias("at"), F.col(tie_break).alias("tie"), F.col(status).alias("status"))).alias("latest"),
        F.max(F.when(number.isNotNull(), F.struct(F.col(at).alias("at"), F.col(tie_break).alias("tie"), number.alias("version")))).alias("versioned"),
    )


def merge_status_states(states: DataFrame, run_id: str) -> DataFrame:
    """One state row per run from any number of them."""
    return states.groupBy(run_id).agg(F.max("latest").alias("latest"), F.max("versioned").alias("versioned"))


def status_of_states(states: DataFrame, run_id: str) -> DataFrame:
    """(run_id, status, changed_at, model_version), as ``status_current`` gives of all events."""
    merged = merge_status_states(states, run_id)
    return merged.select(run_id, F.col("latest.status").alias("status"), F.col("latest.at").alias("changed_at"), F.col("versioned.version").alias("model_version"))


def alias_states(registrations: DataFrame, model: str, version: str, at: str, tie_break: str) -> DataFrame:
    """(model, first, newest, versions): one state row per model of the registrations."""
    entry = F.struct(F.col(at).alias("at"), F.col(tie_break).alias("tie"), F.col(version).alias("version"))
    return registrations.groupBy(model).agg(F.min(entry).alias("first"), F.max(entry).alias("newest"), F.count(F.lit(1)).alias("versions"))


def merge_alias_states(states: DataFrame, model: str) -> DataFrame:
    return states.groupBy(model).agg(F.min("first").alias("first"), F.max("newest").alias("newest"), F.sum("versions").alias("versions"))


def aliases_of_states(states: DataFrame, model: str) -> DataFrame:
    """(model, champion, baseline, challenger, versions), as ``alias_resolution`` gives of all registrations."""
    merged = merge_alias_states(states, model)
    champion = F.col("first.version")
    return merged.select(
        model, champion.alias("champion"), champion.alias("baseline"), F.when(F.col("versions") > 1, F.col("newest.version")).alias("challenger"), "versions"
    )


def add_states(states: DataFrame, path: str, batch: int) -> None:
    """Keep the states of one batch of events; a batch that is repeated replaces itself, so it counts once."""
    states.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def kept_states(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The state rows of all batches, in the columns of ``like``; none before the first batch."""
    try:
        return spark.read.schema(like.schema).parquet(path).select(*like.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def compact_states(spark: SparkSession, path: str, merged: DataFrame, upto: int, target: str) -> None:
    """Write the merge of the batches up to ``upto`` as that batch of ``target``, which takes later batches; then ``path`` can go.

    ``merged`` is the merge of ``kept_states(spark, path, ...)``. The old folder is removed once the new one is whole.
    """
    add_states(merged, target, upto)
    remove_folder(spark, path)
