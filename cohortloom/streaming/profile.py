"""Profile of a feature per time window, as batch and as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def window_profile(
    df: DataFrame, at: str, group: str, value: str, every: str = "60 minutes"
) -> DataFrame:
    """(window_start, group, row_count, avg, min, max) per window and group."""
    return (
        df.groupBy(F.window(at, every).alias("w"), group)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.avg(value).alias("avg_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
        )
        .select(F.col("w.start").alias("window_start"), group, "row_count", "avg_value", "min_value", "max_value")
    )


def window_profile_stream(
    stream: DataFrame, at: str, group: str, value: str, every: str = "60 minutes", delay: str = "10 minutes"
) -> DataFrame:
    """The same profile of a stream: a window is given out once the watermark passes its end.

    The state is one row per open window and group. Rows later than ``delay``
    behind the newest one are left out.
    """
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    return window_profile(timed, at, group, value, every)


def drain_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all that is there, append the finished windows, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


PARTIAL = "window_start timestamp, window_end timestamp, `{group}` string, n long, n_values long, total double, min_value double, max_value double, newest timestamp, batch long"


def write_partials(rows: DataFrame, batch: int, at: str, group: str, value: str, path: str, every: str = "60 minutes") -> None:
    """The partial sums of one micro-batch, in a folder of its own: a batch that is repeated replaces itself."""
    timed = rows.select(F.col(at).cast("timestamp").alias("at"), F.col(group).cast("string").alias(group), F.col(value).cast("double").alias("value"))
    sums = timed.groupBy(F.window("at", every).alias("w"), group).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"), F.sum("value").alias("total"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"), F.max("at").alias("newest"),
    )
    partial = sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), group, "n", "n_values", "total", "min_value", "max_value", "newest")
    partial.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def keep_partials(
    stream: DataFrame, at: str, group: str, value: str, path: str, checkpoint: str, every: str = "60 minutes", **trigger
) -> None:
    """Process a stream into partial sums by micro-batch, window and group; by default all that is there, then stop.

    There is no state to lose or to bound and nothing is ever too late: what a window has is in the table from its
    first batch on, and :func:`merged_profile` adds it up, open windows included. ``trigger`` is that of a stream
    writer, such as ``processingTime="1 minute"`` for a run without end.
    """
    query = (
        stream.writeStream.foreachBatch(lambda rows, batch: write_partials(rows, batch, at, group, value, path, every))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if not trigger:
        query.awaitTermination()


def merged_profile(spark: SparkSession, path: str, group: str, delay: str = "10 minutes") -> DataFrame:
    """(window_start, group, row_count, avg_value, min_value, max_value, late_rows, is_open) of all batches so far.

    The figures are those of the rows as one batch. A window is open until the newest row is ``delay``
    past its end. Rows that came in a batch after the one that closed their window are in
    the figures and counted in ``late_rows``.
    """
    partials = spark.read.schema(PARTIAL.format(group=group)).parquet(path)
    seen = partials.groupBy("batch").agg(F.max("newest").alias("newest"))
    # one row per batch; each learns how far the batches before it had come
    before = Window.partitionBy(F.lit(0)).orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    reached = seen.select("batch", F.max("newest").over(before).alias("reached"))
    wait = F.expr(f"INTERVAL {delay}")
    late = F.coalesce(F.col("window_end") + wait <= F.col("reached"), F.lit(False))
    newest = seen.agg(F.max("newest")).scalar()
    return (
        partials.join(reached, "batch")
        .groupBy("window_start", "window_end", group)
        .agg(
            F.sum("n").alias("row_count"),
            F.try_divide(F.sum("total"), F.sum("n_values")).alias("avg_value"),
            F.min("min_value").alias("min_value"),
            F.max("max_value").alias("max_value"),
            F.sum(F.when(late, F.col("n")).otherwise(0)).alias("late_rows"),
        )
        .select("window_start", group, "row_count", "avg_value", "min_value", "max_value", "late_rows", (F.col("window_end") + wait > newest).alias("is_open"))
    )
