"""Samples whose bound is a bound: exactly so many rows, the same in every run and partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACES = 2**52


def key_place(key: Sequence[str], seed: int = 0) -> Column:
    """A whole number below 2**52 from a digest of the key: alike in any engine, evenly spread."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(name).cast("string"), F.lit("\\N")) for name in key])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def exact_sample(
    rows: DataFrame, key: Sequence[str], size: int, by: Sequence[str] = (), seed: int = 0, slack: float = 6.0
) -> DataFrame:
    """The ``size`` rows with the smallest key places, of the table or of each group of ``by``; all rows of smaller groups.

    The places are spread evenly, so the limit under which a group has ``size`` rows is
    known from its row count up to chance; it is taken ``slack`` standard deviations higher. Only rows
    under their group's limit are ranked, and the ranking cuts them exactly. Where a limit
    turns out too low, as with repeated keys, it is raised until it is not. The ranking sorts about
    ``size`` rows per group in one task each; equal places go by the whole row, so the sample
    depends on the rows alone. Rows that are equal in all columns are interchangeable.
    """
    spark, place, group = rows.sparkSession, "__place", [f"__by_{i}" for i in range(len(by))]
    marked = rows.select("*", key_place(key, seed).alias(place), *[F.col(c).alias(g) for c, g in zip(by, group)])
    counts = marked.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).collect()
    limits = {tuple(r[g] for g in group): _limit(size, r["n"], slack) for r in counts}
    wanted = {tuple(r[g] for g in group): min(size, r["n"]) for r in counts}
    kind = ", ".join([*[f"`{g}` {rows.schema[c].dataType.simpleString()}" for c, g in zip(by, group)], "`__limit` long"])
    while True:
        frame = F.broadcast(spark.createDataFrame([(*k, v) for k, v in limits.items()], kind))
        same = [marked[g].eqNullSafe(frame[g]) for g in group]
        near = marked.join(frame, same, "inner") if same else marked.crossJoin(frame)
        near = near.where(F.col(place) < F.col("__limit")).select(*[marked[c] for c in marked.columns])
        held = {tuple(r[g] for g in group): r["n"] for r in near.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [k for k in limits if held.get(k, 0) < wanted[k]]
        if not short:
            break
        limits.update({k: min(PLACES, 2 * limits[k] + 1) for k in short})
    columns = [F.col(c) for c in rows.columns]
    order = [F.col(place), *[F.col(c) for c in key], *[F.to_json(F.struct(*columns))]]
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("__rank") <= size).select(*rows.columns)


def _limit(size: int, n: int, slack: float) -> int:
    expected = max(1.0, size + slack * math.sqrt(size) + slack)
    return PLACES if expected >= n else math.ceil(PLACES * expected / n)
