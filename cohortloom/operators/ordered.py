"""Exact running totals over a globally ordered column, in many small partitions.

Running sums need a total order, and a window without a partition would put all
values into one task. Here every feature is cut into value ranges:

1. ``column_summary`` finds range limits from mergeable quantile sketches. They
   only balance the work; any increasing limits give the same result. They are
   read once per call, so all parts of the plan agree on them.
2. Rows are reduced to one per (slot, value) with their counts, a slot being one
   range of one feature. The counts combine before the shuffle, so a value that
   holds a third of all rows arrives as one row per map task.
3. Slot totals, at most features x ranges rows, become offsets.
4. A window per slot adds the count of smaller values in the slot to its offset.
   Steps 3 and 4 read the same shuffle output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite_or_null
from cohortloom.session import fresh_path

# Several ranges per shuffle partition, so that hashing spreads them evenly.
RANGES_PER_PARTITION = 4
SKETCH_SLOTS = 128
# A map task's sketch stays small, because there may be very many of them and the
# errors of independent sketches cancel out; the merged sketch is as fine as the ranges.
TASK_SKETCH_SIZE = 800
MERGED_SKETCH_SIZE = 32768


@dataclass(frozen=True)
class ColumnSummary:
    """Smallest and largest finite value, and interior range limits, of a column."""

    low: float | None
    high: float | None
    splits: list[float]


def range_count(df: DataFrame, wanted: int | None = None) -> int:
    """Ranges per feature: as asked, else by the session's shuffle width."""
    if wanted is None:
        width = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        wanted = RANGES_PER_PARTITION * (int(width) if width.isdigit() else 200)
    return max(2, wanted)


def column_summary(
    df: DataFrame,
    split: Sequence[str],
    bounded: Sequence[str] = (),
    ranges: int = 8,
    sketch_slots: int = SKETCH_SLOTS,
    merged_sketch_size: int = MERGED_SKETCH_SIZE,
) -> dict[str, ColumnSummary]:
    """Bounds of all named columns, and ``ranges - 1`` limits of those in ``split``.

    One pass. Sketches merge in two levels, so no task receives the sketches of
    all map tasks. The driver gets columns x ranges numbers.
    """
    columns = list(dict.fromkeys([*split, *bounded]))
    size = max(TASK_SKETCH_SIZE, min(8 * ranges, merged_sketch_size))
    ranks = F.expr("array(" + ", ".join(f"{i / ranges!r}D" for i in range(1, ranges)) + ")")
    names = {c: f"v{i}" for i, c in enumerate(columns)}
    wide = df.select(*[finite_or_null(c).alias(v) for c, v in names.items()])
    partial = wide.groupBy((F.spark_partition_id() % sketch_slots).alias("slot")).agg(
        *[F.min(v).alias(f"{v}_low") for v in names.values()],
        *[F.max(v).alias(f"{v}_high") for v in names.values()],
        *[F.kll_sketch_agg_double(names[c], F.lit(TASK_SKETCH_SIZE)).alias(f"{names[c]}_sketch") for c in split],
    )
    row = partial.agg(
        *[F.min(f"{v}_low").alias(f"{v}_low") for v in names.values()],
        *[F.max(f"{v}_high").alias(f"{v}_high") for v in names.values()],
        *[
            F.when(
                F.min(f"{names[c]}_low").isNotNull(),
                F.kll_sketch_get_quantile_double(
                    F.kll_merge_agg_double(f"{names[c]}_sketch", F.lit(size)), ranks
                ),
            ).alias(f"{names[c]}_splits")
            for c in split
        ],
    ).first()
    return {
        c: ColumnSummary(
            row[f"{v}_low"], row[f"{v}_high"], sorted(set(row[f"{v}_splits"] or [])) if c in split else []
        )
        for c, v in names.items()
    }


def running_counts(
    df: DataFrame,
    features: Sequence[str],
    weights: Mapping[str, Column],
    splits: Mapping[str, Sequence[float]],
) -> DataFrame:
    """One row per (feature, distinct value), ready for ordered statistics.

    ``weights`` maps a name to a column of ``df``, a condition or a whole number of
    rows that a row stands for; ``splits`` are the range
    limits of each feature. The result has, for each name ``w``: ``w`` (rows
    with this value), ``w_below`` (rows with a smaller one), ``w_total`` and
    ``w_sum`` (all rows and the sum of their values, of the feature).
    ``previous_value`` is the next smaller value, NULL for the smallest. NULL,
    NaN and infinite values take no part.
    """
    names = list(weights)
    inputs = [f"v{i}" for i in range(len(features))]
    limits = [[float("-inf"), *(splits[c] or [0.0]), float("inf")] for c in features]
    stride = max(len(s) for s in limits)
    wide = df.select(
        *[finite_or_null(c).alias(v) for c, v in zip(features, inputs)],
        *[F.coalesce(weights[w].cast("long"), F.lit(0)).alias(w) for w in names],
    )
    ranged = Bucketizer(
        inputCols=inputs,
        outputCols=[f"{v}_range" for v in inputs],
        splitsArray=limits,
        handleInvalid="keep",
    ).transform(wide)
    entries = [
        F.struct((F.col(f"{v}_range").cast("int") + F.lit(i * stride)).alias("slot"), F.col(v).alias("value"))
        for i, v in enumerate(inputs)
    ]
    values = (
        ranged.select(*names, F.inline(F.array(*entries)))
        # both columns, so that the two uses below read one and the same shuffle
        .where(F.col("value").isNotNull() & F.col("slot").isNotNull())
        .groupBy("slot", "value")
        .agg(*[F.sum(w).alias(w) for w in names])
    )

    totals = values.groupBy("slot").agg(
        F.max("value").alias("last_value"),
        *[F.sum(w).alias(f"{w}_rows") for w in names],
        *[F.sum(F.col("value") * F.col(w)).alias(f"{w}_part") for w in names],
    )
    feature = F.floor(F.col("slot") / F.lit(stride)).cast("int")
    in_order = Window.partitionBy("feature").orderBy("slot")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    offsets = totals.select("*", feature.alias("feature")).select(
        F.element_at(F.array(*[F.lit(c) for c in features]), F.col("feature") + 1).alias("feature"),
        "slot",
        F.lag("last_value").over(in_order).alias("previous_last"),
        *[F.coalesce(F.sum(f"{w}_rows").over(before), F.lit(0)).alias(f"{w}_before") for w in names],
        *[F.sum(f"{w}_rows").over(whole).alias(f"{w}_total") for w in names],
        *[F.sum(f"{w}_part").over(whole).alias(f"{w}_sum") for w in names],
    )

    # one frame serves all: in value order the largest value so far is the previous one
    earlier = Window.partitionBy("slot").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    local = values.select(
        "slot",
        "value",
        F.max("value").over(earlier).alias("previous_inside"),
        *names,
        *[F.sum(w).over(earlier).alias(f"{w}_inside") for w in names],
    )
    # offsets: at most len(features) x (ranges + 1) rows; Spark broadcasts them if they are small
    return local.join(offsets, "slot").select(
        "feature",
        "value",
        F.coalesce("previous_inside", "previous_last").alias("previous_value"),
        *names,
        *[(F.coalesce(f"{w}_inside", F.lit(0)) + F.col(f"{w}_before")).alias(f"{w}_below") for w in names],
        *[F.col(f"{w}_total") for w in names],
        *[F.col(f"{w}_sum") for w in names],
    )


def running_counts_by(
    counted: DataFrame, key: str, value: str, weights: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """The same for many columns in long form: one row per (``key``, distinct value).

    ``counted`` has the weights as whole numbers, which tasks may have added up before; they are
    added up here, written once, and each key is cut into value ranges of its own. The result has for
    each weight ``w`` also ``w_below``, the sum over smaller values of the key. NULL and NaN values take
    no part. The number of keys is the caller's to bound: keys x ranges limits are broadcast.
    """
    spark = counted.sparkSession
    rows = counted.where(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(key, value).agg(*[F.sum(w).alias(w) for w in weights])
    path = fresh_path(spark, "running")
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    if ranges is None:
        ranges = max(2, -(-range_count(counted) // max(1, rows.select(key).distinct().count())))
    ranks = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    limits = rows.groupBy(key).agg(F.array_distinct(F.percentile_approx(value, ranks, 1000)).alias("limits"))
    slot = F.size(F.filter("limits", lambda limit: limit < F.col(value))).alias("slot")
    # both uses below read one and the same shuffle
    ranged = rows.join(F.broadcast(limits), key).select(key, slot, value, *weights).repartition(key, "slot")
    totals = ranged.groupBy(key, "slot").agg(*[F.sum(w).alias(f"{w}_rows") for w in weights])
    before = Window.partitionBy(key).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "slot", *[F.coalesce(F.sum(f"{w}_rows").over(before), F.lit(0)).alias(f"{w}_before") for w in weights])
    earlier = Window.partitionBy(key, "slot").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(key, "slot", value, *weights, *[F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"{w}_inside") for w in weights])
    return local.join(offsets, [key, "slot"]).select(
        key, value, *weights, *[(F.col(f"{w}_inside") + F.col(f"{w}_before")).alias(f"{w}_below") for w in weights]
    )
