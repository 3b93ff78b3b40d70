"""Mix sources to target weights by repeating documents.

Sizes are aggregated per source, targets follow the weights up to a largest repetition, and each
document is emitted floor(rate) times plus one copy decided by a coin seeded with its id, whose
probability is the rate's fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import own, stored

#: Most sources whose targets are broadcast; beyond, rows and targets meet in a shuffle.
BROADCAST_SOURCES = 100_000


def targets(sizes: DataFrame, weights: Sequence[float], budget: float, most: float) -> DataFrame:
    """Target of each source: (``source``, ``source_size``) gains ``target`` and ``rate``.

    Sources in code-point order, null last, take the weights in turn and share ``budget`` times all
    sizes. A target stops at ``most`` times its source's size and the excess goes to the others by
    weight until none is above. This is solved in closed form: in the order of limit over weight the
    capped sources come first, so running sums give the share of a weight at which the rest stands.
    The frame has one row per source; only that goes through the unpartitioned windows. An empty
    frame gives none, and a source of size 0 the target and rate 0.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * float(most)
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    below, rest = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * float(budget) - F.coalesce(F.sum(limit).over(below), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = weighted.withColumn("level", level)
    # past the first source that stands, more limits are taken off and the share only falls
    stands = F.max(F.when(F.col("level") <= limit / F.col("weight"), F.col("level"))).over(everything)
    target = F.least(limit, F.coalesce(stands * F.col("weight"), limit))
    return leveled.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies(rate: Column, doc_id: Column, seed: str) -> Column:
    """floor(rate), and one more if the coin of this id and seed, in [0, 1), falls below the fraction.

    Rows of the same id toss the same coin; a null id counts as the text ``null``.
    """
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    coin = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / float(2**52)
    return (F.floor(rate) + F.when(coin < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def plan_mix(
    docs: DataFrame, size: Column, weights: Sequence[float] = (5, 2, 1), budget: float = 1.5, most: float = 2.0,
    seed: str = "mix", id_column: str = "doc_id", source_column: str = "source",
) -> DataFrame:
    """Each row as the struct ``row``, with ``size``, ``source_size``, ``target`` and ``copies``.

    ``size`` is an expression over ``docs``; null counts as 0. A null source is a source. Repeated
    rows are rows of their own. No document appears more than ``most`` times.
    """
    sized = docs.select(F.struct("*").alias("row"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    source = F.col(f"row.`{source_column}`")
    # only names and sizes feed the sums, the whole rows meet them once
    sizes = docs.select(F.col(source_column).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sizes, weights, budget, most), "targets")
    if goals.count() <= BROADCAST_SOURCES:  # the texts stay where they are read
        goals = F.broadcast(goals)
    name = own("source")
    joined = sized.join(goals.withColumnRenamed("source", name), source.eqNullSafe(F.col(name)), "left")
    return joined.select("row", "size", "source_size", "target", copies(F.col("rate"), F.col(f"row.`{id_column}`"), seed).alias("copies"))


def mix(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mixed rows: each as often as ``plan_mix`` says, with the columns of ``docs``."""
    planned = plan_mix(docs, size, **options).where("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
