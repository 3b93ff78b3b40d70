"""Connected components of a graph given as links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import stored


def _least(links: DataFrame) -> DataFrame:
    """Each node with the smallest of its neighbours and itself."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``links`` (columns ``a, b``).

    Large-star and small-star steps in turn, until every link leads to a component's smallest node:
    their number grows with the logarithm of the longest chain. Each round is written to the shared
    folder, so that lost executors cost one round. Loops and repeated links do no harm; no link, no row.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # repeated links do no harm here: the second step leaves one of each
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.where("u <> v").distinct(), "links")
        # stars only: what links lead to leads nowhere itself
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(True).alias("leads")), F.struct(F.col("v").alias("node"), F.lit(False).alias("leads")))).alias("end"))
        if not ends.groupBy("end.node").agg(F.max("end.leads").alias("leads"), F.min("end.leads").alias("only")).where("leads AND NOT only").count():
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def joined(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``node, component`` of ``found`` once more ``links`` are added: only what lies between components is looked at."""
    place = found.select(F.col("node").alias("at"), F.col("component").alias("of"))
    ends = links.join(place, F.col("a") == F.col("at"), "left").select(F.coalesce("of", "a").alias("x"), "b")
    ends = ends.join(place, F.col("b") == F.col("at"), "left").select(F.col("x").alias("a"), F.coalesce("of", "b").alias("b")).where("a <> b").distinct()
    merged = components(ends)
    # nodes that had no link before are components of their own
    nodes = found.unionByName(merged.select("node", F.col("node").alias("component")).join(found.select("node"), "node", "left_anti"))
    known = merged.select(F.col("node").alias("component"), F.col("component").alias("now"))
    return nodes.join(known, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
