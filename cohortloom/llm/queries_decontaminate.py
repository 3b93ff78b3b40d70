"""Query 9: benchmark items in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.decontaminate import find_leaks
from cohortloom.llm.registry import query, table


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "row.doc_id", (F.size("hits") > 0).alias("contaminated"), F.size("hits").cast("long").alias("n_items"),
        F.array_join(F.transform("hits", lambda h: h["item"]), ",").alias("items"), F.array_max(F.transform("hits", lambda h: h["score"])).alias("best_score"),
    )
