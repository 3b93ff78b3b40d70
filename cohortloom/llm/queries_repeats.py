"""Query 2: passages that repeat, removed from every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table
from cohortloom.llm.repeats import remove_repeats


@query("op2_repeats")
def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and ``text``: what is left, where a cut character becomes U+FFFD."""
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("spans", "kept")
