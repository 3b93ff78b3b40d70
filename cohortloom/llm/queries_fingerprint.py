"""Query 3: winnowing fingerprints of documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.fingerprint import fingerprint_with_next, written
from cohortloom.llm.registry import query, table


@query("op3_fingerprint")
def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("kept"), F.col("places")).alias("fingerprint"),
        written(F.col("edited_kept"), F.col("edited_places")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
