"""Query 8: log probabilities of all documents under a Katz backoff model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.katz import score_texts
from cohortloom.llm.registry import query, table
from cohortloom.llm.text import in_fold


@query("op8_katz")
def op8_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 5, 1)
    scored = score_texts(docs.withColumn("held_out", held_out), ~F.col("held_out"), keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
