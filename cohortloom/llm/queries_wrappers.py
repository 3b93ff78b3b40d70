"""Query 1: main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table
from cohortloom.llm.wrappers import extract_main_text


@query("op1_main_text")
def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
