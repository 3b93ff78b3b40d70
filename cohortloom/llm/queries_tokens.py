"""Query 11: token counts of all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.registry import query, table
from cohortloom.llm.token_prefix import token_counts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024


@query("op11_tokens")
def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER, LIMIT)
    return counted.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        "chars_within",
    )
