"""Queries 5 and 10: language and toxicity of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.language import fit_languages, predict_language, read_vocabulary
from cohortloom.llm.registry import query, table
from cohortloom.llm.text import in_fold
from cohortloom.llm.toxicity import fit_toxicity, score_toxicity

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
TOXIC_FROM = 0.7


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(~in_fold(F.col("doc_id"), 5, 0) & F.col("doc_id").isNotNull()), read_vocabulary(VOCABULARY))
    predicted = predict_language(docs.select("doc_id", "text"), model)
    doc_id = F.col("row.doc_id")
    return predicted.select(doc_id.alias("doc_id"), in_fold(doc_id, 5, 0).alias("held_out"), "lang_pred", "score")


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~in_fold(F.col("doc_id"), 3, 1))
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    doc_id = F.col("row.doc_id")
    return scored.select(
        doc_id.alias("doc_id"), in_fold(doc_id, 3, 1).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    )
