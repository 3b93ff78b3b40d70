"""From raw documents to a training mix: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.decontaminate import decontaminate
from cohortloom.llm.language import known_languages, read_vocabulary
from cohortloom.llm.mixing import mix
from cohortloom.llm.neardup import keep_one
from cohortloom.llm.privacy import sanitise
from cohortloom.llm.registry import table
from cohortloom.llm.text import stored, word_count

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labels teach; null texts, those without letters, other languages and junk go.

    Repeated rows each stay or go alike; an empty table stays empty.
    """
    return known_languages(docs, read_vocabulary(VOCABULARY))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id.

    Null and empty texts are near-duplicates of nothing and stay; of rows that share an id one stays, rows without an id all stay.
    """
    return keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows each stay or go alike."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and what discloses it replaced; ``n_chars`` follows the text.

    Null texts stay null, repeated rows stay repeated; an empty table stays empty.
    """
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until the sources have their target weights.

    A null source is a source; null and empty texts have no words, so they neither fill nor need a target.
    """
    return mix(docs, word_count(F.col("text")))


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", benchmark_leaks),
    ("personal_data", personal_data),
    ("mixing", source_mix),
]

#: Language identification has no SQL form; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
