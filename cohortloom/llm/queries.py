"""All queries of this subpackage and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from cohortloom.llm import (  # noqa: F401
    queries_classify,
    queries_collocations,
    queries_decontaminate,
    queries_fingerprint,
    queries_katz,
    queries_mixing,
    queries_neardup,
    queries_negatives,
    queries_privacy,
    queries_repeats,
    queries_tokens,
    queries_wrappers,
)
from cohortloom.llm.registry import ORACLES, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLES", "QUERIES"]
