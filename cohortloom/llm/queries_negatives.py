"""Query 12: hard negatives of the embeddings' anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.negatives import hard_negatives
from cohortloom.llm.registry import query, table

NEGATIVES_SQL = r"""
WITH e AS (
    SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
        coalesce(list_sum(list_transform(range(1, least(len(a.v), len(c.v)) + 1), lambda i: a.v[i] * c.v[i])), 0)::BIGINT AS score
    FROM e a, e c WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor, anchor_id, id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
    FROM s WHERE same AND id <> anchor_id
), r AS (
    SELECT p.*, s.id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.id) AS rank
    FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WHERE place <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""


@query("op12_negatives", NEGATIVES_SQL)
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)
