"""Query 7: sources mixed to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.mixing import plan_mix
from cohortloom.llm.registry import query, table
from cohortloom.llm.text import word_count

MIX_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
        source_size * 2.0::DOUBLE AS cap
    FROM s
), l AS (
    SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
), t AS (
    SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM l WHERE level <= cap / weight) * weight, cap)) AS target
    FROM l
), r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        ('0x' || md5(coalesce(d.doc_id::VARCHAR, 'null') || ':mix')[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS coin
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


@query("op7_mixing", MIX_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    planned = plan_mix(docs, F.col("size"))
    return planned.select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )
