"""Query 6: near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm.neardup import near_duplicates
from cohortloom.llm.registry import query, table

NEAR_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
    SELECT p.a, p.b FROM p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)
), r AS (
    SELECT doc_id, doc_id AS c FROM documents
    UNION
    SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id
), g AS (
    SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, g.c AS component_id, g.c = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN g USING (doc_id)
"""


@query("op6_near_duplicates", NEAR_SQL)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
