"""Query 13: collocations of all documents, per language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm.collocations import collocations
from cohortloom.llm.registry import query, table

COLLOCATIONS_SQL = r"""
WITH t AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), p AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)
), o AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p
), g AS (
    SELECT lang, w[i:i + m - 1] AS words, m, count(*) AS f FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL
), s AS (
    SELECT lang, sum(f)::BIGINT AS n FROM g WHERE m = 1 GROUP BY lang
), c AS (
    SELECT lang, words, m, f AS a FROM g WHERE m >= 2 AND f >= 100
), k AS (
    SELECT c.*, x.f AS l, y.f AS r, s.n, k, ((1000::HUGEINT * c.a * s.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN s USING (lang)
    JOIN g x ON x.lang = c.lang AND x.words = c.words[1:c.k] JOIN g y ON y.lang = c.lang AND y.words = c.words[c.k + 1:c.m]
), b AS (
    SELECT lang, words, a, arg_min(struct_pack(l := l, r := r, n := n, score := score), (score, k)) AS best FROM k GROUP BY lang, words, a
), q AS (
    SELECT lang, words[i:j] AS words, max(a) AS longer
    FROM (SELECT *, unnest(range(i + 1, m + 1)) AS j FROM (SELECT *, unnest(range(1, m)) AS i FROM c)) WHERE j - i + 1 < m GROUP BY ALL
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY best.score DESC, a DESC, array_to_string(words, ' ')) AS rank,
        array_to_string(words, ' ') AS phrase, a, best.l AS l, best.r AS r, best.n AS n, best.score AS score
    FROM b WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.lang = b.lang AND q.words = b.words AND q.longer >= b.a)
) WHERE rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
