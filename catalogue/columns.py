"""Projections, filters, casts, conformance and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import num, query
from cohortloom.operators.columns import (
    cast_columns,
    cohort_filter,
    conform,
    drop_duplicate_rows,
    drop_missing,
    range_filter,
    tag,
)
from cohortloom.operators.quality import (
    clean_report,
    duplicate_count,
    null_counts,
    quality_issues,
    range_profile,
)
from cohortloom.plans.medallion import CleaningRules, clean_table
from cohortloom.sources.tables import fixture

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BOUNDS = {
    "l_quantity": (5, 45),
    "l_extendedprice": (2000, 90000),
    "l_discount": (0.01, 0.09),
    "l_tax": (0.0, 0.07),
}
IN_BOUNDS = " AND ".join(f"{c} BETWEEN {num(float(a))} AND {num(float(b))}" for c, (a, b) in BOUNDS.items())


@query("select_features", f"SELECT {', '.join(MEASURES)} FROM lineitem")
def select_features(spark, folder):
    return fixture(spark, folder, "lineitem", MEASURES)


@query("range_filter", f"SELECT l_orderkey, {', '.join(MEASURES)} FROM lineitem WHERE {IN_BOUNDS}")
def in_range_lines(spark, folder):
    return range_filter(fixture(spark, folder, "lineitem", ["l_orderkey", *MEASURES]), BOUNDS)


@query(
    "cohort_filter",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    """,
)
def urgent_closed_orders(spark, folder):
    orders = fixture(spark, folder, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return cohort_filter(orders, o_orderstatus="F", o_orderpriority="1-URGENT")


def _lines_with_gaps(spark, folder, columns):
    """Lines whose zero discounts count as missing."""
    lines = fixture(spark, folder, "lineitem", columns)
    return lines.select(
        *[F.nullif(c, F.lit(0.0)).alias(c) if c == "l_discount" else F.col(c) for c in columns]
    )


GAP_SQL = "nullif(l_discount, 0) AS l_discount"


@query(
    "dropna_required",
    f"""
    WITH g AS (SELECT l_orderkey, l_quantity, {GAP_SQL} FROM lineitem)
    SELECT * FROM g WHERE l_discount IS NOT NULL AND l_quantity IS NOT NULL
    """,
)
def complete_lines(spark, folder):
    lines = _lines_with_gaps(spark, folder, ["l_orderkey", "l_quantity", "l_discount"])
    return drop_missing(lines, ["l_quantity", "l_discount"])


@query("dedup_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct_documents(spark, folder):
    return drop_duplicate_rows(fixture(spark, folder, "documents", ["text", "lang"]))


@query(
    "dedup_by_key",
    """
    SELECT text, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source
    FROM documents GROUP BY text
    """,
)
def first_copy(spark, folder):
    documents = fixture(spark, folder, "documents", ["text", "doc_id", "lang", "source"])
    return drop_duplicate_rows(documents, ["text"], [F.col("doc_id")])


@query(
    "tagged",
    "SELECT c_custkey, c_acctbal, TRUE AS processed, 'v1.0' AS table_version FROM customer",
)
def tagged_customers(spark, folder):
    return tag(
        fixture(spark, folder, "customer", ["c_custkey", "c_acctbal"]), processed=True, table_version="v1.0"
    )


@query(
    "typed_cast",
    """
    SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
           TRY_CAST(event_type AS INTEGER) AS event_type, CAST(user_id AS INTEGER) AS user_id
    FROM events
    """,
)
def typed_events(spark, folder):
    events = fixture(spark, folder, "events", ["event_id", "props", "event_type", "user_id"])
    texts = events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", "user_id"
    )
    return cast_columns(texts, {"k": "int", "event_type": "int", "user_id": "int"}, strict=False)


@query(
    "conform_schema",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
           CAST(NULL AS DOUBLE) AS l_score, l_returnflag
    FROM lineitem
    """,
)
def conformed_lines(spark, folder):
    target = spark.createDataFrame(
        [], "l_orderkey string, l_quantity int, l_score double, l_returnflag string"
    ).schema
    lines = fixture(spark, folder, "lineitem", ["l_returnflag", "l_orderkey", "l_quantity", "l_tax"])
    return conform(lines, target)


PROFILED = ["l_orderkey", "l_quantity", "l_discount", "l_returnflag"]


@query(
    "null_counts",
    f"""
    WITH g AS (SELECT l_orderkey, l_quantity, {GAP_SQL}, l_returnflag FROM lineitem)
    SELECT column_name, nulls FROM (
      SELECT 'l_orderkey' AS column_name, count(*) - count(l_orderkey) AS nulls FROM g
      UNION ALL SELECT 'l_quantity', count(*) - count(l_quantity) FROM g
      UNION ALL SELECT 'l_discount', count(*) - count(l_discount) FROM g
      UNION ALL SELECT 'l_returnflag', count(*) - count(l_returnflag) FROM g)
    """,
)
def line_null_counts(spark, folder):
    return null_counts(_lines_with_gaps(spark, folder, PROFILED))


@query(
    "dup_count",
    "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS duplicates FROM documents",
)
def document_duplicates(spark, folder):
    return duplicate_count(fixture(spark, folder, "documents", ["text", "lang"]), digest=True)


@query(
    "dup_count_lines",
    """
    SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_quantity, l_discount, l_shipdate FROM lineitem))
           AS duplicates FROM lineitem
    """,
)
def line_duplicates(spark, folder):
    return duplicate_count(fixture(spark, folder, "lineitem", ["l_orderkey", "l_quantity", "l_discount", "l_shipdate"]))


@query(
    "range_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) AS min_value, max({c}) AS max_value FROM lineitem" for c in MEASURES
    ),
)
def line_ranges(spark, folder):
    return range_profile(fixture(spark, folder, "lineitem", MEASURES), MEASURES)


THIN = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
THIN_SQL = f"SELECT l_quantity, {GAP_SQL}, l_tax, l_returnflag FROM lineitem"


@query(
    "quality_issues",
    f"""
    WITH g AS ({THIN_SQL}),
    f AS (
      SELECT 'nulls:l_discount' AS check_name, count(*) - count(l_discount) AS affected_rows,
             'nulls in l_discount: ' AS prefix FROM g
      UNION ALL SELECT 'nulls:l_quantity', count(*) - count(l_quantity), 'nulls in l_quantity: ' FROM g
      UNION ALL SELECT 'nulls:l_tax', count(*) - count(l_tax), 'nulls in l_tax: ' FROM g
      UNION ALL SELECT 'nulls:l_returnflag', count(*) - count(l_returnflag), 'nulls in l_returnflag: ' FROM g
      UNION ALL SELECT 'duplicates', (SELECT count(*) FROM g) - count(*), 'duplicate rows found: '
                FROM (SELECT DISTINCT * FROM g))
    SELECT check_name, affected_rows, prefix || CAST(affected_rows AS VARCHAR) AS message
    FROM f WHERE affected_rows > 0
    """,
)
def line_issues(spark, folder):
    return quality_issues(_lines_with_gaps(spark, folder, THIN))


THIN_BOUNDS = {"l_quantity": (5, 45), "l_tax": (0.0, 0.07)}


@query(
    "clean_report",
    f"""
    WITH g AS ({THIN_SQL}), d AS (SELECT DISTINCT * FROM g),
    o AS (SELECT CASE WHEN l_discount IS NULL OR l_quantity IS NULL THEN 'missing'
                      WHEN l_quantity BETWEEN 5 AND 45 AND l_tax BETWEEN 0.0 AND {num(0.07)} THEN 'kept'
                      ELSE 'out_of_range' END AS outcome FROM d)
    SELECT 'rows_in' AS outcome, count(*) AS row_count FROM g
    UNION ALL SELECT 'duplicate', (SELECT count(*) FROM g) - count(*) FROM d
    UNION ALL SELECT 'missing', count(*) FROM o WHERE outcome = 'missing'
    UNION ALL SELECT 'out_of_range', count(*) FROM o WHERE outcome = 'out_of_range'
    UNION ALL SELECT 'kept', count(*) FROM o WHERE outcome = 'kept'
    """,
)
def line_clean_report(spark, folder):
    return clean_report(
        _lines_with_gaps(spark, folder, THIN), ["l_quantity", "l_discount"], THIN_BOUNDS
    )


CLEAN_COLUMNS = ["l_orderkey", "l_linenumber", *MEASURES, "l_returnflag"]


@query(
    "clean_table",
    f"""
    WITH g AS (SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, l_extendedprice, {GAP_SQL}, l_tax,
                      ' ' || lower(l_returnflag) AS l_returnflag FROM lineitem)
    SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, l_discount,
           l_tax, upper(trim(l_returnflag)) AS l_returnflag, TRUE AS processed, 'v1.0' AS table_version
    FROM g WHERE l_discount IS NOT NULL AND l_quantity IS NOT NULL AND {IN_BOUNDS}
    """,
)
def cleaned_lines(spark, folder):
    raw = _lines_with_gaps(spark, folder, CLEAN_COLUMNS).select(
        *CLEAN_COLUMNS[:-1], F.concat(F.lit(" "), F.lower("l_returnflag")).alias("l_returnflag")
    )
    rules = CleaningRules(
        required=["l_quantity", "l_discount"],
        bounds=BOUNDS,
        types={"l_quantity": "int"},
        categories=["l_returnflag"],
        tags={"processed": True, "table_version": "v1.0"},
    )
    return clean_table(raw, rules)
