"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query, rounded, sql_round
from cohortloom.functions.keys import split_by_mod, surrogate_key
from cohortloom.operators.summaries import preview, table_counts
from cohortloom.session import fresh_path
from cohortloom.sources.published import append_logged, prune_versions, published_versions, read_logged, read_published, write_feature_table
from cohortloom.sources.sinks import (
    KeyViolation,
    append_conformed,
    append_evolving,
    feature_table_verify,
    key_violations,
    reference_snapshot,
    write_table,
    write_verified,
)
from cohortloom.sources.tables import fixture

LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"]
STAR = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@query(
    "scan_profile",
    f"""
    SELECT count(*) AS row_count, {sql_round('sum(l_quantity)', 2)} AS sum_quantity,
           {sql_round('avg(l_extendedprice)', 4)} AS avg_price,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    FROM lineitem
    """,
)
def scan_profile(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_quantity", "l_extendedprice", "l_shipdate"])
    profile = lines.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("l_quantity").alias("sum_quantity"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )
    return rounded(profile, {"sum_quantity": 2, "avg_price": 4})


@query("write_roundtrip", f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem")
def write_roundtrip(spark, folder):
    lines = fixture(spark, folder, "lineitem", LINE_COLUMNS)
    return write_table(lines, fresh_path(spark, "lines"))


@query(
    "partitioned_roundtrip",
    f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem WHERE l_linestatus = 'F'",
)
def partitioned_roundtrip(spark, folder):
    lines = fixture(spark, folder, "lineitem", LINE_COLUMNS)
    table = write_table(lines, fresh_path(spark, "lines-by-status"), partition_by=["l_linestatus"])
    return table.where(F.col("l_linestatus") == "F").select(*LINE_COLUMNS)


@query(
    "partitioned_rebalanced",
    """
    SELECT l_linestatus, count(*) AS row_count, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem GROUP BY l_linestatus
    """,
)
def partitioned_rebalanced(spark, folder):
    lines = fixture(spark, folder, "lineitem", LINE_COLUMNS)
    table = write_table(
        lines, fresh_path(spark, "lines-rebalanced"), partition_by=["l_linestatus"], rebalance=True
    )
    return table.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_quantity").cast("long").alias("quantity")
    )


@query(
    "append_evolve",
    """
    SELECT o_orderkey, o_custkey, o_totalprice,
           CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def append_evolve(spark, folder):
    orders = fixture(spark, folder, "orders")
    path = fresh_path(spark, "orders-evolving")
    core = ["o_orderkey", "o_custkey", "o_totalprice"]
    table = write_table(orders.where("o_orderstatus <> 'O'").select(*core), path)
    return append_evolving(
        orders.where("o_orderstatus = 'O'").select(*core, "o_orderpriority"), path, schema=table.schema
    ).select(*core, "o_orderpriority")


@query(
    "append_conform",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
)
def append_conform(spark, folder):
    orders = fixture(spark, folder, "orders")
    path = fresh_path(spark, "orders-conformed")
    write_table(
        orders.where("o_orderstatus <> 'O'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"),
        path,
    )
    loose = orders.where("o_orderstatus = 'O'").select(
        F.col("o_orderstatus"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_totalprice"),
        F.col("o_orderkey").cast("decimal(20,0)").alias("o_orderkey"),
        F.lit("x").alias("extra"),
    )
    return append_conformed(loose, path, strict=False)


@query(
    "append_conform_partitioned",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
)
def append_conform_partitioned(spark, folder):
    orders = fixture(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    path = fresh_path(spark, "orders-by-status")
    write_table(orders.where("o_orderkey % 2 = 0"), path, partition_by=["o_orderstatus"])
    loose = orders.where("o_orderkey % 2 <> 0").withColumn("o_custkey", F.col("o_custkey").cast("string"))
    return append_conformed(loose, path)


@query(
    "append_evolve_partitioned",
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus,
           CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def append_evolve_partitioned(spark, folder):
    orders = fixture(spark, folder, "orders", ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"])
    path = fresh_path(spark, "orders-evolving-by-status")
    table = write_table(orders.where("o_orderkey % 2 = 0").drop("o_orderpriority"), path, partition_by=["o_orderstatus"])
    return append_evolving(orders.where("o_orderkey % 2 <> 0"), path, schema=table.schema)


@query(
    "partitioned_types",
    """
    SELECT l_orderkey, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line_key, l_quantity
    FROM lineitem
    """,
)
def partitioned_types(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    keyed = lines.select("l_orderkey", F.lpad(F.col("l_linenumber").cast("string"), 2, "0").alias("line_key"), "l_quantity")
    return write_table(keyed, fresh_path(spark, "lines-by-key"), partition_by=["line_key"])


@query(
    "write_verified_append",
    "SELECT count(*) AS rows_written, count(*) AS rows_read, TRUE AS matches FROM orders",
)
def write_and_verify_append(spark, folder):
    orders, path = fixture(spark, folder, "orders"), fresh_path(spark, "orders-appended")
    write_table(orders.where("o_orderstatus = 'O'"), path)
    return write_verified(orders, path, mode="append")


@query(
    "write_verified",
    "SELECT count(*) AS rows_written, count(*) AS rows_read, TRUE AS matches FROM lineitem",
)
def write_and_verify(spark, folder):
    lines = fixture(spark, folder, "lineitem", LINE_COLUMNS)
    return write_verified(lines, fresh_path(spark, "lines-verified"))


FEATURES = ["o_totalprice", "is_urgent"]


def _order_features(spark, folder):
    orders = fixture(spark, folder, "orders")
    return orders.select(
        surrogate_key(orders, ["o_orderkey", "o_custkey"]).alias("feature_id"),
        "o_totalprice",
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_urgent"),
    )


@query(
    "feature_table",
    """
    SELECT sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS feature_id,
           o_totalprice, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent
    FROM orders
    """,
)
def feature_table(spark, folder):
    rows = _order_features(spark, folder)
    return write_feature_table(rows, ["feature_id"], FEATURES, fresh_path(spark, "features"))


@query(
    "feature_table_verify",
    """
    SELECT count(*) AS row_count, count(DISTINCT (o_orderkey, o_custkey)) AS distinct_keys,
           CAST(2 AS BIGINT) AS feature_count,
           count(*) = count(DISTINCT (o_orderkey, o_custkey)) AS key_is_unique
    FROM orders
    """,
)
def feature_table_verified(spark, folder):
    return feature_table_verify(feature_table(spark, folder), ["feature_id"])


@query(
    "feature_table_verify_nulls",
    """
    SELECT count(*) AS row_count, count(DISTINCT nullif(l_returnflag, 'N')) AS distinct_keys,
           CAST(1 AS BIGINT) AS feature_count, FALSE AS key_is_unique
    FROM lineitem
    """,
)
def feature_table_null_keys(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_returnflag", "l_quantity"])
    keyed = lines.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"), "l_quantity")
    return feature_table_verify(write_table(keyed, fresh_path(spark, "null-keys")), ["flag"])


@query(
    "key_violations",
    """
    WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT CAST(0 AS BIGINT) AS null_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys FROM k
    """,
)
def repeated_line_keys(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    return key_violations(lines, ["l_orderkey", "l_linenumber"])


@query(
    "reference_snapshot",
    """
    SELECT l_orderkey, l_quantity, 'train' AS data_split
    FROM lineitem WHERE l_orderkey % 5 < 4
    """,
)
def snapshot(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_quantity"])
    split = lines.select("*", split_by_mod("l_orderkey").alias("data_split"))
    return reference_snapshot(split, fresh_path(spark, "reference"))


@query(
    "layer_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAR),
)
def layer_counts(spark, folder):
    return table_counts({t: fixture(spark, folder, t) for t in STAR})


PREVIEW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(
    "preview",
    f"SELECT {', '.join(PREVIEW_ORDER)} FROM lineitem ORDER BY {', '.join(PREVIEW_ORDER)} LIMIT 5",
)
def first_rows(spark, folder):
    return preview(fixture(spark, folder, "lineitem", PREVIEW_ORDER), PREVIEW_ORDER, 5)


@query(
    "feature_table_published",
    """
    SELECT sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR))) AS feature_id,
           o_totalprice, CAST(2 AS BIGINT) AS versions_named, TRUE AS refused, CAST(1 AS BIGINT) AS versions_kept
    FROM orders
    """,
)
def feature_table_published(spark, folder):
    """Two publishes and a refused third: readers get the second whole, and only its folder stays after pruning."""
    path = fresh_path(spark, "features")
    rows = _order_features(spark, folder)
    write_feature_table(rows.where("o_totalprice > 100000"), ["feature_id"], FEATURES, path)
    write_feature_table(rows, ["feature_id"], FEATURES, path)
    refused = False
    try:
        write_feature_table(rows.withColumn("feature_id", F.lit("same")), ["feature_id"], FEATURES, path)
    except KeyViolation:
        refused = True
    named = published_versions(spark, path).count()
    removed = prune_versions(spark, path, keep=1)
    return read_published(spark, path, ["feature_id", "o_totalprice"]).select(
        "*", F.lit(named).cast("long").alias("versions_named"), F.lit(refused).alias("refused"), F.lit(named - len(removed)).cast("long").alias("versions_kept")
    )


@query(
    "append_logged",
    """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority, o_orderstatus
    FROM orders
    """,
)
def logged_append(spark, folder):
    """Even orders first, then odd ones with a new column, partitioned by status; the schema log tells each reader both."""
    path = fresh_path(spark, "logged")
    orders = fixture(spark, folder, "orders", ["o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"])
    append_logged(orders.where("o_orderkey % 2 = 0").drop("o_orderpriority"), path, ["o_orderstatus"])
    append_logged(orders.where("o_orderkey % 2 = 1"), path)
    return read_logged(spark, path, orders.columns)
