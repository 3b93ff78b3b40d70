"""Feature expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import moment, num, query, sql_round
from cohortloom.functions.category import bucketize, encode, encode_by_table, normalise_text
from cohortloom.functions.keys import run_metadata, split_by_hash, split_by_mod, surrogate_key
from cohortloom.functions.numeric import (
    clip,
    min_max_columns,
    ratio,
    round_columns,
    round_floor,
    threshold_flag,
)
from cohortloom.functions.scoring import label_from_score, label_score, rule_score, weighted_score
from cohortloom.operators.splits import split_by_position
from cohortloom.plans.medallion import FeatureRules, gold_features
from cohortloom.sources.tables import fixture

# Codes of the test categories.
TYPE_CODES = {"ECONOMY": 0, "LARGE": 1, "MEDIUM": 2, "PROMO": 3, "SMALL": 4}
FLAG_CODES = {"A": 0, "N": 1, "R": 2}
STEPS = [(15, "low"), (35, "mid")]
STEP_CODES = {"low": 0, "mid": 1, "high": 2}
SCALES = {
    "l_extendedprice": (900.0, 105000.0),
    "l_discount": (0.0, 0.1),
    "l_quantity": (1.0, 50.0),
    "l_tax": (0.0, 0.08),
}


def _case(column, codes, default):
    arms = " ".join(f"WHEN {column} = '{name}' THEN {code}" for name, code in codes.items())
    return f"CASE {arms} ELSE {default} END"


STEP_SQL = "CASE WHEN l_quantity < 15 THEN 'low' WHEN l_quantity < 35 THEN 'mid' ELSE 'high' END"
RULE_SQL = (
    "CAST(CAST(l_extendedprice < 50000 AS INTEGER) + CAST(l_discount < 0.05 AS INTEGER) "
    "+ CAST(l_quantity < 25 AS INTEGER) + CAST(l_linenumber < 5 AS INTEGER) AS DOUBLE)"
)
RISK_SQL = sql_round(
    f"(l_quantity / {num(50.0)}) * {num(0.4)} + (CAST(l_linenumber AS DOUBLE) / {num(7.0)}) * {num(0.4)} "
    f"+ CAST(l_returnflag = 'R' AS DOUBLE) * {num(0.2)}",
    4,
)
RATIO_SQL = sql_round("l_extendedprice / (l_quantity * 7)", 4)
SCALE_SQL = ", ".join(
    f"{sql_round(f'({c} - {num(lo)}) / {num(hi - lo)}', 4)} AS {c}_norm" for c, (lo, hi) in SCALES.items()
)


def line_rules():
    return (
        F.col("l_extendedprice") < 50000,
        F.col("l_discount") < F.lit(0.05),
        F.col("l_quantity") < 25,
        F.col("l_linenumber") < 5,
    )


def line_risk():
    return [
        (F.col("l_quantity") / 50.0, 0.4),
        (F.col("l_linenumber") / 7.0, 0.4),
        ((F.col("l_returnflag") == "R").cast("int"), 0.2),
    ]


@query("norm_category", "SELECT p_partkey, upper(trim('  ' || lower(p_type) || ' ')) AS p_type FROM part")
def norm_category(spark, folder):
    messy = F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "))
    return fixture(spark, folder, "part").select("p_partkey", normalise_text(messy).alias("p_type"))


@query("rule_score", f"SELECT l_orderkey, {RULE_SQL} AS rule_score FROM lineitem")
def line_rule_score(spark, folder):
    return fixture(spark, folder, "lineitem").select("l_orderkey", rule_score(*line_rules()).alias("rule_score"))


@query("weighted_score", f"SELECT l_orderkey, {RISK_SQL} AS risk_score FROM lineitem")
def line_risk_score(spark, folder):
    score = round_floor(weighted_score(line_risk()), 4)
    return fixture(spark, folder, "lineitem").select("l_orderkey", score.alias("risk_score"))


@query(
    "ratio_feature",
    f"""
    SELECT l_orderkey, {RATIO_SQL} AS price_ratio,
           CASE WHEN l_discount = 0 THEN NULL ELSE {sql_round('l_tax / nullif(l_discount, 0)', 4)} END AS tax_ratio
    FROM lineitem
    """,
)
def line_ratio(spark, folder):
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey",
        round_floor(ratio("l_extendedprice", F.col("l_quantity") * 7), 4).alias("price_ratio"),
        round_floor(ratio("l_tax", "l_discount"), 4).alias("tax_ratio"),
    )


@query("threshold_flag", "SELECT l_orderkey, CAST(l_extendedprice > 50000 AS INTEGER) AS high_flag FROM lineitem")
def line_flag(spark, folder):
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey", threshold_flag("l_extendedprice", 50000).alias("high_flag")
    )


@query("bucketize", f"SELECT l_orderkey, {STEP_SQL} AS step FROM lineitem")
def line_steps(spark, folder):
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey", bucketize("l_quantity", STEPS, "high").alias("step")
    )


@query("minmax_fixed", f"SELECT l_orderkey, {SCALE_SQL} FROM lineitem")
def line_scaled(spark, folder):
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey", *min_max_columns(SCALES, rounding=round_floor)
    )


@query("dict_encode", f"SELECT p_partkey, {_case('p_type', TYPE_CODES, 9)} AS type_index FROM part")
def type_codes(spark, folder):
    return fixture(spark, folder, "part").select(
        "p_partkey", encode(normalise_text("p_type"), TYPE_CODES, 9).alias("type_index")
    )


@query(
    "dict_encode_table",
    """
    SELECT l.l_orderkey, l.l_partkey, CAST(coalesce(p.p_size, -1) AS INTEGER) AS size_code
    FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON l.l_partkey = p.p_partkey
    """,
)
def part_sizes(spark, folder):
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", "l_partkey"])
    parts = fixture(spark, folder, "part", ["p_partkey", "p_size", "p_type"]).where("p_type <> 'PROMO'")
    return encode_by_table(lines, "l_partkey", parts, "p_partkey", "p_size", "size_code", -1)


LABEL_TERMS_SQL = (
    f"(1 - (l_extendedprice - {num(900.0)}) / {num(104100.0)}) * {num(0.4)} "
    f"+ (l_quantity / {num(50.0)}) * {num(0.35)} + (1 - l_tax / {num(0.08)}) * {num(0.25)}"
)


def label_terms():
    return [
        (1 - (F.col("l_extendedprice") - 900.0) / 104100.0, 0.4),
        (F.col("l_quantity") / 50.0, 0.35),
        (1 - F.col("l_tax") / 0.08, 0.25),
    ]


def _label_sql(score):
    clipped = f"greatest(least({score}, 1.0), 0.0)"
    return (
        f"SELECT l_orderkey, {sql_round(clipped, 4)} AS score, CAST({clipped} >= 0.5 AS INTEGER) AS label "
        "FROM lineitem"
    )


@query("label_rule", _label_sql(LABEL_TERMS_SQL))
def line_labels(spark, folder):
    score = label_score(label_terms())
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey", round_floor(score, 4).alias("score"), label_from_score(score).alias("label")
    )


@query(
    "label_rule_penalty",
    _label_sql(
        f"({LABEL_TERMS_SQL} - CASE WHEN l_extendedprice > 60000 THEN {num(0.15)} ELSE {num(0.0)} END)"
    ),
)
def line_labels_with_penalty(spark, folder):
    score = label_score(label_terms(), [(F.col("l_extendedprice") > 60000, 0.15)])
    return fixture(spark, folder, "lineitem").select(
        "l_orderkey", round_floor(score, 4).alias("score"), label_from_score(score).alias("label")
    )


@query("clip_columns", f"SELECT c_custkey, greatest(least(c_acctbal, {num(5000.0)}), {num(0.0)}) AS c_acctbal FROM customer")
def clipped_balances(spark, folder):
    return fixture(spark, folder, "customer").select("c_custkey", clip("c_acctbal", 0, 5000).alias("c_acctbal"))


@query(
    "round_columns",
    f"""
    SELECT {sql_round('l_extendedprice * l_discount', 2)} AS l_extendedprice,
           {sql_round('l_tax * l_quantity', 1)} AS l_tax, l_orderkey FROM lineitem
    """,
)
def rounded_lines(spark, folder):
    lines = fixture(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") * F.col("l_discount")).alias("l_extendedprice"),
        (F.col("l_tax") * F.col("l_quantity")).alias("l_tax"),
        "l_orderkey",
    )
    return lines.select(
        *round_columns({"l_extendedprice": 2, "l_tax": 1}, rounding=round_floor), "l_orderkey"
    )


@query(
    "round_columns_decimal",
    """
    SELECT CAST(round(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18, 6)), 1) AS DOUBLE) AS l_extendedprice,
           CAST(round(CAST(CAST(l_discount / 4 AS VARCHAR) AS DECIMAL(18, 6)), 2) AS DOUBLE) AS l_discount, l_orderkey FROM lineitem
    """,
)
def decimal_rounded_lines(spark, folder):
    """The default rounding: half up of the number as it is written."""
    lines = fixture(spark, folder, "lineitem").select("l_extendedprice", (F.col("l_discount") / 4).alias("l_discount"), "l_orderkey")
    return lines.select(*round_columns({"l_extendedprice": 1, "l_discount": 2}), "l_orderkey")


@query(
    "split_mod",
    "SELECT l_orderkey, CASE WHEN l_orderkey % 5 < 4 THEN 'train' ELSE 'validation' END AS data_split FROM lineitem",
)
def split_lines(spark, folder):
    return fixture(spark, folder, "lineitem").select("l_orderkey", split_by_mod("l_orderkey").alias("data_split"))


@query(
    "split_position",
    """
    SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(0.8 * (SELECT count(*) FROM orders))
                            THEN 'train' ELSE 'validation' END AS data_split
    FROM orders
    """,
)
def positional_split(spark, folder):
    return split_by_position(fixture(spark, folder, "orders", ["o_orderkey"]), "o_orderkey", 0.8)


@query(
    "split_position_long",
    """
    SELECT o_orderkey + 1152921504606846976 AS long_key,
           CASE WHEN row_number() OVER (ORDER BY o_orderkey) <= floor(0.8 * (SELECT count(*) FROM orders))
                THEN 'train' ELSE 'validation' END AS data_split
    FROM orders
    """,
)
def positional_split_long(spark, folder):
    keys = fixture(spark, folder, "orders", ["o_orderkey"]).select((F.col("o_orderkey") + F.lit(2**60)).alias("long_key"))
    return split_by_position(keys, "long_key", 0.8)


@query(
    "split_hash",
    """
    SELECT o_orderkey,
           CASE WHEN ('0x' || md5(CAST(o_orderkey AS VARCHAR))[1:8])::BIGINT % 100 < 80 THEN 'train' ELSE 'validation' END AS data_split
    FROM orders
    """,
)
def hashed_split(spark, folder):
    return fixture(spark, folder, "orders").select(
        "o_orderkey", split_by_hash(["o_orderkey"]).alias("data_split")
    )


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    "surrogate_key",
    f"SELECT {', '.join(LINE_KEY)}, sha256(concat_ws('|', {', '.join(LINE_KEY)})) AS feature_id FROM lineitem",
)
def line_keys(spark, folder):
    lines = fixture(spark, folder, "lineitem", LINE_KEY)
    return lines.select(*LINE_KEY, surrogate_key(lines, LINE_KEY).alias("feature_id"))


@query(
    "run_metadata",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS batch_id,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS run_at, 'champion' AS model_alias, 'dev' AS environment
    FROM orders
    """,
)
def order_metadata(spark, folder):
    return fixture(spark, folder, "orders").select(
        "o_orderkey", *run_metadata(F.col("o_orderdate"), {"model_alias": "champion", "environment": "dev"})
    )


def line_feature_rules():
    step = bucketize("l_quantity", STEPS, "high")
    return FeatureRules(
        raw=["l_extendedprice", "l_discount", "l_quantity", "l_tax", "l_linenumber"],
        derived={
            "category_index": encode(normalise_text("p_type"), TYPE_CODES, 0),
            "step_index": encode(step, STEP_CODES, 1),
            "rule_score": rule_score(*line_rules()),
            "risk_score": round_floor(weighted_score(line_risk()), 4),
            "ratio_feature": round_floor(ratio("l_extendedprice", "l_quantity"), 4),
            "high_flag": threshold_flag("l_extendedprice", 50000),
        },
        bounds=SCALES,
        metadata=["l_orderkey", "data_split", "data_version"],
    )


def gold_input(spark, folder):
    lines = fixture(spark, folder, "lineitem")
    parts = fixture(spark, folder, "part", ["p_partkey", "p_type"])
    version = F.when(F.col("l_shipdate") < moment("2000-01-01 00:00:00"), "baseline_v1").otherwise("current_v1")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        *lines.columns,
        "p_type",
        split_by_mod("l_orderkey").alias("data_split"),
        version.alias("data_version"),
    )


@query(
    "gold_features",
    f"""
    SELECT l_extendedprice, l_discount, l_quantity, l_tax, l_linenumber,
           {_case('p_type', TYPE_CODES, 0)} AS category_index, {_case(f'({STEP_SQL})', STEP_CODES, 1)} AS step_index,
           {RULE_SQL} AS rule_score, {RISK_SQL} AS risk_score,
           {sql_round('l_extendedprice / l_quantity', 4)} AS ratio_feature,
           CAST(l_extendedprice > 50000 AS INTEGER) AS high_flag, {SCALE_SQL}, l_orderkey,
           CASE WHEN l_orderkey % 5 < 4 THEN 'train' ELSE 'validation' END AS data_split,
           CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'baseline_v1' ELSE 'current_v1' END AS data_version
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def line_gold(spark, folder):
    return gold_features(gold_input(spark, folder), line_feature_rules(), rounding=round_floor)
