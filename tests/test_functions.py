import math

import pytest
from pyspark.sql import functions as F

from cohortloom.functions.category import bucketize, encode, encode_by_table, normalise_text
from cohortloom.functions.keys import run_metadata, split_by_hash, surrogate_key
from cohortloom.functions.numeric import (
    clip,
    finite_or_null,
    min_max,
    ratio,
    real_or_null,
    round_decimal,
    round_floor,
    threshold_flag,
)
from cohortloom.functions.scoring import label_from_score, label_score, logistic, rule_score, weighted_score

NAN = float("nan")


def column(spark, values, expression, kind="double"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r.y for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_clip_keeps_null_and_nan(spark):
    got = column(spark, [None, NAN, -1.0, 0.5, 9.0], clip("x", 0, 1))
    assert got[0] is None and math.isnan(got[1]) and got[2:] == [0.0, 0.5, 1.0]


def test_rounding_rules_differ_only_on_binary_ties(spark):
    assert column(spark, [0.285], round_decimal("x", 2)) == [0.29]
    assert column(spark, [0.285], round_floor("x", 2)) == [0.28]
    assert column(spark, [1.25, -1.25, 1e300, None], round_floor("x", 1)) == [1.3, -1.2, 1e300, None]
    assert math.isnan(column(spark, [NAN], round_floor("x", 2))[0])


def test_ratio_by_zero_is_null(spark):
    assert column(spark, [0.0, 2.0, None], ratio(F.lit(1), "x")) == [None, 0.5, None]


def test_min_max_is_not_clipped(spark):
    assert column(spark, [0.0, 10.0, 20.0, None], min_max("x", 0, 10)) == [0.0, 1.0, 2.0, None]
    with pytest.raises(ValueError):
        min_max("x", 1, 1)


def test_threshold_flag_ignores_nan(spark):
    assert column(spark, [50.0, 50.1, NAN, None], threshold_flag("x", 50)) == [0, 1, None, None]


def test_missing_number_helpers(spark):
    inf = float("inf")
    assert column(spark, [NAN, inf, -inf, 1.0, None], finite_or_null("x")) == [None, None, None, 1.0, None]
    assert column(spark, [NAN, inf, 1.0], real_or_null("x")) == [None, inf, 1.0]


def test_bucketize_has_its_own_label_for_missing(spark):
    steps = [(40, "young"), (60, "middle")]
    got = column(spark, [39.0, 40.0, 60.0, None, NAN], bucketize("x", steps, "senior", "unknown"))
    assert got == ["young", "middle", "senior", "unknown", "unknown"]


def test_encode_default_for_unknown_and_null(spark):
    got = column(spark, [" a ", "B", "z", None], encode(normalise_text("x"), {"A": 0, "B": 1}, 7), "string")
    assert got == [0, 1, 7, 7]
    assert column(spark, ["499", "x"], encode("x", {str(i): i for i in range(500)}, -1), "string") == [499, -1]


def test_encode_by_table_keeps_every_row_once(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "c string")
    words = spark.createDataFrame([("a", 1), ("b", 2), (None, 5), (None, 6)], "w string, code int")
    got = encode_by_table(rows, "c", words, "w", "code", "n", -1)
    assert sorted((r.c or "", r.n) for r in got.collect()) == [("", -1), ("a", 1), ("b", 2), ("c", -1)]


def test_encode_by_table_refuses_an_ambiguous_dictionary(spark):
    words = spark.createDataFrame([("a", 1), ("a", 2)], "w string, code int")
    with pytest.raises(ValueError):
        encode_by_table(spark.createDataFrame([("a",)], "c string"), "c", words, "w", "code", "n", 0)


def test_encode_by_table_splits_a_hot_category(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 6).select(
            "id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("c")
        )
        words = spark.range(500).select(F.col("id").alias("w"), (F.col("id") * 2).alias("code"))
        got = encode_by_table(rows, "c", words, "w", "code", "n", -9)
        summary = got.groupBy((F.col("n") == -9).alias("unknown")).count()
        assert {r.unknown: r["count"] for r in summary.collect()} == {True: 20000, False: 40000}
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rule_score_counts_and_propagates_null(spark):
    assert column(spark, [1.0, 5.0, None], rule_score(F.col("x") < 2, F.col("x") < 9)) == [2.0, 1.0, None]


def test_weighted_and_label_scores(spark):
    assert column(spark, [2.0], weighted_score([("x", 0.5), (F.lit(1), 0.25)])) == [1.25]
    score = label_score([("x", 1.0)], [(F.col("x") > 1, 0.75)])
    assert column(spark, [0.4, 1.2, 3.0, -1.0, None], score) == [0.4, pytest.approx(0.45), 1.0, 0.0, None]
    assert column(spark, [0.5, 0.49, None], label_from_score("x")) == [1, 0, None]


def test_logistic_is_stable_at_the_ends(spark):
    assert column(spark, [0.0, 1e4, -1e4], logistic([("x", 1.0)])) == [0.5, 1.0, 0.0]


def test_surrogate_key_separates_lookalikes(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("\\N", "c"), ("c", None), ("a\\", "|c"), ("a", "\\|c")]
    df = spark.createDataFrame(rows, "x string, y string")
    keys = [r.k for r in df.select(surrogate_key(df, ["x", "y"]).alias("k")).collect()]
    assert len(set(keys)) == len(rows)
    again = [r.k for r in df.repartition(3).select(surrogate_key(df, ["x", "y"]).alias("k")).collect()]
    assert set(again) == set(keys)


def test_hash_split_is_stable_and_near_its_share(spark):
    ids = spark.range(20000)
    split = ids.select("id", split_by_hash(["id"]).alias("s"))
    share = split.where("s = 'train'").count() / 20000
    assert abs(share - 0.8) < 0.02
    moved = ids.repartition(7).select("id", split_by_hash(["id"]).alias("s"))
    assert split.exceptAll(moved).isEmpty()


def test_run_metadata_uses_the_given_time(spark):
    at = F.expr("timestamp_ntz'2024-05-06 07:08:09'")
    row = spark.range(1).select(*run_metadata(at, {"environment": "dev"})).first()
    assert tuple(row) == ("20240506_070809", "2024-05-06T07:08:09", "dev")
