from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cohortloom.operators.columns import (
    cast_columns,
    conform,
    drop_duplicate_rows,
    drop_missing,
    range_filter,
)
from cohortloom.operators.quality import (
    clean_report,
    duplicate_count,
    null_counts,
    quality_issues,
    range_profile,
)
from cohortloom.plans.medallion import CleaningRules, clean_table

NAN = float("nan")
ROWS = [
    (1.0, 5.0, "a"),
    (1.0, 5.0, "a"),
    (1.0, 5.0, "A "),
    (None, 5.0, "b"),
    (NAN, 5.0, "b"),
    (2.0, 99.0, None),
    (2.0, None, "c"),
    (2.0, 10.0, "c"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "x double, y double, c string")


def test_range_filter_is_inclusive_and_drops_missing(spark):
    assert range_filter(frame(spark), {"x": (1, 2), "y": (5, 10)}).count() == 4


def test_drop_missing_takes_nan_too(spark):
    assert drop_missing(frame(spark), ["x"]).count() == 6


def test_dedup_by_key_keeps_the_preferred_row(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 3, "c")], "k string, n int, v string")
    got = drop_duplicate_rows(df, ["k"], [F.col("n")])
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == [("k", 1, "a"), (None, 3, "c")]


def test_hot_duplicates_are_all_removed(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    assert drop_duplicate_rows(df).count() == 20001
    assert duplicate_count(df).first().duplicates == 9999


def test_loose_and_strict_casts(spark):
    df = spark.createDataFrame([("7",), ("x",)], "v string")
    assert [r.v for r in cast_columns(df, {"v": "int"}, strict=False).collect()] == [7, None]


def test_conform_reorders_adds_and_leaves_out(spark):
    target = StructType([StructField("c", StringType()), StructField("z", IntegerType()), StructField("x", IntegerType())])
    got = conform(frame(spark), target)
    assert got.schema.simpleString() == "struct<c:string,z:int,x:int>"
    assert got.where("z is not null").isEmpty()


def test_null_counts_leave_nan_alone(spark):
    got = {r.column_name: r.nulls for r in null_counts(frame(spark)).collect()}
    assert got == {"x": 1, "y": 1, "c": 1}


def test_issue_report_lists_failures_only(spark):
    got = {r.check_name: r.affected_rows for r in quality_issues(frame(spark)).collect()}
    assert got == {"nulls:x": 1, "nulls:y": 1, "nulls:c": 1, "duplicates": 1}
    clean = spark.createDataFrame([(1,), (2,)], "a int")
    assert quality_issues(clean).isEmpty()


def test_reports_on_an_empty_table(spark):
    empty = frame(spark).limit(0)
    assert duplicate_count(empty).first().duplicates == 0
    assert quality_issues(empty).isEmpty()
    assert {r.row_count for r in clean_report(empty, ["x"], {"y": (0, 1)}).collect()} == {0}
    profile = range_profile(empty, ["x"]).first()
    assert profile.min_value is None and profile.max_value is None


def test_clean_report_adds_up_and_agrees_with_cleaning(spark):
    bounds = {"y": (0, 50)}
    got = {r.outcome: r.row_count for r in clean_report(frame(spark), ["x"], bounds).collect()}
    assert got == {"rows_in": 8, "duplicate": 1, "missing": 2, "out_of_range": 2, "kept": 3}
    rules = CleaningRules(["x"], bounds, {"x": "int"}, ["c"], {"version": "v1"})
    cleaned = clean_table(frame(spark), rules)
    assert cleaned.count() == got["kept"]
    # duplicates are judged before the text is normalised
    assert sorted((r.x, r.c) for r in cleaned.collect()) == [(1, "A"), (1, "A"), (2, "C")]
    assert cleaned.dtypes == [("x", "int"), ("y", "double"), ("c", "string"), ("version", "string")]


def test_a_row_digest_tells_rows_apart_like_grouping(spark):
    rows = [("a|b", "c", 0.0), ("a", "b|c", 0.0), ("a", "b|c", -0.0), (None, "", 1.0), ("", None, 1.0), ("-", None, 1.0), ("1:a", None, float("nan")), ("1:a", None, float("nan"))]
    df = spark.createDataFrame(rows, "x string, y string, z double")
    assert duplicate_count(df, digest=True).first()[0] == duplicate_count(df).first()[0] == 2
