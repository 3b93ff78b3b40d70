"""Data-quality counts and the report of what cleaning removes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType, MapType, StructType

from cohortloom.operators.columns import in_ranges


def _as_rows(one_row: DataFrame, labels: Sequence[str], **outputs: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per label."""
    name, *_ = outputs
    structs = [
        F.struct(F.lit(label).alias("item"), *[outputs[o][i].alias(o) for o in outputs])
        for i, label in enumerate(labels)
    ]
    return one_row.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls) for every column, from one pass."""
    names = list(columns or df.columns)
    totals = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    rows = _as_rows(totals, names, nulls=[F.col(f"n{i}") for i in range(len(names))])
    return rows.withColumnRenamed("item", "column_name")


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 of a row's values, each with its length, so that different rows never share one text."""
    parts = []
    for name in columns or df.columns:
        kind = df.schema[name].dataType
        if isinstance(kind, (DoubleType, FloatType)):
            text = (F.col(name) + F.lit(0.0)).cast("string")  # grouping holds -0.0 and 0.0 to be equal
        elif isinstance(kind, BinaryType):
            text = F.hex(name)
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            text = F.to_json(F.struct(F.col(name)))
        else:
            text = F.col(name).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _distinct_rows(df: DataFrame, columns: Sequence[str] | None, digest: bool = False) -> DataFrame:
    """Each different row once, or its digest, with the number of its copies."""
    keys = [F.unhex(row_digest(df, columns)).alias("digest")] if digest else list(columns or df.columns)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, digest: bool = False) -> DataFrame:
    """Rows beyond the first of their kind. Copies are counted before the shuffle.

    ``digest`` shuffles 32 bytes instead of each different row: for wide rows and long texts.
    """
    return _distinct_rows(df, columns, digest).agg(
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicates")
    )


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, min_value, max_value), from one pass."""
    bounds = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)],
    )
    rows = _as_rows(
        bounds,
        columns,
        min_value=[F.col(f"lo{i}") for i in range(len(columns))],
        max_value=[F.col(f"hi{i}") for i in range(len(columns))],
    )
    return rows.withColumnRenamed("item", "feature")


def quality_issues(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(check_name, affected_rows, message) for failing checks only.

    NULL and duplicate counts come from the same grouped frame: one scan and
    one shuffle for the whole report.
    """
    names = list(columns or df.columns)
    copies = F.col("__copies")
    totals = _distinct_rows(df, names).agg(
        F.sum(copies - 1).alias("duplicates"),
        *[F.sum(F.when(F.col(c).isNull(), copies)).alias(f"n{i}") for i, c in enumerate(names)],
    )
    checks = [f"nulls:{c}" for c in names] + ["duplicates"]
    values = [F.col(f"n{i}") for i in range(len(names))] + [F.col("duplicates")]
    found = _as_rows(totals, checks, affected_rows=values).where("affected_rows > 0")
    return found.select(
        F.col("item").alias("check_name"),
        "affected_rows",
        F.concat(
            F.when(F.col("item") == "duplicates", F.lit("duplicate rows found: ")).otherwise(
                F.concat(F.lit("nulls in "), F.substring_index("item", ":", -1), F.lit(": "))
            ),
            F.col("affected_rows").cast("string"),
        ).alias("message"),
    )


def is_missing(df: DataFrame, required: Sequence[str]) -> Column:
    """NULL, or NaN in a floating-point column, in any required column."""
    kinds = dict(df.dtypes)
    tests = []
    for name in required:
        test = F.col(name).isNull()
        tests.append(test | F.isnan(name) if kinds[name] in ("double", "float") else test)
    return reduce(or_, tests)


def clean_report(
    df: DataFrame, required: Sequence[str], bounds: Mapping[str, tuple[float, float]]
) -> DataFrame:
    """(outcome, row_count): rows in, removed by each rule, and kept.

    A row counts for the first rule it breaks, in the order duplicate, missing,
    out of range. One grouped pass gives every figure.
    """
    rule = (
        F.when(is_missing(df, required), "missing")
        .when(~F.coalesce(in_ranges(bounds), F.lit(False)), "out_of_range")
        .otherwise("kept")
    )
    rows = _distinct_rows(df, None).select(F.col("__copies"), rule.alias("rule"))
    totals = rows.agg(
        F.sum("__copies").alias("rows_in"),
        F.sum(F.col("__copies") - 1).alias("duplicate"),
        *[F.count_if(F.col("rule") == r).alias(r) for r in ("missing", "out_of_range", "kept")],
    )
    labels = ["rows_in", "duplicate", "missing", "out_of_range", "kept"]
    counts = _as_rows(
        totals, labels, row_count=[F.coalesce(F.col(label), F.lit(0)) for label in labels]
    )
    return counts.withColumnRenamed("item", "outcome")
