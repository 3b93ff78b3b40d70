"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A file table; naming the columns keeps the scan to them.

    ``merge_schema`` unites the schemas of all files, for tables whose appends
    added columns; older rows read NULL there.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    df = reader.load(path)
    return df.select(*columns) if columns else df


def read_named(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table or view."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def fixture(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``<folder>/<name>.parquet``."""
    return read_table(spark, f"{folder}/{name}.parquet", columns)
