"""Table writes, each to a path of its own version, and their verification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortloom.operators.columns import conform
from cohortloom.sources.tables import read_table


class KeyViolation(ValueError):
    """A declared key has NULLs or repeats."""


class SchemaClash(ValueError):
    """Rows do not fit the table that they are appended to."""


def _read_back(df: DataFrame, path: str, fmt: str) -> DataFrame:
    """The table in the written frame's own columns, order and types, even without rows."""
    nullable = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    return read_table(df.sparkSession, path, df.columns, fmt=fmt, schema=nullable)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    rebalance: bool | None = None,
) -> DataFrame:
    """Write, and return the table as read back with the schema it was written in.

    A table cannot be overwritten while it is read: write each rebuild to a new
    path. ``rebalance``, the default for partitioned tables, groups rows by
    partition value into files of the advisory size; adaptive execution splits
    a partition value that is too large for one task and joins small ones.
    Partition values keep their type; an empty text reads back as NULL there,
    since folder names cannot tell them apart.
    """
    if rebalance is None:
        rebalance = bool(partition_by)
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    writer = rows.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return _read_back(df, path, fmt)


# Marks NULL in text files; a text of just these two characters reads back as NULL.
CSV_NULL = "\\N"
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": CSV_NULL,
    "emptyValue": "",
    "multiLine": "true",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str) -> DataFrame:
    """Write with a header, and return the table as read back with the same types and texts."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("quoteAll", "true").csv(path)
    return df.sparkSession.read.schema(df.schema).options(**CSV_OPTIONS).csv(path)


def write_named(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    path: str | None = None,
) -> DataFrame:
    """Write a catalog table, its schema replaced on overwrite, and return it as read back."""
    writer = df.write.format(fmt).mode(mode).option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def partitioning(table: DataFrame, path: str) -> list[str]:
    """Partition columns of a file table, read off the folders of one of its files; none for an empty table."""
    one = table.select("_metadata.file_path").first()
    if one is None:
        return []
    inside = unquote(one[0]).rsplit(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[-1]
    return [folder.split("=", 1)[0] for folder in inside.split("/")[:-1] if "=" in folder]


def _same_partitioning(table: DataFrame, path: str, asked: Sequence[str] | None) -> list[str]:
    """The target's partitioning, which an append has to follow."""
    found = partitioning(table, path)
    if asked is not None and found and list(asked) != found:
        raise SchemaClash(f"the table is partitioned by {found}, not by {list(asked)}")
    return found or list(asked or ())


def fitting(df: DataFrame, schema: StructType) -> DataFrame:
    """Rows in the types of the columns they share with ``schema``; only casts that lose nothing, else nothing is written."""
    fields = {f.name: f.dataType for f in schema.fields}
    columns = []
    for field in df.schema.fields:
        known = fields.get(field.name, field.dataType)
        if known != field.dataType and (field.dataType.typeName(), known.typeName()) not in _WIDER:
            raise SchemaClash(f"{field.name} is {known.simpleString()} in the table and {field.dataType.simpleString()} in the rows")
        columns.append(F.col(field.name).cast(known).alias(field.name))
    return df.select(*columns)


# Casts that keep every value; timestamps and decimals have to agree exactly.
_WIDER = {
    (a, b)
    for order in (("byte", "short", "integer", "long"), ("byte", "short", "integer", "double"), ("byte", "short", "float", "double"))
    for i, a in enumerate(order)
    for b in order[i + 1 :]
} | {("void", t) for t in ("byte", "short", "integer", "long", "float", "double", "string", "boolean", "date", "timestamp", "timestamp_ntz", "binary")}


def append_evolving(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """Append rows that may bring new columns; earlier rows read NULL there.

    The rows go into the target's own partitions. Types are compared before
    anything is written: narrower ones are widened to the table's, others raise.
    ``schema`` is the table's schema where it is known, as that of the frame
    which the last append returned; without it the footers are read once.
    """
    try:
        table = read_table(df.sparkSession, path, fmt=fmt, merge_schema=schema is None, schema=schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return write_table(df, path, "append", partition_by or (), fmt)
    folders = _same_partitioning(table, path, partition_by)
    rows = fitting(df, table.schema)
    known = set(table.columns)
    merged = StructType([*table.schema.fields, *[StructField(f.name, f.dataType, True) for f in rows.schema if f.name not in known]])
    writer = rows.write.format(fmt).mode("append")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.save(path)
    return read_table(df.sparkSession, path, merged.fieldNames(), fmt=fmt, schema=merged)


def append_conformed(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    strict: bool = True,
    schema: StructType | None = None,
) -> DataFrame:
    """Append rows cast to the existing table's schema, into its own partitions.

    ``schema`` is the table's schema where it is known; folder names alone do not
    tell a text from a number in a partition column.
    With ``strict`` a value that the table's type cannot hold stops the write,
    and so does a column that the table lacks; without it they become NULL and
    are left out.
    """
    target = read_table(df.sparkSession, path, fmt=fmt, schema=schema)
    unknown = [c for c in df.columns if c not in target.columns]
    if strict and unknown:
        raise SchemaClash(f"the table has no column {', '.join(unknown)}")
    folders = _same_partitioning(target, path, partition_by)
    writer = conform(df, target.schema, strict=strict).write.format(fmt).mode("append")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.save(path)
    return read_table(df.sparkSession, path, target.columns, fmt=fmt, schema=target.schema)


def _rows_before(df: DataFrame, path: str, mode: str, fmt: str) -> int:
    """Rows that an append finds."""
    if mode != "append":
        return 0
    try:
        return read_table(df.sparkSession, path, fmt=fmt).count()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def write_verified(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    rebalance: bool | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
) -> DataFrame:
    """One row: (rows_written, rows_read, matches).

    The written count is observed in the writing tasks themselves, after any
    shuffle, so the source runs once and a repeated map task is not counted
    twice. Of an append only the rows beyond those found before are counted.
    """
    before = _rows_before(df, path, mode, fmt)
    if rebalance is None:
        rebalance = bool(partition_by)
    written = Observation()
    rows = df.hint("rebalance", *partition_by) if rebalance else df
    watched = rows.observe(written, F.count(F.lit(1)).alias("n"))
    back = write_table(watched, path, mode=mode, partition_by=partition_by, fmt=fmt, rebalance=False)
    expected = F.lit(written.get["n"]).cast("long")
    return back.agg((F.count(F.lit(1)) - F.lit(before)).alias("rows_read")).select(
        expected.alias("rows_written"), "rows_read", (expected == F.col("rows_read")).alias("matches")
    )


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: (null_keys, repeated_keys)."""
    any_null = F.lit(False)
    for name in key:
        any_null = any_null | F.col(name).isNull()
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(
        F.coalesce(F.sum(F.when(any_null, F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.count_if(~any_null & (F.col("copies") > 1)).alias("repeated_keys"),
    )


def hashes_prove_key(df: DataFrame, key: Sequence[str]) -> bool:
    """True if no key has a NULL and no two rows share the 64-bit hash of their keys, so that none repeats; False decides nothing.

    Far less is shuffled than the keys themselves.
    """
    if any(isinstance(df.schema[name].dataType, StringType) and df.schema[name].dataType != StringType() for name in key):
        return False  # texts that a collation takes for equal have different hashes
    columns = [F.col(name) for name in key]
    hashes = df.groupBy(F.xxhash64(*columns).alias("hash")).agg(F.count(F.lit(1)).alias("copies"), F.bool_or(reduce(or_, [c.isNull() for c in columns])).alias("any_null"))
    return not hashes.agg(F.coalesce(F.bool_or(F.col("any_null") | (F.col("copies") > 1)), F.lit(False))).first()[0]


def feature_table_verify(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: (row_count, distinct_keys, feature_count, key_is_unique); a key with a NULL is none."""
    copies = table.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    width = len(table.columns) - len(key)
    whole = reduce(and_, [F.col(name).isNotNull() for name in key])
    return copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"), F.count_if(whole).alias("distinct_keys")
    ).select(
        "row_count",
        "distinct_keys",
        F.lit(width).cast("long").alias("feature_count"),
        (F.col("row_count") == F.col("distinct_keys")).alias("key_is_unique"),
    )


def reference_snapshot(df: DataFrame, path: str, split: str = "data_split", value: str = "train") -> DataFrame:
    """Write the training rows as the reference for later drift checks."""
    return write_table(df.where(F.col(split) == value), path)
