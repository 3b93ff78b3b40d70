"""Tables of versions with one small pointer, and a schema log beside the data.

A published table is a folder of versions and a pointer. A publish writes its version once, checks what it
wrote, and only then appends one row to the pointer; readers go by the newest row, so they see the old
version or the new one and never a part of either. A version that fails its check is removed, and the
old one stays what it was. Folders whose names begin with an underscore are not read as data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from cohortloom.sources.sinks import KeyViolation, SchemaClash, fitting, hashes_prove_key, key_violations, write_table
from cohortloom.sources.tables import read_table

POINTER = "sequence long, version string, schema string, partitions array<string>"


class NotPublished(LookupError):
    """No version has been published at a path."""


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the file system it is on; False if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _log_rows(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_table(spark, path, schema=POINTER)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(spark: SparkSession, path: str):
    """The newest row of a log, of equal sequence numbers the one of the largest version; None if there is none."""
    rows = _log_rows(spark, path)
    return None if rows is None else rows.orderBy(F.desc("sequence"), F.desc("version")).first()


def _log(spark: SparkSession, path: str, before, version: str, schema: StructType, partitions: Sequence[str]) -> None:
    row = ((before["sequence"] if before else 0) + 1, version, schema.json(), list(partitions))
    spark.createDataFrame([row], POINTER).coalesce(1).write.mode("append").parquet(path)


def _loose(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def publish(
    df: DataFrame,
    path: str,
    check: Callable[[DataFrame], None] | None = None,
    partition_by: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Write a new version, have ``check`` look at it as read back, and point readers to it.

    ``check`` raises to refuse. Two publishers at once both write whole versions; the one whose pointer
    row sorts last is read. Versions before stay until :func:`prune_versions`.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    try:
        table = write_table(df, f"{root}/{version}", partition_by=partition_by, **options)
        if check is not None:
            check(table)
    except BaseException:
        remove_folder(spark, f"{root}/{version}")
        raise
    _log(spark, f"{root}/_pointer", _newest(spark, f"{root}/_pointer"), version, table.schema, partition_by)
    return table


def read_published(spark: SparkSession, path: str, columns: Sequence[str] | None = None, version: str | None = None) -> DataFrame:
    """The version that the pointer names, or a named one, read by its logged schema: no file footers are opened."""
    root = path.rstrip("/")
    rows = _log_rows(spark, f"{root}/_pointer")
    if rows is not None and version is not None:
        rows = rows.where(F.col("version") == version)
    row = None if rows is None else rows.orderBy(F.desc("sequence"), F.desc("version")).first()
    if row is None:
        raise NotPublished(path)
    return read_table(spark, f"{root}/{row['version']}", columns, schema=StructType.fromJson(json.loads(row["schema"])))


def published_versions(spark: SparkSession, path: str) -> DataFrame:
    """(sequence, version): all that has been published, oldest first."""
    rows = _log_rows(spark, f"{path.rstrip('/')}/_pointer")
    if rows is None:
        raise NotPublished(path)
    return rows.select("sequence", "version").orderBy("sequence", "version")


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the ``keep`` newest versions; readers of those must be done. Returns what went."""
    if keep < 1:
        raise ValueError("the version that readers go to has to stay")
    names = [r.version for r in published_versions(spark, path).collect()]
    return [name for name in names[:-keep] if remove_folder(spark, f"{path.rstrip('/')}/{name}")]


def write_feature_table(df: DataFrame, key: Sequence[str], features: Sequence[str], path: str, **options) -> DataFrame:
    """Publish key and features if the key has no NULL and no repeats; otherwise the version before stays.

    The plan runs and is written once; the check reads only the key columns of what was written.
    """

    def keyed(table: DataFrame) -> None:
        if hashes_prove_key(table, key):
            return
        found = key_violations(table, key).first()
        if found.null_keys or found.repeated_keys:
            raise KeyViolation(f"{found.null_keys} rows without key, {found.repeated_keys} repeated keys")

    return publish(df.select(*key, *features), path, keyed, **options)


def append_logged(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Append rows that may bring new columns, by the schema log beside the table.

    The log says what the table's columns, types and partitions are, in any session and at any number of files:
    nothing of the data is listed or opened to find out. Narrower types are widened to the table's, others raise
    before anything is written, and so does another partitioning. New columns are logged before their rows are
    written, so that a reader never meets a column that the log lacks. Earlier rows read NULL in them.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    log = f"{root}/_schema"
    before = _newest(spark, log)
    known = StructType.fromJson(json.loads(before["schema"])) if before else StructType([])
    folders = list(before["partitions"]) if before else list(partition_by or ())
    if before and partition_by is not None and list(partition_by) != folders:
        raise SchemaClash(f"the table is partitioned by {folders}, not by {list(partition_by)}")
    rows = fitting(df, known)
    missing = [c for c in folders if c not in rows.columns]
    if missing:
        raise SchemaClash(f"the rows lack the partition column {', '.join(missing)}")
    fresh = [f for f in _loose(rows.schema).fields if f.name not in known.fieldNames()]
    merged = StructType([*known.fields, *fresh])
    if fresh or not before:
        _log(spark, log, before, f"s-{uuid.uuid4().hex}", merged, folders)
    writer = rows.write.mode("append")
    if folders:
        writer = writer.partitionBy(*folders)
    writer.parquet(root)
    return read_logged(spark, path)


def read_logged(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table of ``append_logged`` in the columns and types of its log."""
    row = _newest(spark, f"{path.rstrip('/')}/_schema")
    if row is None:
        raise NotPublished(path)
    schema = StructType.fromJson(json.loads(row["schema"]))
    table = read_table(spark, path, schema=schema)
    return table.select(*(columns or schema.fieldNames()))
