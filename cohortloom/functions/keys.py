"""Row keys, split assignment and run metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of the natural key: the same row gets the same key in every run.

    Separators inside a text are escaped and NULL has its own mark, so that
    different keys never share one text.
    """
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        if not isinstance(df.schema[name].dataType, NumericType):
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(text, F.lit("\\N")))
    return F.sha2(F.concat_ws("|", *parts), 256)


def split_by_hash(
    columns: Sequence[str], train_percent: int = 80, names: tuple[str, str] = ("train", "validation")
) -> Column:
    """Cohort from a digest of the key: stable for a row in any engine, no sort, no row numbering."""
    text = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("\\N")) for name in columns])
    slot = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100
    return F.when(slot < train_percent, names[0]).otherwise(names[1])


def split_by_mod(
    column: str, parts: int = 5, train_parts: int = 4, names: tuple[str, str] = ("train", "validation")
) -> Column:
    """Cohort from the remainder of an integer key."""
    slot = F.pmod(F.col(column), F.lit(parts))
    return F.when(slot < train_parts, names[0]).otherwise(names[1])


def run_metadata(at: Column, constants: Mapping[str, str]) -> list[Column]:
    """Batch id and ISO time made from the caller's timestamp, plus constant tags."""
    return [
        F.date_format(at, "yyyyMMdd_HHmmss").alias("batch_id"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("run_at"),
        *[F.lit(value).alias(name) for name, value in constants.items()],
    ]
