"""Projections, filters, duplicates, casts and schema conformance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def in_ranges(bounds: Mapping[str, tuple[float, float]]) -> Column:
    """All columns inside their inclusive bounds; NULL and NaN are outside."""
    return reduce(and_, [F.col(name).between(low, high) for name, (low, high) in bounds.items()])


def range_filter(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every range; on raw columns the bounds reach the file scan."""
    return df.where(in_ranges(bounds))


def cohort_filter(df: DataFrame, **values: object) -> DataFrame:
    """Rows whose named columns equal the given values."""
    return df.where(reduce(and_, [F.col(name) == F.lit(value) for name, value in values.items()]))


def drop_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with a value, neither NULL nor NaN, in every required column."""
    return df.dropna(subset=list(required))


def drop_duplicate_rows(
    df: DataFrame, keys: Sequence[str] | None = None, prefer: Sequence[Column] = ()
) -> DataFrame:
    """Whole-row duplicates, or one row per key chosen by an explicit order.

    The key form keeps the row that is smallest in ``prefer``. It is an
    aggregate, not a window, so copies of a hot key are reduced before the
    shuffle.
    """
    if keys is None:
        return df.dropDuplicates()
    if not prefer:
        raise ValueError("a key subset needs an order that decides which row stays")
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    kept = df.groupBy(*keys).agg(
        F.min_by(F.struct(*others), F.struct(*prefer, *others)).alias("__row")
    )
    return kept.select(
        *[F.col(name) if name in keys else F.col(f"__row.{name}").alias(name) for name in df.columns]
    )


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Constant columns appended in one projection."""
    return df.select("*", *[F.lit(value).alias(name) for name, value in constants.items()])


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Columns cast in place; without ``strict`` a value that does not fit is NULL."""
    return df.select(
        *[
            (
                F.col(name).cast(types[name]) if strict else F.col(name).try_cast(types[name])
            ).alias(name)
            if name in types
            else F.col(name)
            for name in df.columns
        ]
    )


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """The frame in the target's columns, order and types.

    Missing columns come as NULL, columns the target lacks are left out. A value
    that does not fit is NULL, or with ``strict`` stops the query, whatever the
    session's cast mode.
    """
    fields = []
    for field in schema.fields:
        if field.name in df.columns:
            source = F.col(field.name)
            value = source.try_cast(field.dataType)
            if strict and df.schema[field.name].dataType != field.dataType:
                misfit = F.concat(F.lit(f"{field.name} does not hold "), source.cast("string"))
                value = F.when(source.isNotNull() & value.isNull(), F.raise_error(misfit)).otherwise(value)
        else:
            value = F.lit(None).cast(field.dataType)
        fields.append(value.alias(field.name))
    return df.select(*fields)
