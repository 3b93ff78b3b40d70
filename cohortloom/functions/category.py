"""Text categories: normalising, dictionary codes, ordered buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import as_column


def normalise_text(value: Column | str) -> Column:
    """Trimmed and upper-cased."""
    return F.upper(F.trim(as_column(value)))


def encode(value: Column | str, codes: Mapping[str, int], default: int | None) -> Column:
    """Integer code of a category; ``default`` for unknown and NULL.

    The dictionary becomes a literal in the plan; the caller chooses between
    this and ``encode_by_table``, which serves long ones better.
    """
    pairs = [F.lit(part) for item in codes.items() for part in item]
    found = F.create_map(*pairs)[as_column(value)]
    return F.coalesce(found, F.lit(default)).cast("int")


def encode_by_table(
    df: DataFrame,
    column: str,
    dictionary: DataFrame,
    key: str,
    code: str,
    output: str,
    default: int | None,
    known_unique: bool = False,
) -> DataFrame:
    """Dictionary encoding against a table of any size, whose keys must be unique.

    No broadcast hint: Spark broadcasts the dictionary when its size statistics
    allow it, and otherwise sort-merges, where adaptive execution splits a hot
    category, unknown ones included, over several tasks. For that both inputs
    must reach the join straight from their shuffles, so repeated keys are
    checked for beforehand instead of being reduced on the way, by a job that a
    caller who knows them to be unique can save.
    """
    lookup = dictionary.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.col(code).cast("int").alias("__code")
    )
    if not known_unique and not lookup.groupBy("__key").count().where("count > 1").isEmpty():
        raise ValueError(f"the dictionary has repeated keys in {key}")
    return df.join(lookup, df[column] == lookup["__key"], "left").select(
        *[df[name] for name in df.columns],
        F.coalesce(F.col("__code"), F.lit(default)).cast("int").alias(output),
    )


def bucketize(
    value: Column | str,
    steps: Sequence[tuple[float, str]],
    otherwise: str,
    null_label: str | None = None,
) -> Column:
    """Label of the first step whose upper limit is above the value.

    NULL and NaN get ``null_label`` instead of falling into the last bucket.
    """
    number = as_column(value).cast("double")
    label = F.when(number.isNull() | F.isnan(number), F.lit(null_label))
    for limit, name in steps:
        label = label.when(number < F.lit(float(limit)), F.lit(name))
    return label.otherwise(F.lit(otherwise))
