"""Raw table to clean table to feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.category import normalise_text
from cohortloom.functions.numeric import min_max_columns, round_decimal
from cohortloom.operators.columns import drop_missing, range_filter


@dataclass(frozen=True)
class CleaningRules:
    """What a clean row is, and how its columns are stored."""

    required: Sequence[str]
    bounds: Mapping[str, tuple[float, float]]
    types: Mapping[str, str] = field(default_factory=dict)
    categories: Sequence[str] = ()
    tags: Mapping[str, object] = field(default_factory=dict)


def clean_table(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Distinct rows with all required values inside their bounds, typed and tagged.

    The row filters come before the duplicate removal: the result is the same,
    the bounds reach the file scan and fewer rows are shuffled.
    """
    kept = range_filter(drop_missing(df, rules.required), rules.bounds).dropDuplicates()
    columns = []
    for name in df.columns:
        value: Column = F.col(name)
        if name in rules.categories:
            value = normalise_text(value)
        if name in rules.types:
            value = value.cast(rules.types[name])
        columns.append(value.alias(name))
    return kept.select(*columns, *[F.lit(v).alias(n) for n, v in rules.tags.items()])


@dataclass(frozen=True)
class FeatureRules:
    """The features of a table: columns taken over, derived columns, fixed-bounds scales."""

    raw: Sequence[str]
    derived: Mapping[str, Column]
    bounds: Mapping[str, tuple[float, float]]
    metadata: Sequence[str] = ()

    def names(self) -> list[str]:
        """Feature names in table order, without the metadata."""
        return [*self.raw, *self.derived, *[f"{c}_norm" for c in self.bounds]]


def gold_features(df: DataFrame, rules: FeatureRules, digits: int = 4, rounding=round_decimal) -> DataFrame:
    """Raw, derived and scaled features with the metadata columns.

    A single projection: no shuffle, no Python worker, only the needed columns
    are scanned.
    """
    return df.select(
        *rules.raw,
        *[value.alias(name) for name, value in rules.derived.items()],
        *min_max_columns(rules.bounds, digits, rounding=rounding),
        *rules.metadata,
    )
