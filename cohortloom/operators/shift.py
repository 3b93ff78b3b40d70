"""Covariate shift of an existing cohort, as a fixture for drift monitoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.numeric import clip, finite_or_null
from cohortloom.operators.ordered import column_summary


@dataclass(frozen=True)
class Shift:
    """``value * scale + offset``, rounded for ``whole`` numbers, then limited to ``[low, high]`` where given."""

    scale: float = 1.0
    offset: float = 0.0
    low: float | None = None
    high: float | None = None
    whole: bool = False

    def apply(self, value: Column) -> Column:
        moved = value.cast("double") * F.lit(float(self.scale)) + F.lit(float(self.offset))
        if self.whole:
            moved = F.floor(moved + F.lit(0.5)).cast("double")
        low = float("-inf") if self.low is None else self.low
        high = float("inf") if self.high is None else self.high
        return moved if self.low is None and self.high is None else clip(moved, low, high)


@dataclass(frozen=True)
class DiscreteShift:
    """A new value drawn with the given shares, by a digest of the row's key: the same in every run.

    A missing value stays missing.
    """

    shares: Mapping[int, float]
    key: Sequence[str]
    seed: str = "shift"

    def apply(self, value: Column) -> Column:
        digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in self.key], F.lit(self.seed)))
        coin = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
        drawn, reached = F.when(value.isNull(), F.lit(None)), 0.0
        values = list(self.shares)
        for name in values[:-1]:
            reached += self.shares[name]
            drawn = drawn.when(coin < F.lit(reached), F.lit(name))
        return drawn.otherwise(F.lit(values[-1]))


@dataclass(frozen=True)
class QuantileShift:
    """Values moved to a wanted distribution, in the order that the cohort's own values have.

    ``wanted`` has (share, value) points from share 0 to share 1, values in between by straight lines.
    The cohort is counted over value ranges, ``ranges`` of about equal counts or those between ``limits``, and a value's
    share is its place in its range. So a wanted quantile is met up to the share of rows in
    the fullest range, or at one value. ``whole`` rounds the new values to whole numbers.
    """

    wanted: Sequence[tuple[float, float]]
    whole: bool = False
    ranges: int = 256
    limits: Sequence[float] | None = None

    def __post_init__(self) -> None:
        shares, values = [p for p, _ in self.wanted], [v for _, v in self.wanted]
        if len(shares) < 2 or shares[0] != 0 or shares[-1] != 1 or sorted(set(shares)) != shares or sorted(values) != values:
            raise ValueError("wanted points go from share 0 to share 1, shares and values rising")

    def value_at(self, share: Column) -> Column:
        points = list(self.wanted)
        found = F.lit(float(points[-1][1]))
        for (p, a), (q, b) in reversed(list(zip(points, points[1:]))):
            line = F.lit(float(a)) + (share - F.lit(float(p))) / F.lit(float(q - p)) * F.lit(float(b) - float(a))
            found = F.when(share <= F.lit(float(q)), line).otherwise(found)
        return F.floor(found + F.lit(0.5)).cast("double") if self.whole else found


def _with_shares(df: DataFrame, shifts: Mapping[str, QuantileShift], chosen: Column) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with range numbers added, and each column's share of chosen rows below a row's value.

    Two passes over the chosen rows for all columns: limits and bounds, counts by range (columns x ranges
    numbers reach the driver).
    """
    names = list(shifts)
    own = df.where(chosen)
    open_ended = [c for c in names if shifts[c].limits is None]
    found = column_summary(own, open_ended, names, max([shifts[c].ranges for c in open_ended], default=2))
    limits = {}
    for name in names:
        low, high = found[name].low, found[name].high
        inner = found[name].splits if shifts[name].limits is None else shifts[name].limits
        limits[name] = [low, *[float(x) for x in inner if low is not None and low < x < high], high]
    ranges = {name: f"__range_{name}" for name in names}
    inputs = {name: f"__value_{name}" for name in names}
    split = [[float("-inf"), *(limits[c][1:-1] or [0.0]), float("inf")] for c in names]
    wide = df.select("*", *[finite_or_null(c).alias(inputs[c]) for c in names])
    ranged = Bucketizer(inputCols=list(inputs.values()), outputCols=list(ranges.values()), splitsArray=split, handleInvalid="keep").transform(wide)
    entries = [F.struct(F.lit(i).alias("column"), F.when(F.col(inputs[c]).isNotNull(), F.col(ranges[c]).cast("int")).alias("range")) for i, c in enumerate(names)]
    counts = ranged.where(chosen).select(F.inline(F.array(*entries))).where(F.col("range").isNotNull()).groupBy("column", "range").agg(F.count(F.lit(1)).alias("n")).collect()
    shares = {}
    for i, name in enumerate(names):
        inner = limits[name][1:-1]
        n = [0] * (len(inner) + 1 if inner else 2)
        for r in counts:
            if r["column"] == i:
                n[r["range"]] = r["n"]
        if not inner:
            n = [sum(n)]
        total, below = sum(n), 0
        starts, widths, lows, highs = [], [], [], []
        for k, rows in enumerate(n):
            starts.append(below / total if total else 0.0)
            widths.append(rows / total if total else 0.0)
            lows.append(limits[name][k])
            highs.append(limits[name][k + 1])
            below += rows
        at = F.lit(1) if not inner else F.col(ranges[name]).cast("int") + 1
        pick = lambda values, at=at: F.element_at(F.array(*[F.lit(x).cast("double") for x in values]), at)
        place = F.coalesce(F.try_divide(F.col(inputs[name]) - pick(lows), pick(highs) - pick(lows)), F.lit(0.5))
        shares[name] = F.when(F.col(inputs[name]).isNotNull(), pick(starts) + place * pick(widths))
    return ranged, shares


def shift_cohort(
    df: DataFrame,
    shifts: Mapping[str, Shift | DiscreteShift | QuantileShift],
    where: Column | None = None,
    version: str | None = None,
    version_column: str = "data_version",
) -> DataFrame:
    """The frame with the named columns shifted, in one projection.

    Columns with a :class:`QuantileShift` are counted first, over the shifted rows only; their missing and infinite values stay. ``where`` limits the shift to some rows; ``version`` writes a new data
    version onto the shifted rows.
    """
    chosen = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    columns, source, shares = [], df, {}
    by_quantile = {c: s for c, s in shifts.items() if isinstance(s, QuantileShift) and c in df.columns}
    if by_quantile:
        source, shares = _with_shares(df, by_quantile, chosen)
    for name in df.columns:
        if name in by_quantile:
            number = F.col(name).cast("double")
            moved = F.coalesce(by_quantile[name].value_at(shares[name]), number)
            columns.append(F.when(chosen & shares[name].isNotNull(), moved).otherwise(number).alias(name))
        elif isinstance(shifts.get(name), DiscreteShift):
            kind = df.schema[name].dataType
            columns.append(F.when(chosen, shifts[name].apply(F.col(name)).cast(kind)).otherwise(F.col(name)).alias(name))
        elif name in shifts:
            moved = F.when(chosen, shifts[name].apply(F.col(name))).otherwise(F.col(name).cast("double"))
            columns.append(moved.alias(name))
        elif name == version_column and version is not None:
            columns.append(F.when(chosen, F.lit(version)).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    if version is not None and version_column not in df.columns:
        columns.append(F.when(chosen, F.lit(version)).alias(version_column))
    return source.select(*columns)
