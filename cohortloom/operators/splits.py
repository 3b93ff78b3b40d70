"""Splitting a table by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from cohortloom.functions.numeric import finite_or_null
from cohortloom.operators.ordered import column_summary, range_count, running_counts


def split_by_position(
    df: DataFrame,
    order: str,
    share: float = 0.8,
    names: tuple[str, str] = ("train", "validation"),
    output: str = "data_split",
    ranges: int | None = None,
) -> DataFrame:
    """The first ``share`` of the rows in the order of a numeric column, exactly.

    The rows are not sorted or numbered: running counts give the value at which
    the share is reached, and each row is compared with that value. They work
    on doubles; whole and decimal numbers that share a double are told apart by
    their difference to it, in a second count over those rows only. Rows of
    equal value stay on one side, so ``order`` should be a key; rows without a
    finite value take no part and get NULL.
    """
    value = finite_or_null(order)
    rows = df.select(F.col(order).alias("key"), value.alias("place"))
    wanted = F.floor(F.col("rows_total") * F.lit(float(share)))

    def counts(part: DataFrame, column: str) -> DataFrame:
        splits = column_summary(part, [column], ranges=range_count(df, ranges))[column].splits
        return running_counts(part, [column], {"rows": F.lit(True)}, {column: splits})

    # the last double that some row before the limit has, and the rows that are wanted beyond those below it
    last = counts(rows, "place").where(F.col("rows_below") < wanted).agg(
        F.max_by(F.struct("value", (wanted - F.col("rows_below")).alias("more")), "value").alias("last")
    ).first()["last"]
    if last is None:
        side = F.when(value.isNotNull(), names[1])
        return df.select("*", side.alias(output))
    inside = F.lit(True)
    kind = df.schema[order].dataType
    if not isinstance(kind, (DoubleType, FloatType)):
        whole = f"decimal(38,{kind.scale if isinstance(kind, DecimalType) else 0})"
        offset = (F.col(order).cast(whole) - F.lit(last["value"]).cast(whole)).cast("double")
        near = rows.where(F.col("place") == F.lit(last["value"]))
        offsets = near.select((F.col("key").cast(whole) - F.lit(last["value"]).cast(whole)).cast("double").alias("offset"))
        cut = counts(offsets, "offset").where(F.col("rows_below") >= last["more"]).agg(F.min("value")).first()[0]
        if cut is not None:
            inside = offset < F.lit(cut)
    here = F.lit(last["value"])
    side = F.when(value < here, names[0]).when(value > here, names[1]).when(value == here, F.when(inside, names[0]).otherwise(names[1]))
    return df.select("*", side.alias(output))
