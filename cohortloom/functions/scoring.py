"""Rule scores, weighted scores and the decision columns made from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortloom.functions.numeric import as_column, clip

Term = tuple[Column | str, float]


def rule_score(*rules: Column) -> Column:
    """How many rules hold, as double; NULL when any rule is undecided."""
    return reduce(add, [rule.cast("int") for rule in rules]).cast("double")


def weighted_score(terms: Sequence[Term]) -> Column:
    """Sum of ``expression * weight`` in double arithmetic, in the given order."""
    return reduce(
        add, [as_column(value).cast("double") * F.lit(float(weight)) for value, weight in terms]
    )


def label_score(
    terms: Sequence[Term],
    penalties: Sequence[tuple[Column, float]] = (),
    low: float = 0.0,
    high: float = 1.0,
) -> Column:
    """Weighted score less the penalties whose condition holds, clipped."""
    score = weighted_score(terms)
    for condition, amount in penalties:
        score = score - F.when(condition, F.lit(float(amount))).otherwise(F.lit(0.0))
    return clip(score, low, high)


def label_from_score(score: Column | str, cut: float = 0.5) -> Column:
    """1 at or above the cut, else 0."""
    return (as_column(score) >= F.lit(float(cut))).cast("int")


def logistic(terms: Sequence[Term], intercept: float = 0.0) -> Column:
    """Probability of a logistic model with fixed coefficients."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(float(intercept)) + weighted_score(terms))))
