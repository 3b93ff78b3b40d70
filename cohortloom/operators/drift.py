"""Distribution drift between a reference cohort and a current cohort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions.numeric import finite_or_null, real_or_null
from cohortloom.operators.ordered import column_summary, range_count, running_counts

# Severity limits, highest first, with the severity and the action
# each one calls for; below the last limit a feature is STABLE and needs NO_ACTION.
LADDER = [
    (0.35, "CRITICAL", "IMMEDIATE_ROLLBACK"),
    (0.25, "SEVERE", "RETRAIN"),
    (0.20, "MODERATE", "SCHEDULE_RETRAIN"),
    (0.10, "WARNING", "MONITOR"),
]
CALM = ("STABLE", "NO_ACTION")

DISTANCES = ("wasserstein", "ks", "psi", "js")


@dataclass(frozen=True)
class Monitor:
    """A feature, the distance to watch, and the score from which it has drifted."""

    feature: str
    statistic: str = "wasserstein"
    threshold: float = 0.1

    def __post_init__(self) -> None:
        if self.statistic not in DISTANCES:
            raise ValueError(f"{self.statistic} is not a distance; choose one of {DISTANCES}")


def drift_long(df: DataFrame, features: Sequence[str], is_reference: Column) -> DataFrame:
    """(feature, value, is_reference): both cohorts from one scan, missing values and rows of neither left out."""
    return (
        df.select(is_reference.alias("is_reference"), *[F.col(c).cast("double").alias(c) for c in features])
        .unpivot(["is_reference"], list(features), "feature", "value")
        .where(F.col("is_reference").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
        .select("feature", "value", "is_reference")
    )


def _all_named(df: DataFrame, keys: Sequence[tuple[str, ...]], columns: Sequence[str]) -> DataFrame:
    """One row for each of the keys, which are the caller's own list; what is missing in ``df`` is NULL there."""
    named = df.sparkSession.createDataFrame(list(dict.fromkeys(keys)), ", ".join(f"{c} string" for c in columns))
    return named.join(df, list(columns), "left")


def _rows(condition: Column, count: str | None) -> Column:
    """Rows that a row stands for where the condition holds, else 0."""
    return condition if count is None else F.when(condition, F.col(count)).otherwise(F.lit(0))


def ordered_distances(
    df: DataFrame,
    features: Sequence[str],
    is_reference: Column,
    ranges: int | None = None,
    splits: Mapping[str, Sequence[float]] | None = None,
    count: str | None = None,
) -> DataFrame:
    """(feature, wasserstein, wasserstein_norm, ks) from one ordered pass.

    The area between the two distribution functions, the same divided by the
    reference's standard deviation (at least 0.001), and their largest
    difference. NULL when a cohort has no values. ``count`` names the column that
    says how many rows a row stands for.
    """
    if splits is None:
        found = column_summary(df, features, ranges=range_count(df, ranges))
        splits = {c: found[c].splits for c in features}
    curve = running_counts(df, features, {"ref": _rows(is_reference, count), "cur": _rows(~is_reference, count)}, splits)
    # between the previous value and this one both distribution functions are flat
    gap = F.abs(
        F.try_divide(F.col("ref_below").cast("double"), F.col("ref_total").cast("double"))
        - F.try_divide(F.col("cur_below").cast("double"), F.col("cur_total").cast("double"))
    )
    mean = F.try_divide(F.col("ref_sum"), F.col("ref_total").cast("double"))
    off = F.col("value") - mean
    sums = curve.groupBy("feature").agg(
        F.sum(gap * F.coalesce(F.col("value") - F.col("previous_value"), F.lit(0.0))).alias("wasserstein"),
        F.max(gap).alias("ks"),
        F.sum(F.col("ref") * off * off).alias("squares"),
        F.max("ref_total").cast("double").alias("ref_total"),
    )
    spread = F.greatest(F.sqrt(F.try_divide(F.col("squares"), F.col("ref_total"))), F.lit(0.001))
    found = sums.select(
        "feature", "wasserstein", (F.col("wasserstein") / spread).alias("wasserstein_norm"), "ks"
    )
    return _all_named(found, [(c,) for c in features], ["feature"])


def wasserstein(
    df: DataFrame, features: Sequence[str], is_reference: Column, ranges: int | None = None
) -> DataFrame:
    """(feature, wasserstein, wasserstein_norm)."""
    return ordered_distances(df, features, is_reference, ranges).drop("ks")


def kolmogorov_smirnov(
    df: DataFrame, features: Sequence[str], is_reference: Column, ranges: int | None = None
) -> DataFrame:
    """(feature, ks): the largest difference of the two distribution functions."""
    return ordered_distances(df, features, is_reference, ranges).select("feature", "ks")


def equal_width(value: Column, low: float | None, high: float | None, bins: int) -> Column:
    """Bin 0 to ``bins - 1`` between the bounds, the upper bound in the last bin."""
    if low is None or high is None or high <= low:
        return F.when(value.isNotNull(), F.lit(0))
    place = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
    # least and greatest pass over NULL, which is in no bin
    return F.when(value.isNotNull(), F.greatest(F.least(place, F.lit(bins - 1)), F.lit(0)).cast("int"))


def _shares_by_cell(
    df: DataFrame,
    binned: Mapping[str, Column],
    categories: Sequence[str],
    is_reference: Column,
    count: str | None = None,
) -> DataFrame:
    """Cohort counts per (feature, cell) with the cohort totals of the feature.

    A cell is a bin number or a category text; NULL and NaN are in none. All
    features share one scan, and rows are reduced to their cells before anything
    is shuffled.
    """
    no_bin, no_text = F.lit(None).cast("int"), F.lit(None).cast("string")
    kinds = dict(df.dtypes)
    texts = {c: real_or_null(c) if kinds[c] in ("double", "float") else F.col(c) for c in categories}
    entries = [
        F.struct(F.lit(c).alias("feature"), cell.cast("int").alias("bin"), no_text.alias("category"))
        for c, cell in binned.items()
    ] + [
        F.struct(F.lit(c).alias("feature"), no_bin.alias("bin"), text.cast("string").alias("category"))
        for c, text in texts.items()
    ]
    n = F.lit(1) if count is None else F.col(count)
    rows = df.select(is_reference.alias("is_reference"), n.alias("n"), F.inline(F.array(*entries))).where(
        F.col("is_reference").isNotNull() & (F.col("bin").isNotNull() | F.col("category").isNotNull())
    )
    counts = rows.groupBy("feature", "bin", "category").agg(
        F.sum(F.when(F.col("is_reference"), F.col("n")).otherwise(0)).cast("double").alias("ref"),
        F.sum(F.when(F.col("is_reference"), 0).otherwise(F.col("n"))).cast("double").alias("cur"),
    )
    totals = counts.groupBy("feature").agg(
        F.sum("ref").alias("ref_total"), F.sum("cur").alias("cur_total")
    )
    # totals: one row per monitored feature
    return counts.join(F.broadcast(totals), "feature")


def _psi(floor: float) -> Column:
    p = F.try_divide(F.col("ref"), F.col("ref_total"))
    q = F.try_divide(F.col("cur"), F.col("cur_total"))
    p = F.when(p < floor, F.lit(floor)).otherwise(p)
    q = F.when(q < floor, F.lit(floor)).otherwise(q)
    return F.sum((p - q) * F.ln(p / q))


def _js() -> Column:
    p = F.try_divide(F.col("ref"), F.col("ref_total"))
    q = F.try_divide(F.col("cur"), F.col("cur_total"))
    mid = (p + q) / 2

    def part(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / mid)).when(share == 0, F.lit(0.0))

    divergence = F.sum((part(p) + part(q)) / 2)
    return F.sqrt(F.when(divergence < 0, F.lit(0.0)).otherwise(divergence))


def _bins(
    df: DataFrame,
    features: Sequence[str],
    is_reference: Column,
    bins: int,
    edges: Mapping[str, Sequence[float]] | None,
) -> dict[str, Column]:
    """Bin column of each feature: by its own edges, else of equal width."""
    edges = edges or {}
    open_ended = [c for c in features if c not in edges]
    found = column_summary(df.where(is_reference.isNotNull()), [], open_ended) if open_ended else {}
    cells = {c: equal_width(finite_or_null(c), found[c].low, found[c].high, bins) for c in open_ended}
    for name in edges:
        value = finite_or_null(name)
        above = [(value >= F.lit(float(e))).cast("int") for e in edges[name]]
        cells[name] = reduce(lambda a, b: a + b, above)
    return {c: cells[c] for c in features}


def population_stability(
    df: DataFrame,
    features: Sequence[str],
    is_reference: Column,
    bins: int = 10,
    floor: float = 1e-4,
    edges: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """(feature, psi): population stability index.

    Bins are of equal width between the smallest and largest value of both
    cohorts, or as given in ``edges`` (interior limits, such as quantiles of the
    reference). Shares below ``floor`` are raised to it.
    """
    cells = _bins(df, features, is_reference, bins, edges)
    sums = _shares_by_cell(df, cells, [], is_reference).groupBy("feature").agg(_psi(floor).alias("psi"))
    return _all_named(sums, [(c,) for c in features], ["feature"])


def jensen_shannon(df: DataFrame, features: Sequence[str], is_reference: Column) -> DataFrame:
    """(feature, js): Jensen-Shannon distance of category shares, natural logarithm."""
    sums = _shares_by_cell(df, {}, features, is_reference).groupBy("feature").agg(_js().alias("js"))
    return _all_named(sums, [(c,) for c in features], ["feature"])


def chi_square(df: DataFrame, features: Sequence[str], is_reference: Column) -> DataFrame:
    """(feature, chi2, degrees): statistic of the cohort x category table.

    Not a distance: it grows with the row count, so no severity is read from it.
    """
    both = F.col("ref_total") + F.col("cur_total")
    column = F.col("ref") + F.col("cur")

    def part(observed: str, total: str) -> Column:
        expected = F.try_divide(F.col(total) * column, both)
        return F.try_divide((F.col(observed) - expected) * (F.col(observed) - expected), expected)

    sums = (
        _shares_by_cell(df, {}, features, is_reference)
        .groupBy("feature")
        .agg(
            F.sum(part("ref", "ref_total") + part("cur", "cur_total")).alias("chi2"),
            (F.count(F.lit(1)) - 1).alias("degrees"),
        )
    )
    return _all_named(sums, [(c,) for c in features], ["feature"])


def drift_scores(
    df: DataFrame,
    is_reference: Column,
    monitors: Sequence[Monitor],
    *,
    bins: int = 10,
    floor: float = 1e-4,
    ranges: int | None = None,
    splits: Mapping[str, Sequence[float]] | None = None,
    count: str | None = None,
) -> DataFrame:
    """(feature, statistic, drift_score, drift_detected): one row per monitor.

    Three passes however many monitors there are: bounds and range limits of
    the numeric features, the ordered statistics, the counts by cell. Each
    reads only its own columns. ``splits`` are range limits known from an earlier
    run, such as yesterday's: any increasing limits give the same scores, and
    the features that have them are left out of the first pass. ``count`` names
    the column that says how many rows a row stands for. A feature with
    an empty cohort has a NULL score.
    """
    by_kind = {k: [m.feature for m in monitors if m.statistic == k] for k in DISTANCES}
    ordered = list(dict.fromkeys(by_kind["wasserstein"] + by_kind["ks"]))
    rows = df.where(is_reference.isNotNull())
    limits = {c: splits[c] for c in ordered if c in (splits or {})}
    unknown = [c for c in ordered if c not in limits]
    found = {}
    if unknown or by_kind["psi"]:
        found = column_summary(rows, unknown, by_kind["psi"], range_count(df, ranges))
    limits.update({c: found[c].splits for c in unknown})
    parts = []
    if ordered:
        both = ordered_distances(rows, ordered, is_reference, splits=limits, count=count)
        parts.append(
            _scores(both, {"wasserstein": "wasserstein_norm", "ks": "ks"}, by_kind)
        )
    if by_kind["psi"] or by_kind["js"]:
        cells = {
            c: equal_width(finite_or_null(c), found[c].low, found[c].high, bins) for c in by_kind["psi"]
        }
        shares = _shares_by_cell(rows, cells, by_kind["js"], is_reference, count).groupBy(
            "feature", F.col("category").isNull().alias("is_binned")
        )
        sums = shares.agg(_psi(floor).alias("psi"), _js().alias("js"))
        parts.append(
            sums.select(
                "feature",
                F.when(F.col("is_binned"), "psi").otherwise("js").alias("statistic"),
                F.when(F.col("is_binned"), F.col("psi")).otherwise(F.col("js")).alias("drift_score"),
            )
        )
    # a feature without any value is the one that a monitor must show
    scores = _all_named(reduce(DataFrame.unionByName, parts), [(m.feature, m.statistic) for m in monitors], ["feature", "statistic"])
    threshold = F.lit(None).cast("double")
    for m in monitors:
        own = (F.col("feature") == m.feature) & (F.col("statistic") == m.statistic)
        threshold = F.when(own, F.lit(float(m.threshold))).otherwise(threshold)
    return scores.select(
        "feature", "statistic", "drift_score", (F.col("drift_score") >= threshold).alias("drift_detected")
    )


def _scores(wide: DataFrame, columns: Mapping[str, str], by_kind: Mapping[str, Sequence[str]]) -> DataFrame:
    """(feature, statistic, drift_score) for the statistics each feature asked for."""
    entries = [
        F.when(
            F.col("feature").isin(by_kind[kind]),
            F.struct(F.lit(kind).alias("statistic"), F.col(column).alias("drift_score")),
        )
        for kind, column in columns.items()
        if by_kind[kind]
    ]
    return wide.select("feature", F.inline(F.array_compact(F.array(*entries))))


def _step(score: Column, position: int, calm: str, ladder: Sequence[tuple[float, str, str]]) -> Column:
    step = F.when(score.isNull(), F.lit(None).cast("string"))
    for rung in sorted(ladder, key=lambda x: -x[0]):
        step = step.when(score >= rung[0], rung[position])
    return step.otherwise(calm)


def severity(score: Column, ladder: Sequence[tuple[float, str, str]] = LADDER, calm: str = CALM[0]) -> Column:
    """Severity of an unrounded distance; NULL for NULL. ``ladder`` has (limit, severity, action)."""
    return _step(score, 1, calm, ladder)


def recommended_action(
    max_score: Column, ladder: Sequence[tuple[float, str, str]] = LADDER, calm: str = CALM[1]
) -> Column:
    """Action for the largest unrounded distance; NULL for NULL."""
    return _step(max_score, 2, calm, ladder)


def dataset_drift(
    scores: DataFrame, share_limit: float = 0.5, ladder: Sequence[tuple[float, str, str]] = LADDER
) -> DataFrame:
    """One row: monitored and drifted features, share, verdict, largest score, action.

    Features without a score are left out of the share.
    """
    best = F.max("drift_score")
    share = F.avg(F.col("drift_detected").cast("double"))
    return scores.agg(
        F.count("drift_score").alias("monitored"),
        F.count_if("drift_detected").alias("drifted"),
        share.alias("share_drifted"),
        (share >= F.lit(float(share_limit))).alias("dataset_drifted"),
        best.alias("max_score"),
        F.min_by("feature", F.when(F.col("drift_score").isNotNull(), F.struct(-F.col("drift_score"), F.col("feature")))).alias(
            "max_feature"
        ),
        recommended_action(best, ladder).alias("recommended_action"),
    )


def drift_log(
    scores: DataFrame,
    detected_at: Column,
    constants: Mapping[str, str],
    share_limit: float = 0.5,
    ladder: Sequence[tuple[float, str, str]] = LADDER,
) -> DataFrame:
    """Log rows: one per monitored feature, with the dataset's figures repeated.

    The windows run over one row per monitor.
    """
    tagged = scores.select("*", *[F.lit(v).alias(n) for n, v in constants.items()])
    whole = Window.partitionBy(*constants) if constants else Window.partitionBy()
    best = F.max("drift_score").over(whole)
    share = F.avg(F.col("drift_detected").cast("double")).over(whole)
    return tagged.select(
        detected_at.alias("detected_at"),
        *constants,
        "feature",
        "statistic",
        "drift_score",
        "drift_detected",
        severity(F.col("drift_score"), ladder).alias("severity"),
        best.alias("max_score"),
        recommended_action(best, ladder).alias("recommended_action"),
        (share >= F.lit(float(share_limit))).alias("dataset_drifted"),
        F.lit("new").alias("status"),
    )


def drift_report(log: DataFrame, detected_at: Column) -> DataFrame:
    """The rows of one detection, largest score first."""
    return (
        log.where(F.col("detected_at") == detected_at)
        .select("feature", "statistic", "drift_score", "drift_detected", "severity", "recommended_action")
        .orderBy(F.col("drift_score").desc_nulls_last(), "feature")
    )
