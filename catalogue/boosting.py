"""Regularised boosted trees: samples, splits, curves, importances, scoring by alias."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.models import FEATURES, line_trainable
from catalogue.registry import num, query, rounded, sql_round
from cohortloom.functions.numeric import round_floor
from cohortloom.operators.boosting import (
    BoostedTrees,
    Tree,
    TreeSettings,
    fit_trees,
    gain_importance,
    probability,
    training_auc_curve,
    trees_frame,
    trees_from,
    with_margin,
)
from cohortloom.operators.classifier import scored_columns
from cohortloom.operators.evaluation import balanced_weight, roc_auc
from cohortloom.operators.lifecycle import alias_resolution
from cohortloom.operators.sampling import exact_sample
from cohortloom.session import fresh_path
from cohortloom.sources.sinks import append_evolving, write_table
from cohortloom.sources.tables import fixture

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
#: Bound of the training rows, per class: the rows with the smallest key places.
ROWS_PER_CLASS = 2_000
FULL = TreeSettings()


@query(
    "exact_sample",
    """
    SELECT doc_id, quality FROM (
      SELECT doc_id, quality, row_number() OVER (
        PARTITION BY quality ORDER BY CAST('0x' || substr(md5('7|' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT), doc_id) AS place
      FROM labels) WHERE place <= 60
    """,
)
def sampled_labels(spark, folder):
    return exact_sample(fixture(spark, folder, "labels", ["doc_id", "quality"]), ["doc_id"], 60, ["quality"], seed=7)


ROOT_FEATURES = {"l_quantity": [float(i) for i in range(1, 50)], "l_discount": [i / 100 for i in range(10)], "l_tax": [i / 100 for i in range(8)]}
ROOT = TreeSettings(trees=1, depth=1, row_share=1.0, feature_share=1.0, learning_rate=0.3)


def _score_sql(g, h):
    return f"(pow(greatest(abs({g}) - {num(ROOT.l1)}, 0), 2) / ({h} + {num(ROOT.l2)}))"


def _leaf_sql(g, h):
    return f"(-{num(ROOT.learning_rate)} * sign({g}) * greatest(abs({g}) - {num(ROOT.l1)}, 0) / ({h} + {num(ROOT.l2)}))"


@query(
    "boosted_root_split",
    f"""
    WITH y AS (SELECT *, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem),
    c AS ({" UNION ALL ".join(f"SELECT {place} AS place, '{name}' AS feature, unnest({values}::DOUBLE[]) AS lim" for place, (name, values) in enumerate(ROOT_FEATURES.items()))}),
    v AS ({" UNION ALL ".join(f"SELECT '{name}' AS feature, {name} AS x, y FROM y" for name in ROOT_FEATURES)}),
    t AS (SELECT sum(0.5::DOUBLE - y) AS g, count(*) * 0.25::DOUBLE AS h FROM y),
    s AS (SELECT place, c.feature, lim, sum(0.5::DOUBLE - y) AS gl, count(*) * 0.25::DOUBLE AS hl
          FROM c JOIN v ON v.feature = c.feature AND v.x <= c.lim GROUP BY 1, 2, 3),
    b AS (SELECT place, feature, lim, gl, hl, g - gl AS gr, h - hl AS hr,
                 ({_score_sql('gl', 'hl')} + {_score_sql('(g - gl)', '(h - hl)')} - {_score_sql('g', 'h')}) / 2 - {num(ROOT.min_gain)} AS gain
          FROM s, t WHERE hl >= {num(ROOT.min_weight)} AND h - hl >= {num(ROOT.min_weight)})
    SELECT feature, lim AS "limit", {sql_round('gain', 6)} AS gain, {sql_round(_leaf_sql('gl', 'hl'), 9)} AS left_value,
           {sql_round(_leaf_sql('gr', 'hr'), 9)} AS right_value, hl AS left_cover, hr AS right_cover
    FROM b ORDER BY b.gain DESC, place, lim LIMIT 1
    """,
)
def root_split(spark, folder):
    """The first split of the first tree over all lines, its gain and its leaves."""
    lines = fixture(spark, folder, "lineitem", [*KEY, "l_returnflag", *ROOT_FEATURES])
    labelled = lines.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    nodes = trees_frame(spark, fit_trees(labelled, list(ROOT_FEATURES), "returned", KEY, settings=ROOT, limits=list(ROOT_FEATURES.values())))
    at = lambda node, column: F.max(F.when(F.col("node") == node, F.col(column)))
    found = nodes.agg(
        at(1, "feature").alias("feature"), at(1, "limit").alias("limit"), at(1, "gain").alias("gain"),
        at(2, "value").alias("left_value"), at(3, "value").alias("right_value"), at(2, "cover").alias("left_cover"), at(3, "cover").alias("right_cover"),
    )
    return rounded(found, {"gain": 6, "left_value": 9, "right_value": 9})


STUMPS = [("l_quantity", 24.0, -0.25, 0.5), ("l_tax", 0.03, 0.125, -0.5), ("l_discount", 0.05, 0.0625, -0.125), ("l_quantity", 10.0, 0.75, -0.0625),
          ("l_extendedprice", 40000.0, -0.5, 0.25), ("l_quantity", 40.0, 0.03125, -1.0)]


def given_trees():
    model = BoostedTrees(FEATURES)
    for feature, limit, left, right in STUMPS:
        tree = Tree.empty(1)
        tree.feature[1], tree.limit[1], tree.value[2], tree.value[3] = FEATURES.index(feature), limit, left, right
        model.trees.append(tree)
    return model


@query(
    "auc_by_round",
    f"""
    WITH v AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, {", ".join(f"CASE WHEN {f} <= {num(x)} THEN {num(a)} ELSE {num(b)} END AS v{i}" for i, (f, x, a, b) in enumerate(STUMPS, 1))} FROM lineitem),
    m AS ({" UNION ALL ".join(f"SELECT {i} AS tree_count, y, {' + '.join(f'v{j}' for j in range(1, i + 1))} AS s FROM v" for i in range(1, len(STUMPS) + 1))}),
    c AS (SELECT tree_count, s, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS n FROM m GROUP BY 1, 2),
    a AS (SELECT *, sum(n) OVER (PARTITION BY tree_count ORDER BY s) - n AS below FROM c)
    SELECT tree_count, {sql_round('sum(p * (below + n / 2)) / (sum(p) * sum(n))', 9)} AS roc_auc,
           {sql_round('sum(p * ln(1 + exp(-s)) + n * ln(1 + exp(s))) / sum(p + n)', 9)} AS loss
    FROM a GROUP BY 1
    """,
)
def given_curve(spark, folder):
    """Area and loss on all lines after each of six given trees."""
    lines = fixture(spark, folder, "lineitem", ["l_returnflag", *FEATURES]).withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return rounded(training_auc_curve(given_trees(), lines, "returned"), {"roc_auc": 9, "loss": 9})


_FITTED: dict[tuple[str, str], str] = {}


def _full_fit(spark, folder):
    """Rows of a model with the default settings, fitted on the bounded sample; one fit serves all queries of a session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FITTED:
        sample = exact_sample(line_trainable(spark, folder, KEY).where("data_split = 'train'"), KEY, ROWS_PER_CLASS, ["label"])
        # weights, split limits and blocks read the bounded sample, not the lines again
        train = write_table(sample, fresh_path(spark, "train-rows"))
        path = fresh_path(spark, "trees")
        write_table(trees_frame(spark, fit_trees(balanced_weight(train, "label"), FEATURES, "label", KEY, "sample_weight", FULL)), path)
        _FITTED[key] = path
    return spark.read.parquet(_FITTED[key])


@query("training_auc_curve", f"SELECT CAST({FULL.trees} AS BIGINT) AS trees, TRUE AS in_order, TRUE AS last_is_roc_auc, TRUE AS loss_falls, TRUE AS above_chance")
def full_curve(spark, folder):
    """300 regularised trees of depth 6: area and loss on the held-out lines after each, held against the area of the scored rows."""
    model = trees_from(_full_fit(spark, folder), FEATURES)
    held_out = line_trainable(spark, folder, KEY).where("data_split <> 'train'")
    curve = write_table(training_auc_curve(model, held_out, "label"), fresh_path(spark, "curve"))
    scored = with_margin(model, held_out)
    area = roc_auc(scored, "label", "margin").first().roc_auc
    last = F.max_by("roc_auc", "tree_count")
    return curve.agg(
        F.count(F.lit(1)).alias("trees"),
        (F.min("tree_count").eqNullSafe(1) & (F.max("tree_count") == F.count(F.lit(1)))).alias("in_order"),
        (F.abs(last - F.lit(area)) < 1e-12).alias("last_is_roc_auc"),
        (F.max_by("loss", "tree_count") < F.min_by("loss", "tree_count")).alias("loss_falls"),
        (last > 0.5).alias("above_chance"),
    )


@query("gain_importance", " UNION ALL ".join(f"SELECT '{c}' AS feature, TRUE AS sums_the_gains, TRUE AS in_range, TRUE AS sums_to_one" for c in FEATURES))
def full_importance(spark, folder):
    """Total gain of each feature in the saved trees, held against a plain sum over the model."""
    saved = _full_fit(spark, folder)
    model = trees_from(saved, FEATURES)
    gains = {name: float(sum(t.gain[t.feature == i].sum() for t in model.trees)) for i, name in enumerate(FEATURES)}
    found = gain_importance(saved, FEATURES)
    expected = F.element_at(F.create_map(*[F.lit(x) for pair in gains.items() for x in pair]), F.col("feature"))
    total = found.agg(F.sum("importance")).scalar()
    return found.select(
        "feature", (F.abs(F.col("total_gain") - expected) <= 1e-9 * (1 + expected)).alias("sums_the_gains"),
        F.col("importance").between(0, 1).alias("in_range"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
    )


VERSIONS_SQL = " UNION ALL ".join(
    f"SELECT {version} AS version, l_orderkey, {' + '.join(f'CASE WHEN {f} <= {num(x)} THEN {num(a)} ELSE {num(b)} END' for f, x, a, b in STUMPS[:trees])} AS margin FROM lineitem"
    for version, trees in ((1, 2), (2, 6))
)


@query(
    "score_by_alias",
    f"""
    SELECT CASE version WHEN 1 THEN 'champion' ELSE 'challenger' END AS alias, CAST(version AS VARCHAR) AS version, l_orderkey,
           {sql_round('1 / (1 + exp(-margin))', 9)} AS prediction_prob, CAST(1 / (1 + exp(-margin)) > 0.5 AS INTEGER) AS prediction
    FROM ({VERSIONS_SQL})
    """,
)
def score_by_alias(spark, folder):
    """Two registered versions; the registration log says which one an alias names, and that one's saved trees score."""
    log = fresh_path(spark, "registrations")
    for version, count in (("1", 2), ("2", 6)):
        model = given_trees()
        model.trees = model.trees[:count]
        path = fresh_path(spark, f"model-{version}")
        write_table(trees_frame(spark, model), path)
        row = spark.createDataFrame([("efficacy", version, f"2024-01-0{version}", path)], "model string, version string, registered_at string, path string")
        registrations = append_evolving(row, log)
    named = alias_resolution(registrations, "model", "version", "registered_at", "version").where("model = 'efficacy'")
    lines = fixture(spark, folder, "lineitem", ["l_orderkey", *FEATURES])
    parts = []
    for alias in ("champion", "challenger"):
        # one row: the path that the alias leads to
        found = named.select(F.col(alias).alias("version")).join(registrations, "version").select("version", "path").first()
        scored = with_margin(trees_from(spark.read.parquet(found.path), FEATURES), lines)
        columns = scored_columns(probability(F.col("margin")), None, rounding=round_floor, digits=9)
        parts.append(scored.select(F.lit(alias).alias("alias"), F.lit(found.version).alias("version"), "l_orderkey", *columns).select("alias", "version", "l_orderkey", "prediction_prob", "prediction"))
    return parts[0].unionByName(parts[1])
