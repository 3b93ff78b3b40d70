"""Second-order boosting: splits against brute force, repeatability, curves, saved trees; exact samples."""

import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators.boosting import (
    BoostedTrees,
    Tree,
    TreeSettings,
    fit_trees,
    gain_importance,
    probability,
    split_limits,
    training_auc_curve,
    trees_frame,
    trees_from,
    with_margin,
    with_margins,
)
from cohortloom.operators.evaluation import roc_auc
from cohortloom.operators.sampling import exact_sample
from cohortloom.session import shared_folder

NAMES = ["a", "b", "c"]


def made_rows(spark, n=900, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.randint(0, 9), round(rnd.gauss(0, 1), 3), rnd.choice([0.0, 1.0, None, float("nan")])
        y = int(a + (2 if c == 1.0 else 0) + rnd.gauss(0, 2) > 5)
        rows.append((i, float(a) if rnd.random() < 0.95 else None, b, c, y, rnd.choice([0.5, 1.0, 2.0])))
    return rows, spark.createDataFrame(rows, "id long, a double, b double, c double, y int, w double")


def brute_tree(rows, limits, settings):
    """One tree over all rows and features, grown node by node from plain sums."""

    def total(part):
        return sum(w * (0.5 - y) for *_, y, w in part), sum(w * 0.25 for *_, w in part)

    def shrunk(g):
        return math.copysign(max(abs(g) - settings.l1, 0), g)

    def score(g, h):
        return shrunk(g) ** 2 / (h + settings.l2) if h + settings.l2 > 0 else 0.0

    nodes = {}

    def grow(node, part, level):
        g, h = total(part)
        best = None
        for f in range(len(limits) if level < settings.depth else 0):
            for limit in limits[f]:
                for missing_left in (True, False):
                    goes = [missing_left if r[f + 1] is None or math.isnan(r[f + 1]) else r[f + 1] <= limit for r in part]
                    left, right = [r for r, x in zip(part, goes) if x], [r for r, x in zip(part, goes) if not x]
                    (gl, hl), (gr, hr) = total(left), total(right)
                    gain = (score(gl, hl) + score(gr, hr) - score(g, h)) / 2 - settings.min_gain
                    if min(hl, hr) >= settings.min_weight and gain > 0 and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, limit, missing_left, left, right
        if best is None:
            nodes[node] = -settings.learning_rate * shrunk(g) / (h + settings.l2)
            return
        nodes[node] = best[:4]
        grow(2 * node, best[4], level + 1)
        grow(2 * node + 1, best[5], level + 1)

    grow(1, rows, 0)
    return nodes


@pytest.mark.parametrize("more", [{}, {"l1": 2.0, "l2": 0.0, "min_gain": 0.0, "min_weight": 1.0}, {"min_gain": 3.0}])
def test_a_tree_is_the_one_that_brute_force_grows(spark, more):
    settings = TreeSettings(trees=1, depth=3, row_share=1.0, feature_share=1.0, learning_rate=0.3, bins=12, **more)
    rows, frame = made_rows(spark)
    limits = split_limits(frame, NAMES, settings.bins, ["id"], 10_000)
    tree = fit_trees(frame, NAMES, "y", ["id"], "w", settings).trees[0]
    want = brute_tree(rows, limits, settings)
    for node, expected in want.items():
        if isinstance(expected, tuple):
            gain, f, limit, missing_left = expected
            assert (tree.feature[node], tree.limit[node], tree.missing_left[node]) == (f, limit, missing_left)
            assert tree.gain[node] == pytest.approx(gain, abs=1e-6)
        else:
            assert tree.feature[node] == -1 and tree.value[node] == pytest.approx(expected, abs=1e-7)


def test_limits_are_all_values_or_even_ranks(spark):
    _, frame = made_rows(spark)
    few, many, flag = split_limits(frame, NAMES, 12, ["id"], 10_000)
    assert few.tolist() == [float(x) for x in range(9)] and flag.tolist() == [0.0] and len(many) == 11


SMALL = TreeSettings(trees=25, depth=3, learning_rate=0.3)


def test_a_fit_does_not_depend_on_how_rows_are_dealt_out(spark):
    _, frame = made_rows(spark)
    folder = Path(f"{shared_folder(spark).removeprefix('file:')}/cohortloom")
    before = set(folder.glob("tree-rows-*"))
    one = fit_trees(frame, NAMES, "y", ["id"], "w", SMALL, partitions=1)
    other = fit_trees(frame.orderBy(F.rand(5)), NAMES, "y", ["id"], "w", SMALL, partitions=7)
    for x, y in zip(one.trees, other.trees, strict=True):
        assert np.array_equal(x.feature, y.feature) and np.array_equal(x.limit, y.limit) and np.array_equal(x.value, y.value)
    assert set(folder.glob("tree-rows-*")) == before  # what a fit wrote is gone


def test_saved_trees_score_the_same_and_their_gains_are_the_importances(spark):
    _, frame = made_rows(spark)
    model = fit_trees(frame, NAMES, "y", ["id"], settings=SMALL)
    saved = trees_frame(spark, model)
    again = trees_from(saved, NAMES)
    both = with_margin(again, with_margin(model, frame, "m"), "n")
    assert both.where("m <> n or m is null").isEmpty() and both.count() == frame.count()
    found = {r.feature: r for r in gain_importance(saved, [*NAMES, "unused"]).collect()}
    gains = {name: sum(t.gain[t.feature == i].sum() for t in model.trees) for i, name in enumerate(NAMES)}
    assert {n: r.total_gain for n, r in found.items()} == pytest.approx({**gains, "unused": 0.0})
    assert sum(r.importance for r in found.values()) == pytest.approx(1.0) and found["a"].importance > 0.5


def test_curve_has_the_area_and_loss_of_every_round(spark):
    rows, frame = made_rows(spark)
    train, held_out = frame.where("id % 3 <> 0"), frame.where("id % 3 = 0")
    model = fit_trees(train, NAMES, "y", ["id"], settings=SMALL)
    curve = {r.tree_count: r for r in training_auc_curve(model, held_out, "y").collect()}
    scored = with_margins(model, held_out).select("y", "margins").collect()
    assert sorted(curve) == list(range(1, 26))
    for i, r in curve.items():
        margins = np.array([x.margins[i - 1] for x in scored])
        y = np.array([x.y for x in scored])
        pairs = [(p > n) + (p == n) / 2 for p in margins[y == 1] for n in margins[y == 0]]
        assert r.roc_auc == pytest.approx(sum(pairs) / len(pairs), abs=1e-12)
        assert r.loss == pytest.approx(float(np.mean(np.logaddexp(0, np.where(y == 1, -margins, margins)))), abs=1e-9)
    last = roc_auc(with_margin(model, held_out).withColumn("p", probability(F.col("margin"))), "y", "p").first().roc_auc
    assert curve[25].roc_auc == pytest.approx(last, abs=1e-12) and last > 0.75 and curve[25].loss < curve[1].loss


def test_ranges_change_nothing(spark):
    _, frame = made_rows(spark, 300)
    model = fit_trees(frame, NAMES, "y", ["id"], settings=TreeSettings(trees=3, depth=2, min_weight=1.0))
    curves = [sorted(map(tuple, training_auc_curve(model, frame, "y", ranges).collect())) for ranges in (2, 9)]
    assert [r[:2] for r in curves[0]] == [r[:2] for r in curves[1]]


def test_one_class_no_rows_and_missing_labels(spark):
    _, frame = made_rows(spark, 60)
    settings = TreeSettings(trees=2, depth=2)
    one = fit_trees(frame.withColumn("y", F.lit(1)), NAMES, "y", ["id"], settings=settings)
    assert all((t.feature == -1).all() and t.value[1] > 0 for t in one.trees)
    assert training_auc_curve(one, frame.withColumn("y", F.lit(1)), "y").where("roc_auc is not null").isEmpty()
    none = fit_trees(frame.where("id < 0"), NAMES, "y", ["id"], settings=settings)
    assert {r.margin for r in with_margin(none, frame).collect()} == {0.0}
    holes = fit_trees(frame.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y"))), NAMES, "y", ["id"], settings=settings)
    evens = fit_trees(frame.where("id % 2 = 0"), NAMES, "y", ["id"], settings=settings)
    assert len(holes.trees) == len(evens.trees) == 2


def test_given_trees_score_by_their_rules(spark):
    tree = Tree.empty(1)
    tree.feature[1], tree.limit[1], tree.missing_left[1], tree.value[2], tree.value[3] = 0, 2.0, True, -1.0, 3.0
    model = BoostedTrees(["x"], [tree, tree])
    df = spark.createDataFrame([(0, 2.0), (1, 2.5), (2, None), (3, float("inf"))], "id int, x double")
    assert [r.margins for r in with_margins(model, df).orderBy("id").collect()] == [[-1.0, -2.0], [3.0, 6.0], [-1.0, -2.0], [3.0, 6.0]]


@pytest.mark.parametrize("size", [0, 1, 40, 5000])
def test_samples_have_exactly_so_many_rows_in_any_partitioning(spark, size):
    _, frame = made_rows(spark)
    first = sorted(r.id for r in exact_sample(frame, ["id"], size, ["y"]).collect())
    again = sorted(r.id for r in exact_sample(frame.repartition(9), ["id"], size, ["y"], slack=-5.0).collect())
    sizes = {r.y: r["count"] for r in frame.groupBy("y").count().collect()}
    assert first == again and len(first) == sum(min(size, n) for n in sizes.values())
    assert exact_sample(frame, ["id"], size).count() == min(size, 900)


def test_samples_with_repeated_keys_null_groups_and_no_rows(spark):
    rows = [(1, None, i % 4) for i in range(50)] + [(i, "g", 0) for i in range(30)]
    frame = spark.createDataFrame(rows, "k int, g string, x int")
    found = exact_sample(frame, ["k"], 10, ["g"])
    assert {r.g: r["count"] for r in found.groupBy("g").count().collect()} == {None: 10, "g": 10}
    assert {r.x for r in found.where("g is null").collect()} == {0}
    assert exact_sample(frame.where("k > 100"), ["k"], 10, ["g"]).count() == 0


def test_a_snapped_value_takes_the_same_way_through_every_tree():
    from cohortloom.operators.boosting import BoostedTrees, Tree, _limits_used, _snapped

    model = BoostedTrees(["a", "b", "unused"])
    for limit, feature, missing_left in ((1.0, 0, True), (2.5, 0, False), (-3.0, 1, True)):
        tree = Tree.empty(1)
        tree.feature[1], tree.limit[1], tree.missing_left[1], tree.value[2], tree.value[3] = feature, limit, missing_left, limit, 7.0 * limit
        model.trees.append(tree)
    values = np.array([[-np.inf, 0.5, 1.0, 1.5, 2.5, 9.0, np.inf, np.nan], [-3.0, -3.1, np.nan, 0.0, -np.inf, np.inf, 4.0, 5.0], np.arange(8.0)])
    limits = _limits_used(model)
    snapped = np.vstack([_snapped(x, limit) for x, limit in zip(values, limits)])
    assert (model.margins(snapped) == model.margins(values)).all()
    assert len(np.unique(snapped[0])) == 4 and not snapped[2].any()


def test_the_fit_reads_the_stored_sample_only(spark, monkeypatch):
    import catalogue.boosting as queries

    seen = []

    def fit(rows, *_):
        seen.extend(rows.inputFiles())
        raise InterruptedError

    monkeypatch.setattr(queries, "fit_trees", fit)
    monkeypatch.setattr(queries, "_FITTED", {})
    with pytest.raises(InterruptedError):
        queries._full_fit(spark, "/root/testdata/sf0.001")
    assert seen and all("train-rows" in path for path in seen)
