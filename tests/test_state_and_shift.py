"""States from batches against full replays, shifts to a wanted distribution, the shift flow."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.operators.lifecycle import alias_resolution, status_current
from cohortloom.operators.run_state import (
    add_states,
    alias_states,
    aliases_of_states,
    compact_states,
    kept_states,
    merge_status_states,
    status_of_states,
    status_states,
)
from cohortloom.operators.shift import DiscreteShift, QuantileShift, Shift, shift_cohort
from cohortloom.session import fresh_path

EVENTS = "run string, status string, at int, id int, version string"


def made_events(spark):
    rnd = random.Random(3)
    rows = [(f"r{rnd.randint(0, 6)}", rnd.choice(["trained", "rejected", "registered"]), rnd.choice([None, *range(9)]), i, rnd.choice([None, f"v{i}"])) for i in range(120)]
    return spark.createDataFrame(rows, EVENTS)


def states_of(events):
    return status_states(events, "run", "status", "at", "id", F.col("version"))


def as_rows(df):
    return sorted(map(str, df.collect()))


def test_states_of_batches_in_any_order_are_those_of_all_events(spark):
    events = made_events(spark)
    want = as_rows(status_current(events, "run", "status", "at", "id", F.col("version")).select("run", "status", "changed_at", "model_version"))
    parts = [states_of(events.where(f"id % 3 = {k}")) for k in range(3)]
    for order in itertools.permutations(range(3)):
        path = fresh_path(spark, "states")
        assert kept_states(spark, path, parts[0]).isEmpty()
        for number, k in enumerate(order):
            add_states(parts[k], path, number)
            add_states(parts[k], path, number)
        assert as_rows(status_of_states(kept_states(spark, path, parts[0]), "run")) == want
    compacted = fresh_path(spark, "states")
    merged = merge_status_states(kept_states(spark, path, parts[0]), "run")
    compact_states(spark, path, merged, 2, compacted)
    again = kept_states(spark, compacted, parts[0])
    assert again.count() == events.select("run").distinct().count() and as_rows(status_of_states(again, "run")) == want
    assert kept_states(spark, path, parts[0]).isEmpty()


def test_alias_states_are_those_of_all_registrations(spark):
    rows = [("m", "1", 5, 1), ("m", "2", 7, 2), ("m", "0", 4, 3), ("n", "1", 2, 4)]
    log = spark.createDataFrame(rows, "model string, version string, at int, id int")
    path = fresh_path(spark, "aliases")
    for number, k in enumerate(("id = 2", "id in (1, 4)", "id = 3")):
        states = alias_states(log.where(k), "model", "version", "at", "id")
        add_states(states, path, number)
    got = aliases_of_states(kept_states(spark, path, states), "model")
    assert as_rows(got) == as_rows(alias_resolution(log, "model", "version", "at", "id"))
    assert {r.model: (r.champion, r.challenger) for r in got.collect()} == {"m": ("0", "2"), "n": ("1", None)}


def cohort(spark, n=4000):
    rnd = random.Random(8)
    rows = [(i, rnd.choice([None, float("nan"), *[rnd.gauss(50, 9)] * 20]), rnd.randint(0, 3), "new" if i % 4 else "old") for i in range(n)]
    return spark.createDataFrame(rows, "id long, x double, d int, version string")


def test_wanted_quantiles_are_met_and_order_is_kept(spark):
    df = cohort(spark)
    wanted = QuantileShift([(0.0, 100.0), (0.5, 120.0), (0.9, 200.0), (1.0, 400.0)], ranges=64)
    shifts = {"x": wanted, "d": DiscreteShift({0: 0.1, 1: 0.2, 3: 0.7}, ["id"])}
    moved = shift_cohort(df, shifts, F.col("version") == "new", "moved", "version").collect()
    before = {r.id: r for r in df.collect()}
    new = [(before[r.id].x, r.x) for r in moved if r.version == "moved" and r.x is not None and not np.isnan(r.x)]
    values = np.sort([y for _, y in new])
    counts = np.histogram([x for x, _ in new], np.quantile([x for x, _ in new], np.linspace(0, 1, 65)))[0]
    bound = 3 * counts.max() / len(new)
    for share, value in [(0.1, 104.0), (0.25, 110.0), (0.5, 120.0), (0.7, 160.0), (0.9, 200.0), (0.95, 300.0)]:
        assert abs(np.mean(values <= value) - share) <= bound
    ordered = [y for _, y in sorted(new)]
    assert all(a <= b + 1e-9 for a, b in zip(ordered, ordered[1:])) and 100 <= values[0] and values[-1] <= 400
    for r in moved:
        old = before[r.id]
        if old.version == "old":
            assert str(r.x) == str(old.x) and r.d == old.d
        elif old.x is None or np.isnan(old.x):
            assert str(r.x) == str(old.x)
    shares = np.bincount([r.d for r in moved if r.version == "moved"], minlength=4) / sum(r.version == "moved" for r in moved)
    assert shares == pytest.approx([0.1, 0.2, 0.0, 0.7], abs=0.03)


def test_a_constant_goes_to_the_middle_and_an_empty_cohort_stays(spark):
    wanted = QuantileShift([(0.0, 0.0), (1.0, 11.0)], whole=True)
    df = spark.createDataFrame([(7.0, "new")] * 5, "x double, version string")
    assert {r.x for r in shift_cohort(df, {"x": wanted}, F.col("version") == "new").collect()} == {6.0}
    assert {r.x for r in shift_cohort(df, {"x": wanted, "y": Shift(2.0)}, F.col("version") == "none").collect()} == {7.0}


@pytest.mark.parametrize("points", [[(0.0, 1.0)], [(0.1, 1.0), (1.0, 2.0)], [(0.0, 2.0), (1.0, 1.0)], [(0.0, 1.0), (0.5, 2.0), (0.5, 3.0), (1.0, 4.0)]])
def test_wanted_points_have_to_rise(points):
    with pytest.raises(ValueError):
        QuantileShift(points)
