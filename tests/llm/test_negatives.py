"""Hard negatives against plain Python, Strassen's recursion against direct products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import negatives
from cohortloom.llm.negatives import Heaps, hard_negatives, scores, strassen

ROWS = "vec_id long, label int, embedding array<float>, rank int, score double"


def brute(rows, positives=5, n_negatives=10, low=30, high=90):
    ready = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        ready.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    for i, label, v in ready:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in ready]
        best = sorted((s, j) for s, j, other in scored if other == label and j != i)[:positives]
        for s, j in best:
            inside = sorted((t, k) for t, k, other in scored if other != label and low * -s <= 100 * -t <= high * -s)[:n_negatives]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 7, 0.5) for r in rows], ROWS)
    found = hard_negatives(frame, F.col("vec_id") % 100 == 0, **options)
    return sorted(map(tuple, found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 70, 65), (129, 64, 201), (200, 7, 90), (0, 5, 3), (4, 0, 3)])
def test_strassen_is_the_product(shape):
    rnd = np.random.default_rng(3)
    m, d, n = shape
    for most in (2**9, 2**28):
        a, b = rnd.integers(-most, most, (m, d)), rnd.integers(-most, most, (d, n))
        assert np.array_equal(strassen(a, b), a @ b)


def test_sums_that_pass_64_bits_on_the_way_come_back():
    a = np.full((80, 80), 2**30, np.int64)
    b = np.zeros((80, 80), np.int64)
    b[0], b[1] = 2**30, -(2**30) + 1
    assert np.array_equal(strassen(a, b), a @ b)


def test_scores_beyond_64_bits_are_an_error():
    big = np.full((2, 40), 2**40, np.int64)
    with pytest.raises(OverflowError):
        scores(big, big)


def test_heaps_merge_to_the_heap_of_all():
    rnd = np.random.default_rng(4)
    slot, score, ids = rnd.integers(0, 6, 900), rnd.integers(0, 9, 900), rnd.integers(0, 400, 900)
    whole, merged = Heaps(6, 10), Heaps(6, 10)
    whole.offer(slot, score, ids)
    for part in np.array_split(np.arange(900), 7):
        task = Heaps(6, 10)
        task.offer(slot[part], score[part], ids[part])
        merged.offer(*task.entries())
    assert np.array_equal(whole.score, merged.score) and np.array_equal(whole.id, merged.id)


def random_rows(n, seed, labels=4):
    rnd = np.random.default_rng(seed)
    rows = [(i, int(rnd.integers(labels)), (rnd.integers(-6, 9, 9) / 8).tolist()) for i in range(n)]
    rows += [(n + i, int(rnd.integers(labels)), rows[3][2]) for i in range(150)]  # one vector very often
    rows += [rows[0], rows[10], rows[100]]
    return rows + [(n + 500, None, [1.0]), (n + 600, 1, None), (n + 700, 1, [1.0, None]), (n + 800, 1, [float("nan")]), (n + 900, 1, [float("inf")]), (None, 1, [1.0]),
                   (n + 1000, 2, []), (n + 1100, 1, [0.5, 0.25])]


@pytest.mark.parametrize("change", [{}, {"GROUP_BYTES": 200}, {"ROW_TILE": 7, "ANCHOR_TILE": 2, "LEAF": 2}, {"PILOT_FROM": 0, "PILOT": 3}])
def test_equals_brute_force_however_it_is_cut(spark, monkeypatch, change):
    for name, value in change.items():
        monkeypatch.setattr(negatives, name, value)
    rows = random_rows(500, 5)
    assert mined(spark, rows) == brute(rows)


def test_other_sizes_and_windows(spark):
    rows = random_rows(300, 6, labels=2)
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=100) == brute(rows, 2, 3, 0, 100)


def test_no_rows_and_no_positives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 2, [1.0])]) == []
