"""Hard negatives: rows of another label that score just below an anchor's positives.

Scores are inner products of whole numbers, taken tile by tile (anchors x rows) by Strassen's
recursion: odd sides get a line of zeros, additions are 64-bit and exact, as sums that pass 64 bits on the way wrap
and wrap back. Small blocks are multiplied directly, by floating-point routines where every sum is
proven to stay below 2**53 and by whole numbers elsewhere. Two passes run over all rows. The first
keeps a heap of the best rows of an anchor's own label; the second, for each anchor and positive,
a heap of the best rows of other labels inside the positive's window. A task's heaps are its
output; they merge like the entries of one heap.

Anchors are taken in groups of at most ``GROUP_BYTES`` of components, each sent to the tasks in
turn, so memory does not grow with their number. Where the second pass has many tasks, one over a
64th of the rows goes before it: its heaps are real entries, so nothing below their last place can
be in the result, and the tasks need not send it.

Rows: those with a null id or label, a null vector, or a null or non-finite component take no part.
Shorter vectors count as filled up with zeros. Repeated rows count as often as they stand, also as
anchors; rows with the anchor's own id are never its positives. Ties go to the smaller id. An empty table
gives an empty one. Components or scores that 64 bits cannot hold are an error, not a wrong number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import own, stored
from cohortloom.session import fresh_path

GROUP_BYTES = 16 << 20
ANCHOR_TILE, ROW_TILE, LEAF = 512, 2048, 32
PILOT_FROM, PILOT = 64, 64
LEAST = np.iinfo(np.int64).min
MOST = np.iinfo(np.int64).max


def _even(x: np.ndarray) -> np.ndarray:
    rows, columns = x.shape
    return np.pad(x, ((0, rows % 2), (0, columns % 2))) if rows % 2 or columns % 2 else x


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices by seven products of halves, down to blocks with a side of ``LEAF`` or less.

    Exact modulo 2**64, hence exact wherever the true entries fit 64 bits.
    """
    m, d, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, d, n) <= LEAF:
        if not m or not d or not n:
            return np.zeros((m, n), np.int64)
        if float(np.abs(a).max()) * float(np.abs(b).max()) * d < 2**52 and LEAST not in (a.min(), b.min()):
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    a, b = _even(a), _even(b)
    i, j, k = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * k), np.int64)
    out[:i, :k], out[:i, k:] = p1 + p4 - p5 + p7, p3 + p5
    out[i:, :k], out[i:, k:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products; vectors of different lengths are filled up with zeros."""
    d = max(anchors.shape[1], rows.shape[1])
    anchors, rows = (np.pad(x, ((0, 0), (0, d - x.shape[1]))) if x.shape[1] < d else x for x in (anchors, rows))
    if anchors.size and rows.size and float(np.abs(anchors).max()) * float(np.abs(rows).max()) * d >= 2.0**62:
        raise OverflowError("scores may not fit 64 bits")
    return strassen(anchors, np.ascontiguousarray(rows.T))


def whole_numbers(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of every component, and which rows have finite components only."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    values = np.zeros((len(sizes), width))
    values[np.arange(width) < sizes[:, None]] = flat
    fine = np.isfinite(values).all(axis=1)
    values = np.floor(values[fine] * scale)
    if values.size and np.abs(values).max() >= 2.0**62:
        raise OverflowError("components do not fit 64 bits")
    return values.astype(np.int64), fine


class Heaps:
    """The ``size`` best (score, id) of each slot: higher scores first, ties to the smaller id."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.score = np.full((slots, size), LEAST, np.int64)
        self.id = np.full((slots, size), MOST, np.int64)
        self.held = np.zeros(slots, np.int64)

    def last(self, slots: np.ndarray) -> np.ndarray:
        """The score an entry must reach; none while a heap has room."""
        return self.score[slots, -1]

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        worst, worst_id = self.score[slot, -1], self.id[slot, -1]
        better = (self.held[slot] < self.size) | (score > worst) | ((score == worst) & (ids < worst_id))
        slot, score, ids = slot[better], score[better], ids[better]
        if not len(slot):
            return
        touched = np.unique(slot)
        old = np.arange(self.size) < self.held[touched, None]
        slot = np.concatenate([np.repeat(touched, self.held[touched]), slot])
        score = np.concatenate([self.score[touched][old], score])
        ids = np.concatenate([self.id[touched][old], ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = place < self.size
        self.score[slot[kept], place[kept]] = score[kept]
        self.id[slot[kept], place[kept]] = ids[kept]
        self.held[touched] = np.minimum(np.bincount(np.searchsorted(touched, slot), minlength=len(touched)), self.size)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = np.arange(self.size) < self.held[:, None]
        return np.nonzero(held)[0], self.score[held], self.id[held]


def _offer_tile(heaps: Heaps, slots: np.ndarray, tile: np.ndarray, low: np.ndarray, high: np.ndarray | None, ids: np.ndarray) -> None:
    """Offer the entries of a tile (one line per slot) from ``low`` to ``high`` that can enter their heaps."""
    low = np.maximum(low, heaps.last(slots))
    fits = tile >= low[:, None]
    if high is not None:
        fits &= tile <= high[:, None]
    crowded = np.flatnonzero(fits.sum(axis=1) > 4 * heaps.size)
    if len(crowded):  # nothing below a line's own last place can enter
        inside = np.where(fits[crowded], tile[crowded], LEAST)
        edge = np.partition(inside, inside.shape[1] - heaps.size, axis=1)[:, -heaps.size]
        fits[crowded] &= inside >= edge[:, None]
    line, column = np.nonzero(fits)
    if len(line):
        heaps.offer(slots[line], tile[line, column], ids[column])


class _Group:
    """A bounded group of anchors: their vectors, labels and ids, and the windows of their positives."""

    def __init__(self, rows: pa.Table, scale: int):
        self.vectors, fine = whole_numbers(rows.column("vector"), scale)
        self.label = rows.column("label").to_numpy()[fine]
        self.id = rows.column("id").to_numpy()[fine]

    def tiles(self, batches, scale: int):
        for batch in batches:
            vectors, fine = whole_numbers(batch.column(2), scale)
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False)[fine] for i in (0, 1))
            for at in range(0, len(ids), ROW_TILE):
                part = slice(at, at + ROW_TILE)
                yield ids[part], labels[part], vectors[part]

    def positives(self, batches, scale: int, count: int) -> Heaps:
        heaps = Heaps(len(self.id), count)
        of = {int(x): np.flatnonzero(self.label == x) for x in np.unique(self.label)}
        for ids, labels, vectors in self.tiles(batches, scale):
            for label in np.unique(labels):
                anchors, rows = of.get(int(label)), np.flatnonzero(labels == label)
                for at in range(0, 0 if anchors is None else len(anchors), ANCHOR_TILE):
                    slots = anchors[at : at + ANCHOR_TILE]
                    tile = scores(self.vectors[slots], vectors[rows])
                    line, column = np.nonzero(self.id[slots][:, None] == ids[rows])
                    tile[line, column] = LEAST
                    _offer_tile(heaps, slots, tile, np.full(len(slots), LEAST + 1), None, ids[rows])
        return heaps

    def windows(self, batches, scale: int, count: int, low: np.ndarray, high: np.ndarray) -> Heaps:
        """``low`` and ``high``: one line per anchor, one column per positive; empty windows have ``low > high``."""
        heaps, n = Heaps(low.size, count), low.shape[1]
        some = np.flatnonzero((low <= high).any(axis=1))
        for ids, labels, vectors in self.tiles(batches, scale):
            for at in range(0, len(some), ANCHOR_TILE):
                anchors = some[at : at + ANCHOR_TILE]
                tile = scores(self.vectors[anchors], vectors)
                tile[self.label[anchors][:, None] == labels] = LEAST
                for j in range(n):
                    _offer_tile(heaps, anchors * n + j, tile, low[anchors, j], high[anchors, j], ids)
        return heaps


def _ceil_div(a: np.ndarray, b: int) -> np.ndarray:
    return -((-a) // b)


def hard_negatives(
    rows: DataFrame, anchor: Column, id_column: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each row that ``anchor`` selects, its ``positives`` best other rows of the same label; for each
    of these, the ``negatives`` best rows of other labels whose score is from ``low`` to ``high`` percent of the positive's.
    """
    spark, chosen = rows.sparkSession, own("anchor")
    rows = rows.select(
        F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"), anchor.alias(chosen)
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    chosen_rows = stored(rows.where(chosen).select("id", "label", "vector", F.monotonically_increasing_id().alias("n")), "anchors")
    size = chosen_rows.agg(F.coalesce(F.sum(F.size("vector") + 4), F.lit(0))).first()[0] * 8
    groups = max(1, -(-size // GROUP_BYTES))
    rows = rows.select("id", "label", "vector")
    path = fresh_path(spark, "negatives")
    for g in range(groups):
        _mined(spark, _Group(chosen_rows.where(F.col("n") % groups == g).toArrow(), scale), rows, scale, positives, negatives, low, high).write.mode("append").parquet(path)
    found = spark.read.parquet(path)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _mined(spark, group: _Group, rows: DataFrame, scale: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    sent = spark.sparkContext.broadcast(group)

    def best_positives(batches):
        slot, score, ids = sent.value.positives(batches, scale, positives).entries()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(ids)], names=["slot", "score", "id"])

    by_place = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    ranked = lambda df, most: df.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= most)
    best = ranked(rows.mapInArrow(best_positives, "slot long, score long, id long"), positives).toArrow()
    slot, place, score, ids = (best.column(c).to_numpy() for c in ("slot", "rank", "score", "id"))
    of_positive, positive_id = np.zeros((len(group.id), positives), np.int64), np.zeros((len(group.id), positives), np.int64)
    least, most = np.full_like(of_positive, 1), np.zeros_like(of_positive)
    of_positive[slot, place - 1], positive_id[slot, place - 1] = score, ids
    # whole numbers of any size in between: percentages of a 62-bit score pass 64 bits
    least[slot, place - 1] = _ceil_div(score.astype(object) * low, 100).astype(np.int64)
    most[slot, place - 1] = (score.astype(object) * high // 100).astype(np.int64)
    windows = spark.sparkContext.broadcast((least, most, of_positive, positive_id))

    def best_negatives(limits):
        def run(batches):
            mine, (least, most, of_positive, positive_id) = sent.value, windows.value
            slot, score, ids = mine.windows(batches, scale, negatives, limits.value if limits else least, most).entries()
            a, j = slot // positives, slot % positives
            columns = [slot, score, ids, mine.id[a], positive_id[a, j], of_positive[a, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "score", "id", "anchor_id", "positive_id", "positive_score"])

        return run

    kind = "slot long, score long, id long, anchor_id long, positive_id long, positive_score long"
    limits = None
    if rows.rdd.getNumPartitions() > PILOT_FROM:
        pilot = rows.where(F.pmod(F.xxhash64("id"), F.lit(PILOT)) == 0).mapInArrow(best_negatives(None), kind)
        last = ranked(pilot, negatives).where(F.col("rank") == negatives).select("slot", "score").toArrow()
        raised, at = least.copy(), last.column("slot").to_numpy()
        raised[at // positives, at % positives] = last.column("score").to_numpy()
        limits = spark.sparkContext.broadcast(raised)
    found = ranked(rows.mapInArrow(best_negatives(limits), kind), negatives)
    return found.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
