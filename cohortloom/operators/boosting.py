"""Second-order boosted trees with regularisation, fitted by Spark one tree level at a time.

The rows are laid out once as blocks: bin numbers of the features, label, weight and a place for
row sampling, in a table in the shared folder. A level of a tree is one job. Each task sends the
sums of gradient and curvature per (node, feature, bin) of its blocks, Spark adds them up, and the
driver, which sees nodes x features x bins sums and nothing else, picks the splits. Sums
are taken over whole numbers (a fixed share of the total weight), so they do not depend on how the rows
are dealt out, and a fit is the same in every run. Every ``REFRESH`` trees the margins reached so far are
written beside the blocks, which bounds what a task works out again and what a lost executor costs.

With G and H the sums of a node and T(G) = sign(G) max(|G| - l1, 0), a node scores T(G)^2 / (H + l2), a
split gains half of what the children score more than the node, less ``min_gain``, and a leaf adds
-learning_rate T(G) / (H + l2). Missing values (NULL, NaN) go to the side where the split gains more. A
split takes place if its gain is positive and both sides have a curvature of ``min_weight``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.numeric import real_or_null
from cohortloom.operators.ordered import range_count, running_counts_by
from cohortloom.operators.sampling import exact_sample, key_place
from cohortloom.session import fresh_path
from cohortloom.sources.published import remove_folder

BLOCK_ROWS = 32_768
REFRESH = 8
#: The driver adds up the sums of so many tasks itself; those of more are added up in a shuffle first.
FEW_TASKS = 8
#: Whole numbers are this many bits below what 64 bits can sum up.
SUM_BITS = 61
TREES = "tree int, node int, feature string, limit double, missing_left boolean, gain double, cover double, value double"


@dataclass(frozen=True)
class TreeSettings:
    """``row_share`` and ``feature_share`` are drawn per tree; ``bins`` bounds the split limits of a feature."""

    trees: int = 300
    depth: int = 6
    learning_rate: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    min_weight: float = 5.0
    min_gain: float = 0.1
    l1: float = 0.1
    l2: float = 1.0
    bins: int = 64
    #: Rows that the split limits are taken from, those of the smallest key places.
    limit_rows: int = 20_000
    seed: int = 42


@dataclass
class Tree:
    """Nodes by heap numbers from 1 on; the children of n are 2n (at most the limit) and 2n + 1. Feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    limit: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 1 << (depth + 1)
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 2

    def nodes(self, values: np.ndarray) -> np.ndarray:
        """The node that each row ends in, from raw values (features x rows)."""
        return self._down(values.shape[1], lambda feature, rows, at: _sides(values[feature, rows], self.limit[at], np.isnan(values[feature, rows]), self.missing_left[at]))

    def binned_nodes(self, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The same from bin numbers; ``missing`` has the bin of each feature's missing values."""
        return self._down(bins.shape[1], lambda feature, rows, at: _sides(bins[feature, rows], self.bin[at], bins[feature, rows] == missing[feature], self.missing_left[at]))

    def _down(self, n: int, goes_left) -> np.ndarray:
        at, rows = np.ones(n, np.int64), np.arange(n)
        for _ in range(self.depth):
            feature = self.feature[at]
            if not (feature >= 0).any():
                break
            at = np.where(feature >= 0, 2 * at + 1 - goes_left(feature, rows, at), at)
        return at


def _sides(x: np.ndarray, limit: np.ndarray, absent: np.ndarray, missing_left: np.ndarray) -> np.ndarray:
    return np.where(absent, missing_left, x <= limit)


@dataclass
class BoostedTrees:
    features: list[str]
    trees: list[Tree] = field(default_factory=list)

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Margins after each tree (trees x rows) of raw values (features x rows)."""
        out = np.zeros((len(self.trees), values.shape[1]))
        for i, tree in enumerate(self.trees):
            out[i] = tree.value[tree.nodes(values)]
        return np.cumsum(out, axis=0)


def _values(columns: list[pa.Array]) -> np.ndarray:
    return np.vstack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns]) if columns else np.zeros((0, 0))


def split_limits(rows: DataFrame, features: Sequence[str], bins: int, key: Sequence[str], most_rows: int) -> list[np.ndarray]:
    """Per feature at most ``bins - 1`` increasing values: all but the largest where there are few, else even ranks.

    Taken from the ``most_rows`` rows with the smallest key places.
    """
    sample = exact_sample(rows.select(*dict.fromkeys([*key, *features])), key, most_rows).select(*[real_or_null(c).alias(f"f{i}") for i, c in enumerate(features)])
    found = sample.toArrow()
    limits = []
    for i in range(len(features)):
        values = np.sort(found.column(i).drop_null().to_numpy())
        distinct = np.unique(values)
        if len(distinct) > bins:
            distinct = np.unique(values[(np.arange(1, bins + 1) * len(values)) // bins - 1])
        limits.append(distinct[:-1])
    return limits


def _laid_out(rows: DataFrame, features: Sequence[str], label: str, weight: str | None, key: Sequence[str], limits: list[np.ndarray], seed: int, partitions: int | None) -> DataFrame:
    """The rows as blocks: n, bins (one byte a feature and row), y, weight, place, margin."""
    narrow = rows.select(
        F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), key_place(key, seed).alias("place"),
        *[real_or_null(c).alias(f"f{i}") for i, c in enumerate(features)],
    ).where(F.col("y").isNotNull() & F.col("w").isNotNull())
    spread = narrow.repartition(partitions) if partitions else narrow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting)
            y, w, place = (table.column(i).to_numpy() for i in range(3))
            values = _values([c.combine_chunks() for c in table.columns[3:]])
            bins = np.vstack([np.where(np.isnan(x), len(limit) + 1, np.searchsorted(limit, x)) for x, limit in zip(values, limits)])
            columns = [bins.astype(np.uint8), y, w, place, np.zeros(len(y))]
            return pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]], names=["n", "bins", "y", "w", "place", "margin"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                if size + part.num_rows > BLOCK_ROWS and waiting:
                    yield block()
                    waiting, size = [], 0
                waiting.append(part)
                size += part.num_rows
        if size:
            yield block()

    return spread.mapInArrow(run, "n long, bins binary, y binary, w binary, place binary, margin binary")


class _Block:
    def __init__(self, row: dict, n_features: int):
        n = row["n"]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, n)
        self.y, self.w, self.margin = (np.frombuffer(row[c], np.float64) for c in ("y", "w", "margin"))
        self.place = np.frombuffer(row["place"], np.int64)


def _drawn(place: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Rows of a tree's draw: the key's place, stirred by the tree's number."""
    if share >= 1:
        return np.ones(len(place), bool)
    x = place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree + 1) * 0xD1B54A32D192ED03 % 2**64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int) -> Iterator[_Block]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _Block(row, n_features)


def _with_margins(blocks: DataFrame, trees: list[Tree], missing: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [(_margin(b, trees, missing)).tobytes() for b in _blocks(iter([batch]), len(missing))]
            yield batch.set_column(5, "margin", pa.array(margins, pa.binary()))

    return blocks.mapInArrow(run, blocks.schema)


def _margin(block: _Block, trees: list[Tree], missing: np.ndarray) -> np.ndarray:
    margin = block.margin.copy()
    for tree in trees:
        margin += tree.value[tree.binned_nodes(block.bins, missing)]
    return margin


def _level_sums(blocks: DataFrame, trees: list[Tree], tree: Tree, level: int, number: int, features: list[int], missing: np.ndarray, share: float, scale: float, tasks: int) -> np.ndarray:
    """Sums of gradient and curvature: nodes of the level x chosen features x bins x 2, as whole numbers."""
    n_bins, first, n_nodes = int(missing.max()) + 1, 1 << level, 1 << level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, n_nodes * len(features) * n_bins), np.int64)
        for block in _blocks(batches, len(missing)):
            chosen = _drawn(block.place, number, share)
            node = tree.binned_nodes(block.bins, missing) - first
            chosen &= node >= 0
            probability = 1 / (1 + np.exp(-_margin(block, trees, missing)))
            g = np.rint((probability - block.y) * block.w * scale).astype(np.int64)[chosen]
            h = np.rint(probability * (1 - probability) * block.w * scale).astype(np.int64)[chosen]
            for i, f in enumerate(features):
                cell = (node[chosen] * len(features) + i) * n_bins + block.bins[f][chosen]
                for side, x in ((0, g), (1, h)):
                    # halves of the numbers, as bincount adds up doubles: each half's sum stays exact
                    low = np.bincount(cell, x & 0xFFFFFF, sums.shape[1]).astype(np.int64)
                    sums[side] += low + (np.bincount(cell, x >> 24, sums.shape[1]).astype(np.int64) << 24)
        cells = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[0, cells]), pa.array(sums[1, cells])], names=["cell", "g", "h"])

    found = blocks.mapInArrow(run, "cell long, g long, h long")
    if tasks > FEW_TASKS:
        found = found.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    found = found.toArrow()
    sums = np.zeros((n_nodes * len(features) * n_bins, 2), np.int64)
    for i, name in enumerate(("g", "h")):
        np.add.at(sums[:, i], found.column("cell").to_numpy(), found.column(name).to_numpy())
    return sums.reshape(n_nodes, len(features), n_bins, 2)


def _shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_split(sums: np.ndarray, n_limits: Sequence[int], settings: TreeSettings) -> tuple[float, int, int, bool, np.ndarray, np.ndarray] | None:
    """Gain, feature place, bin, side of the missing, and the children's sums, of one node's sums (features x bins x 2).

    The first of equal gains counts: by feature, then by limit, missing values to the left first.
    """

    def score(x: np.ndarray) -> np.ndarray:
        bottom = x[..., 1] + settings.l2
        return _shrunk(x[..., 0], settings.l1) ** 2 / np.where(bottom > 0, bottom, np.inf)

    best = None
    for f, n in enumerate(n_limits):
        if not n:
            continue
        total, absent = sums[f].sum(axis=0), sums[f, n + 1]
        below = np.cumsum(sums[f, :n], axis=0)
        for missing_left in (True, False):
            left = below + absent if missing_left else below
            right = total - left
            gain = (score(left) + score(right) - score(total)) / 2 - settings.min_gain
            gain[(left[:, 1] < settings.min_weight) | (right[:, 1] < settings.min_weight)] = -np.inf
            at = int(np.argmax(gain))
            if gain[at] > 0 and (best is None or gain[at] > best[0]):
                best = float(gain[at]), f, at, missing_left, left[at], right[at]
    return best


def fit_trees(
    rows: DataFrame, features: Sequence[str], label: str, key: Sequence[str], weight: str | None = None,
    settings: TreeSettings = TreeSettings(), limits: list[np.ndarray] | None = None, partitions: int | None = None,
) -> BoostedTrees:
    """Fit on the executors. ``key`` names the columns that tell rows apart; limits, row draws and so the fit follow from them.

    Rows without a label or weight take no part. ``limits`` replaces the split limits found in the rows.
    """
    features, spark = list(features), rows.sparkSession
    if settings.bins > 254:
        raise ValueError("at most 254 bins")
    limits = split_limits(rows, features, settings.bins, key, settings.limit_rows) if limits is None else [np.asarray(x, float) for x in limits]
    missing = np.array([len(x) + 1 for x in limits], np.int64)
    blocks, path = _kept(_laid_out(rows, features, label, weight, key, limits, settings.seed, partitions), spark)
    total = blocks.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.w.sum() for b in _blocks(iter([x]), len(missing))], pa.float64())], names=["w"]) for x in batches), "w double").agg(F.sum("w")).first()[0]
    scale = 2.0 ** (SUM_BITS - 1 - int(np.ceil(np.log2(max(total or 0.0, 1.0)))))
    scale = min(scale, 2.0**40)
    tasks = blocks.rdd.getNumPartitions()
    random = np.random.default_rng(settings.seed)
    model, since = BoostedTrees(features), []
    for number in range(settings.trees):
        count = max(1, round(settings.feature_share * len(features)))
        chosen = sorted(random.choice(len(features), count, replace=False).tolist())
        tree = _grown(blocks, since, number, chosen, limits, missing, settings, scale, tasks)
        model.trees.append(tree)
        since.append(tree)
        if len(since) == REFRESH and number + 1 < settings.trees:
            fresh, fresh_at = _kept(_with_margins(blocks, since, missing), spark)
            _dropped(blocks, path)
            blocks, path, since = fresh, fresh_at, []
    _dropped(blocks, path)
    return model


def _kept(blocks: DataFrame, spark: SparkSession) -> tuple[DataFrame, str]:
    """Written to the shared folder, so that nothing is lost with an executor; read from memory where it is still there."""
    path = fresh_path(spark, "tree-rows")
    blocks.write.parquet(path)
    return spark.read.schema(blocks.schema).parquet(path).persist(StorageLevel.MEMORY_AND_DISK), path


def _dropped(blocks: DataFrame, path: str) -> None:
    blocks.unpersist()
    remove_folder(blocks.sparkSession, path)


def _grown(blocks: DataFrame, since: list[Tree], number: int, chosen: list[int], limits: list[np.ndarray], missing: np.ndarray, settings: TreeSettings, scale: float, tasks: int) -> Tree:
    tree = Tree.empty(settings.depth)

    def leaf(node: int, sums: np.ndarray) -> None:
        bottom = sums[1] + settings.l2
        tree.cover[node] = sums[1]
        tree.value[node] = -settings.learning_rate * float(_shrunk(sums[0], settings.l1)) / bottom if bottom > 0 else 0.0

    open_nodes = [1]
    for level in range(settings.depth):
        sums = _level_sums(blocks, since, tree, level, number, chosen, missing, settings.row_share, scale, tasks) / scale
        found = []
        for node in open_nodes:
            of_node = sums[node - (1 << level)]
            if level == 0:
                leaf(1, of_node[0].sum(axis=0))
            split = best_split(of_node, [len(limits[f]) for f in chosen], settings)
            if split is None:
                continue
            gain, f, at, missing_left, left, right = split
            tree.feature[node], tree.bin[node], tree.limit[node] = chosen[f], at, limits[chosen[f]][at]
            tree.missing_left[node], tree.gain[node], tree.value[node] = missing_left, gain, 0.0
            leaf(2 * node, left)
            leaf(2 * node + 1, right)
            found += [2 * node, 2 * node + 1]
        open_nodes = found
        if not open_nodes:
            break
    return tree


def _margin_frame(model: BoostedTrees, df: DataFrame, output: str, last_only: bool) -> DataFrame:
    """All rows and columns of ``df``, with the margin, or the margins after each tree."""
    kind = T.DoubleType() if last_only else T.ArrayType(T.DoubleType())
    packed = df.select(F.struct("*").alias("row"), *[real_or_null(c).alias(f"f{i}") for i, c in enumerate(model.features)])
    schema = T.StructType([T.StructField("row", df.schema), T.StructField("margin", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = model.margins(_values(batch.columns[1:]))
            if last_only:
                result = pa.array(margins[-1] if len(margins) else np.zeros(batch.num_rows))
            else:
                n = len(model.trees)
                result = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * n), pa.array(margins.T.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), result], names=["row", "margin"])

    return packed.mapInArrow(run, schema).select("row.*", F.col("margin").alias(output))


def with_margin(model: BoostedTrees, df: DataFrame, output: str = "margin") -> DataFrame:
    """``df`` with the margin of every row; its probability is ``probability(F.col(output))``."""
    return _margin_frame(model, df, output, True)


def with_margins(model: BoostedTrees, df: DataFrame, output: str = "margins") -> DataFrame:
    """``df`` with the margins of every row after each tree, in one pass."""
    return _margin_frame(model, df, output, False)


def probability(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _limits_used(model: BoostedTrees) -> list[np.ndarray]:
    """The split limits of each feature in any tree, ascending."""
    return [np.unique(np.concatenate([np.zeros(0), *[t.limit[t.feature == i] for t in model.trees]])) for i in range(len(model.features))]


def _snapped(x: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """The value that every split sees as it sees ``x``: the next limit up, or infinity; NaN stays. 0 without limits."""
    if not len(limits):
        return np.zeros(len(x))
    return np.where(np.isnan(x), np.nan, np.append(limits, np.inf)[np.searchsorted(limits, x)])


def training_auc_curve(model: BoostedTrees, df: DataFrame, label: str, ranges: int | None = None) -> DataFrame:
    """(tree_count, roc_auc, loss): exact area and mean logistic loss on the rows of ``df`` after each tree.

    Rows that no split of the model tells apart are added up first, so that each cell between the split limits is
    scored once; what (tree count, margin) share is added up before the running counts of all trees are
    taken together. NULL areas where a class is missing.
    """
    names = [f"f{i}" for i in range(len(model.features))]
    labelled = df.where(F.col(label).isin(0, 1)).select(F.col(label).cast("long").alias("y"), *[real_or_null(c).alias(f) for c, f in zip(model.features, names)])
    limits = _limits_used(model)

    def snap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [pa.array(_snapped(x, limit), from_pandas=True) for x, limit in zip(_values(batch.columns[1:]), limits)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cells], names=["y", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pos, neg = (batch.column(i).to_numpy() for i in range(2))
            for i, margin in enumerate(model.margins(_values(batch.columns[2:]))):
                values, place = np.unique(margin, return_inverse=True)
                sums = [np.bincount(place, n, len(values)).astype(np.int64) for n in (pos, neg)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(values), i + 1, np.int32), values, *sums)], names=["tree_count", "margin", "pos", "neg"])

    snapped = labelled.mapInArrow(snap, ", ".join(["y long", *[f"{f} double" for f in names]]))
    cells = snapped.groupBy(*names).agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).select("pos", "neg", *names)
    # a cell has few bytes and a margin for every tree
    spread = cells.repartition(range_count(df), *names)
    counted = spread.mapInArrow(run, "tree_count int, margin double, pos long, neg long")
    running = running_counts_by(counted, "tree_count", "margin", ["pos", "neg"], ranges)
    pos, neg, below, margin = (F.col(c).cast("double") for c in ("pos", "neg", "neg_below", "margin"))
    # log(1 + exp(x)) without overflow
    softplus = lambda x: F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))
    return running.groupBy("tree_count").agg(
        F.try_divide(F.sum(pos * (below + neg / 2)), F.sum(pos) * F.sum(neg)).alias("roc_auc"),
        (F.sum(pos * softplus(-margin) + neg * softplus(margin)) / F.sum(pos + neg)).alias("loss"),
    )


def trees_frame(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """The model as rows, one per node; a model has at most trees x 2^(depth + 1) of them."""
    rows = []
    for i, tree in enumerate(model.trees):
        for node in range(1, len(tree.feature)):
            split = tree.feature[node] >= 0
            if split or node == 1 or tree.feature[node // 2] >= 0:
                name = model.features[tree.feature[node]] if split else None
                rows.append((i + 1, node, name, float(tree.limit[node]) if split else None, bool(tree.missing_left[node]) if split else None, float(tree.gain[node]), float(tree.cover[node]), float(tree.value[node])))
    return spark.createDataFrame(rows, TREES)


def trees_from(frame: DataFrame, features: Sequence[str]) -> BoostedTrees:
    """The model that ``trees_frame`` gave rows of."""
    rows, features = frame.orderBy("tree", "node").collect(), list(features)
    model = BoostedTrees(features)
    depth = max((r.node.bit_length() - 1 for r in rows), default=0)
    for number in range(1, max((r.tree for r in rows), default=0) + 1):
        model.trees.append(Tree.empty(depth))
    for r in rows:
        tree = model.trees[r.tree - 1]
        tree.cover[r.node], tree.value[r.node], tree.gain[r.node] = r.cover, r.value, r.gain
        if r.feature is not None:
            tree.feature[r.node], tree.limit[r.node], tree.missing_left[r.node] = features.index(r.feature), r.limit, r.missing_left
    return model


def gain_importance(trees: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, total_gain, splits, importance) from a model's rows: importances are shares of the total gain; unused features have 0."""
    used = trees.where(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("gain").alias("total_gain"), F.count(F.lit(1)).alias("splits"))
    names = trees.sparkSession.createDataFrame([(name,) for name in features], "feature string")
    total = used.agg(F.sum("total_gain")).scalar()
    gain = F.coalesce("total_gain", F.lit(0.0))
    return names.join(used, "feature", "left").select(
        "feature", gain.alias("total_gain"), F.coalesce("splits", F.lit(0)).alias("splits"), F.coalesce(F.try_divide(gain, total), F.lit(0.0)).alias("importance")
    )
