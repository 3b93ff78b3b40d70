"""Katz backoff language model: Good-Turing discounted bigrams with exactly normalised backoff weights.

    P(w | v) = d c(v, w) / c(v)            where the pair was seen, d discounting counts up to 5
             = a(v) P(w)                   elsewhere, and P(w) = d c(w) / N, the rest for unknown words
    a(v)     = (1 - sum of seen P(. | v)) / (1 - sum of P(w) over the words w seen after v)

The count tables are partitioned by ranges of 64-bit hashes of words and word pairs. Texts are laid
out once in units, bucketed by unit, so that they stay in place while what is known of their words
comes to them: a unit sends each range one packed row of its distinct hashes, ascending, and gets the
totals back in the same order. A frequent word or pair is thus one entry a unit, never a group of rows.
Three passes: counts; sums for the backoff weights, in which each distinct pair is owned by one unit;
scores, recursively per token.
"""

from __future__ import annotations

import uuid

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import LOWER, mixed, span_hashes, stored, utf8, word_spans
from cohortloom.session import fresh_path

#: Counts above this are not discounted.
CUTOFF = 5
END = np.uint64(0xE17A1465B7C3D291)
START = np.uint64(0x5B8E0C1D9F4A6E37)
UNIT_BYTES = 8_000_000
BUCKET_BYTES = 16_000_000
_STATS = -1


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that high bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Number of the hash range; ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


@dataclass(frozen=True)
class Discounts:
    """Size of the training text and Good-Turing factors of words and pairs."""

    tokens: int
    types: int
    texts: int
    word: np.ndarray
    pair: np.ndarray
    unknown: float  # count left for unknown words


def good_turing(of: np.ndarray) -> np.ndarray:
    """Factors d[0..CUTOFF + 1] from the numbers of types seen 1, ..., CUTOFF + 1 times; the last, and every later one, is 1.

    Katz's form, which leaves the total for unseen types as Good and Turing do. Where the numbers do
    not allow it (a factor outside (0, 1]), as in small texts, half a count is taken off instead.
    """
    factor = np.ones(CUTOFF + 2)
    tail = (CUTOFF + 1) * of[CUTOFF] / of[0] if of[0] else 1.0
    for r in range(1, CUTOFF + 1):
        value = ((r + 1) * of[r] / (r * of[r - 1]) - tail) / (1 - tail) if of[r - 1] and tail < 1 else 0.0
        factor[r] = value if 0 < value <= 1 else 1 - 0.5 / r
    return factor


class _Unit:
    """The tokens of a unit of texts: local word numbers, distinct words and distinct pairs."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("row")
        self.keys, self.train = table["row"].to_numpy(), table["train"].to_numpy(zero_copy_only=False).astype(bool)
        data, offsets = utf8(table["text"])
        data = LOWER[data]
        starts, ends, count = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        # an end after the words of each text
        self.count = count + 1
        last = np.cumsum(self.count) - 1
        tokens = np.full(self.count.sum(), END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = hashes
        self.text = np.repeat(np.arange(len(count)), self.count)
        self.words, self.word = np.unique(tokens, return_inverse=True)
        before = np.empty(len(tokens), np.int64)
        before[1:] = self.word[:-1]
        before[last - self.count + 1] = len(self.words)  # the start, which is no token
        contexts = np.append(self.words, START)
        keys = mixed(contexts[before] * np.uint64(0x9E3779B97F4A7C15) + tokens)
        self.pairs, first, self.pair = np.unique(keys, return_index=True, return_inverse=True)
        self.left, self.right = before[first], self.word[first]
        self.contexts = contexts

    def trained(self, numbers: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(numbers[self.train[self.text]], minlength=size)


def _slices(unit: int, hashes: np.ndarray, buckets: int, shift: int, *columns: np.ndarray) -> list[tuple]:
    """Rows (bucket, unit, hashes, columns) of ascending hashes, one for each range that has some."""
    bucket = _bucket(hashes, buckets)
    edges = np.searchsorted(bucket, np.arange(buckets + 1)) if buckets < len(hashes) else np.append(np.unique(np.searchsorted(bucket, bucket)), len(bucket))
    rows = []
    for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if stop > start:
            rows.append((int(bucket[start]) + shift, unit, _planes(np.diff(hashes[start:stop], prepend=np.uint64(0))), b"".join(_planes(c[start:stop]) for c in columns)))
    return rows


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


_SENT, _SENT_KINDS = ["bucket", "unit", "hashes", "data"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
_SENT_SCHEMA = "bucket long, unit long, hashes binary, data binary"
_BACK, _BACK_KINDS = ["unit", "bucket", "data", "stats"], [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
_BACK_SCHEMA = "unit long, bucket long, data binary, stats array<long>"


def _grouped(table: pa.Table) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """(unit, size) of each row, all hashes, the number of each entry's distinct hash and the distinct ones' first entries."""
    parts = [np.cumsum(_from_planes(x, np.uint64)) for x in table["hashes"].to_pylist()]
    hashes = np.concatenate(parts)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    return list(zip(table["unit"].to_pylist(), map(len, parts), strict=True)), hashes, number, first


def _counted(sent: DataFrame, word_buckets: int) -> DataFrame:
    """Each entry's total count back to its unit, doubled, plus 1 for the entry that owns its hash; and statistics of the range."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("unit")
        bucket = table["bucket"][0].as_py()
        rows, _, number, first = _grouped(table)
        counts = np.concatenate([_from_planes(x, np.uint32) for x in table["data"].to_pylist()]).astype(np.int64)
        total = np.bincount(number, counts, minlength=len(first)).astype(np.int64)
        answer = total[number] * 2
        answer[first] += 1
        out, start = [], 0
        for unit, size in rows:
            out.append((unit, bucket, _planes(answer[start : start + size]), None))
            start += size
        often = np.bincount(np.minimum(total, CUTOFF + 2), minlength=CUTOFF + 3)[1 : CUTOFF + 2]
        out.append((_STATS, bucket, None, [int(bucket >= word_buckets), int(total.sum()), int((total > 0).sum()), *often.tolist()]))
        return _table(out, _BACK, _BACK_KINDS)

    return sent.groupBy("bucket").applyInArrow(run, _BACK_SCHEMA)


def _weighed(sent: DataFrame) -> DataFrame:
    """Sums for the backoff weight of each context back to the units that sent it."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("unit")
        bucket = table["bucket"][0].as_py()
        rows, _, number, first = _grouped(table)
        left, covered, wanted = [], [], []
        for data, (_, size) in zip(table["data"].to_pylist(), rows, strict=True):
            left.append(_from_planes(data[: 8 * size], np.float64))
            covered.append(_from_planes(data[8 * size : 16 * size], np.float64))
            wanted.append(np.frombuffer(data[16 * size :], np.uint8))
        left = np.bincount(number, np.concatenate(left), minlength=len(first))
        covered = np.bincount(number, np.concatenate(covered), minlength=len(first))
        # left over the free part; without anything left, minus one over the free part
        weight = np.where(left > 0, left, -1.0) / np.maximum(1 - covered, 1e-300)
        answer = np.where(np.concatenate(wanted) > 0, weight[number], np.sign(weight)[number])
        out, start = [], 0
        for unit, size in rows:
            out.append((unit, bucket, _planes(answer[start : start + size]), None))
            start += size
        return _table(out, _BACK, _BACK_KINDS)

    return sent.groupBy("bucket").applyInArrow(run, _BACK_SCHEMA)


def _answers(table: pa.Table, low: int, high: int, kind: type) -> np.ndarray:
    """The answers of the ranges [low, high) in order of the unit's hashes."""
    rows = sorted((b, d) for b, d in zip(table["bucket"].to_pylist(), table["data"].to_pylist(), strict=True) if low <= b < high)
    return np.concatenate([_from_planes(d, kind) for _, d in rows]) if rows else np.zeros(0, kind)


class _Known:
    """A unit with its totals: counts of its words and pairs, and which pairs it owns."""

    def __init__(self, texts: pa.Table, back: pa.Table, model: Discounts, word_buckets: int, buckets: int):
        self.unit = unit = _Unit(texts)
        words = _answers(back, 0, word_buckets, np.int64) >> 1
        pairs = _answers(back, word_buckets, buckets, np.int64)
        self.word_count, self.pair_count, self.owned = words, pairs >> 1, (pairs & 1).astype(bool)
        self.context_count = np.append(words, model.texts)
        mass = model.word[np.minimum(words, CUTOFF + 1)] * words
        # P(w); what discounting leaves goes to unknown words
        self.word_share = np.where(words > 0, mass, model.unknown) / (model.tokens + (model.unknown == 1.0))
        self.discounted = model.pair[np.minimum(self.pair_count, CUTOFF + 1)] * self.pair_count
        assert len(words) == len(unit.words) and len(pairs) == len(unit.pairs), "a unit's answers are incomplete"


def laid_out(docs: DataFrame, text: str, train: Column, row_columns: list[str]) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The texts as a table bucketed by ``unit`` (``unit, row, train, text`` and the columns kept), and figures about them."""
    spark = docs.sparkSession
    figures = docs.agg(F.count("*").alias("rows"), F.sum(F.octet_length(text)).alias("bytes"), F.count_if(train).alias("trained")).first().asDict()
    rows, size = figures["rows"], figures["bytes"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, size // UNIT_BYTES // 4)
    shift = max(0, min(16, int(np.log2(max(1, UNIT_BYTES * rows // max(size, 1))))))
    named = docs.select(*row_columns, F.coalesce(F.col(text), F.lit("")).alias("text"), train.alias("train"), F.monotonically_increasing_id().alias("row"))
    placed = named.withColumn("unit", F.shiftright("row", shift))
    name = f"texts_{uuid.uuid4().hex}"
    # every task has whole units, so each writes few files
    placed.write.option("path", fresh_path(spark, "units")).option("compression", "zstd").bucketBy(n, "unit").sortBy("unit").saveAsTable(name)
    return spark.table(name), spark.table(name).select("row", "train", *row_columns), figures


def score_texts(docs: DataFrame, train: Column, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Train on the rows where ``train`` holds and score every row.

    Returns the columns of ``keep`` with ``n_tokens, n_known, train_tokens, base_score, score``: tokens are
    the lower-case words (A-Z) and one end; known ones were seen in training; ``base_score`` is the
    add-one-half unigram's, ``score`` the model's log10 probability. Null texts are empty and have
    the end only. Rows may repeat. Without training rows every token is unknown and has probability 1.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    spark = docs.sparkSession
    names = {c: f"kept_{i}" for i, c in enumerate(keep)}
    plain = docs.select(*[F.col(c).alias(a) for c, a in names.items()], F.col(text).alias("text_"), F.coalesce(train, F.lit(False)).alias("train_"))
    units, rows, figures = laid_out(plain, "text_", F.col("train_"), list(names.values()))
    units = units.select("unit", "row", "train", "text")
    size = figures["bytes"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    word_buckets = max(2 * least, size // 4 // BUCKET_BYTES)
    buckets = word_buckets + max(2 * least, size * 2 // 3 // BUCKET_BYTES)

    def count(table: pa.Table) -> pa.Table:
        unit, number = _Unit(table), table["unit"][0].as_py()
        sent = _slices(number, unit.words, word_buckets, 0, unit.trained(unit.word, len(unit.words)).astype(np.uint32))
        sent += _slices(number, unit.pairs, buckets - word_buckets, word_buckets, unit.trained(unit.pair, len(unit.pairs)).astype(np.uint32))
        return _table(sent, _SENT, _SENT_KINDS)

    counts = stored(_counted(units.groupBy("unit").applyInArrow(count, _SENT_SCHEMA), word_buckets), "katz-counts")
    stats = counts.where(F.col("unit") == _STATS).groupBy(F.get("stats", F.lit(0)).alias("pairs"))
    found = {r["pairs"]: np.array(r[1:], float) for r in stats.agg(*[F.sum(F.get("stats", F.lit(i))) for i in range(1, CUTOFF + 4)]).collect()}
    none = np.zeros(CUTOFF + 3)
    words, pairs = found.get(0, none), found.get(1, none)
    tokens = int(words[0])
    discounts = good_turing(words[2:])
    left = float(sum((1 - discounts[r]) * r * words[1 + r] for r in range(1, CUTOFF + 1)))
    # nothing left for unknown words: one more token is counted, which is theirs
    model = Discounts(tokens, int(words[1]), figures["trained"], discounts, good_turing(pairs[2:]), left if left > 0 else 1.0)

    def weigh(texts: pa.Table, back: pa.Table) -> pa.Table:
        known = _Known(texts, back, model, word_buckets, buckets)
        unit = known.unit
        seen = known.owned & (known.pair_count > 0)
        at, size = unit.left[seen], len(unit.contexts)
        left = np.bincount(at, (known.pair_count - known.discounted)[seen], minlength=size)
        covered = np.bincount(at, known.word_share[unit.right[seen]], minlength=size)
        wanted = np.bincount(unit.left[known.pair_count == 0], minlength=size) > 0
        order = np.argsort(unit.contexts)
        return _table(_slices(texts["unit"][0].as_py(), unit.contexts[order], word_buckets, buckets, left[order], covered[order], wanted[order].astype(np.uint8)), _SENT, _SENT_KINDS)

    answered = counts.where(F.col("unit") != _STATS).select("unit", "bucket", "data")
    sums = units.groupBy("unit").cogroup(answered.groupBy("unit")).applyInArrow(weigh, _SENT_SCHEMA)
    weights = stored(_weighed(sums).select("unit", "bucket", "data"), "katz-weights")
    scored_kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def score(texts: pa.Table, back: pa.Table) -> pa.Table:
        known = _Known(texts, back, model, word_buckets, buckets)
        unit = known.unit
        order = np.argsort(unit.contexts)
        weight = np.empty(len(order))
        weight[order] = _answers(back, buckets, buckets + word_buckets, np.float64)
        # a context of which discounting leaves nothing counts one more, for what it never preceded
        context = known.context_count + (weight < 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = np.where(known.context_count > 0, np.abs(weight) / context, 1.0)
            likely = np.where(known.pair_count > 0, known.discounted / context[unit.left], backoff[unit.left] * known.word_share[unit.right])
        likely = np.log10(likely)
        base = np.log10((known.word_count + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
        texts_in = len(unit.count)
        columns = [
            unit.keys, unit.count, np.bincount(unit.text, known.word_count[unit.word] > 0, minlength=texts_in).astype(np.int64),
            np.bincount(unit.text, base[unit.word], minlength=texts_in), np.bincount(unit.text, likely[unit.pair], minlength=texts_in),
        ]
        return pa.table([pa.array(c, k) for c, k in zip(columns, scored_kinds, strict=True)], names=["row", "n_tokens", "n_known", "base_score", "score"])

    everything = answered.unionByName(weights)
    scored = units.groupBy("unit").cogroup(everything.groupBy("unit")).applyInArrow(score, "row long, n_tokens long, n_known long, base_score double, score double")
    whole = rows.join(scored, "row")
    return whole.select(*[F.col(a).alias(c) for c, a in names.items()], "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
