"""Passages that repeat: suffix buckets over a difference cover, by bounded depth.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts somewhere else. Two equal
strings are two suffixes that tie over LENGTH bytes, and a difference cover bounds what must be
sorted to find such ties:

* The cover ``COVER`` modulo ``PERIOD`` holds, for any two places, a common shift below PERIOD that
  takes both into the sample. So the sample suffixes, one in thirteen, are ranked first, to a depth
  of LENGTH - PERIOD + 1 bytes: bucket by bucket, equal strings get equal ranks.
* A suffix can tie over LENGTH bytes only if a sample place within its first PERIOD bytes ties. Only
  such suffixes are dealt into buckets, and each bucket is sorted on its own for the ties.

What matters is which strings are equal, not which is smaller; so suffixes are ordered, and dealt
into buckets, by a 64-bit hash of their prefix, which costs the same for any text, however long its
ties are. Equal texts are one class from the start.

Entries cross the network packed: a unit of texts sends each bucket one row of hashes and the entries'
numbers within the unit, and a bucket answers each unit with the numbers that tie.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from cohortloom.llm.text import BYTE_CODE, STEP, STEP_BACK, mixed, powers, stored, utf8

LENGTH = 400
#: A perfect difference set; its 14 members have every difference modulo 183.
PERIOD = 183
COVER = (0, 1, 3, 16, 23, 28, 42, 76, 82, 86, 119, 137, 154, 175)
#: Bytes of text in a unit, and of packed entries in a bucket.
UNIT_BYTES = 8_000_000
BUCKET_BYTES = 16_000_000
#: Most texts' keys that are broadcast to pick texts from the scan; beyond, keys and texts meet in a shuffle.
BROADCAST_KEYS = 500_000

_MOVED = "bucket long, unit long, numbers binary, more binary, hashes binary"


def _packed(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, *arrays)
    return out.getvalue()


def _unpacked(data: bytes) -> list[np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return [found[name] for name in found.files]


def _steps(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending numbers as one byte for each step, large steps apart."""
    steps = np.diff(numbers, prepend=0)
    large = steps >= 255
    return np.where(large, 255, steps).astype(np.uint8).tobytes(), steps[large].astype(np.uint32).tobytes()


def _numbers(steps: bytes, large: bytes) -> np.ndarray:
    found = np.frombuffer(steps, np.uint8).astype(np.int64)
    found[found == 255] = np.frombuffer(large, np.uint32)
    return np.cumsum(found)


def _rolling(data: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
    """A function for the hashes of the strings of a length at given places."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(STEP, len(data)), out=total[1:])
    back = powers(STEP_BACK, len(data) + 1)
    return lambda at, length: mixed((total[at + length] - total[at]) * back[at])


def _expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _sample(lengths: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sample in texts of these lengths, one text after another, and their number in each."""
    cover = np.array(COVER)
    last = lengths - depth  # last place with ``depth`` bytes
    rounds = np.where(last >= 0, last // PERIOD + 1, 0)
    turn = _expand(np.zeros(len(lengths), np.int64), rounds)
    places = (turn[:, None] * PERIOD + cover).ravel()
    fits = places <= np.repeat(np.repeat(last, rounds), len(cover))
    text = np.repeat(np.repeat(np.arange(len(lengths)), rounds), len(cover))[fits]
    return places[fits], np.bincount(text, minlength=len(lengths))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of bounded text."""
    for batch in batches:
        sizes = np.cumsum(np.append(0, pc.binary_length(batch["text"].cast(pa.large_string())).fill_null(0).to_numpy()))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(sizes, sizes[start] + UNIT_BYTES)))
            yield batch.slice(start, stop - start)
            start = stop


def _deal(unit: int, hashes: np.ndarray, home: bytes, buckets: int) -> pa.RecordBatch:
    """The rows that a unit sends: one to each bucket that has entries, and its home row."""
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.append(np.diff(bucket[order]) != 0, len(order) > 0)) + 1 if len(order) else np.zeros(0, int)
    rows = [(-1 - unit % buckets, unit, home, b"", b"")]
    start = 0
    for end in ends:
        some = order[start:end]
        rows.append((int(bucket[some[0]]), unit, *_steps(some), hashes[some].tobytes()))
        start = end
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "unit", "numbers", "more", "hashes"])


def _ties(moved: DataFrame) -> DataFrame:
    """Per unit, the home row and the numbers of entries whose hash another entry of any unit has.

    Each bucket is sorted on its own. A hash of many entries is no group of rows: the rows are packed by unit.
    """

    def run(table: pa.Table) -> pa.Table:
        if table.num_rows == 0 or table["bucket"][0].as_py() < 0:
            return table.select(["unit", "numbers", "more"]).append_column("home", pa.array([True] * table.num_rows, pa.bool_()))
        parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        sizes = np.array([len(p) for p in parts])
        hashes = np.concatenate(parts)
        order = np.argsort(hashes)
        same = np.zeros(len(hashes), bool)
        equal = hashes[order[1:]] == hashes[order[:-1]]
        same[order[1:][equal]] = True
        same[order[:-1][equal]] = True
        rows, start = [], 0
        for size, unit, steps, large in zip(sizes, table["unit"].to_pylist(), table["numbers"].to_pylist(), table["more"].to_pylist(), strict=True):
            hit = same[start : start + size]
            start += size
            if hit.any():
                rows.append((unit, *_steps(_numbers(steps, large)[hit]), False))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["unit", "numbers", "more", "home"])

    return moved.groupBy("bucket").applyInArrow(run, "unit long, numbers binary, more binary, home boolean")


def _gathered(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
    """A unit's home arrays and its numbers that tie, ascending."""
    home, found = [], []
    for steps, large, is_home in zip(table["numbers"].to_pylist(), table["more"].to_pylist(), table["home"].to_pylist(), strict=True):
        if is_home:
            home = _unpacked(steps)
        else:
            found.append(_numbers(steps, large))
    return home, np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _tied_samples(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """``key, runs``: for each text with a sample place that ties, the runs of places whose strings may tie."""
    depth = length - PERIOD + 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(_units(batches)):
            data, offsets = utf8(batch["text"])
            places, counts = _sample(np.diff(offsets), depth)
            hashes = _rolling(data)(places + np.repeat(offsets[:-1], counts), depth)
            keys = np.frombuffer(b"".join(batch["key"].to_pylist()), "S16")
            yield _deal(TaskContext.get().partitionId() << 32 | number, hashes, _packed(keys, np.diff(offsets)), buckets)

    def receive(table: pa.Table) -> pa.Table:
        (keys, lengths), hits = _gathered(table)
        places, counts = _sample(lengths, depth)
        text = np.repeat(np.arange(len(keys)), counts)[hits]
        # a string from here to PERIOD - 1 places before may reach over the sample place
        low = np.maximum(places[hits] - PERIOD + 1, 0)
        high = np.minimum(places[hits], lengths[text] - length) + 1
        use = low < high
        low, high, text = low[use], high[use], text[use]
        out_keys, runs = [], []
        for at in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1):
            if len(at):
                begin, end = _merged(low[at], high[at])
                out_keys.append(keys[text[at[0]]].ljust(16, b"\0"))
                runs.append(_packed(begin, end))
        return pa.table([pa.array(out_keys, pa.binary()), pa.array(runs, pa.binary())], names=["key", "runs"])

    return _ties(texts.mapInArrow(send, _MOVED)).groupBy("unit").applyInArrow(receive, "key binary, runs binary")


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [low, high) given by ascending low: maximal runs."""
    reach = np.maximum.accumulate(high)
    new = np.append(True, low[1:] > reach[:-1])
    return low[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(low) - 1)]


def _repeated(texts: DataFrame, buckets: int, length: int) -> DataFrame:
    """``key, spans``: maximal runs of bytes that a repeated string covers, from the candidate runs ``runs``."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(_units(batches)):
            data, offsets = utf8(batch["text"])
            runs = [_unpacked(x) for x in batch["runs"].to_pylist()]
            begin, end = (np.concatenate([r[i] for r in runs]) for i in (0, 1))
            count = np.array([len(r[0]) for r in runs])
            places = _expand(begin + np.repeat(offsets[:-1], count), end - begin)
            keys = np.frombuffer(b"".join(batch["key"].to_pylist()), "S16")
            yield _deal(TaskContext.get().partitionId() << 32 | number, _rolling(data)(places, length), _packed(keys, count, begin, end), buckets)

    def receive(table: pa.Table) -> pa.Table:
        (keys, count, begin, end), hits = _gathered(table)
        size = end - begin
        text = np.repeat(np.repeat(np.arange(len(keys)), count), size)[hits]
        place = _expand(begin, size)[hits]
        out_keys, spans = [], []
        for at in np.split(np.arange(len(text)), np.flatnonzero(np.diff(text)) + 1):
            if len(at):
                out_keys.append(keys[text[at[0]]].ljust(16, b"\0"))
                spans.append(_packed(*_merged(place[at], place[at] + length)))
        return pa.table([pa.array(out_keys, pa.binary()), pa.array(spans, pa.binary())], names=["key", "spans"])

    return _ties(texts.sortWithinPartitions("key").mapInArrow(send, _MOVED)).groupBy("unit").applyInArrow(receive, "key binary, spans binary")


def _cut(texts: DataFrame) -> DataFrame:
    """Rows of texts with spans: what was removed (``spans``: pairs of byte places) and the bytes that are left (``kept``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _units(batches):
            rows = []
            for text, packed in zip(whole["text"].to_pylist(), whole["spans"].to_pylist(), strict=True):
                begin, end = _unpacked(packed)
                data, left, at = text.encode(), [], 0
                for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                    left.append(data[at:a])
                    at = b
                kept = b"".join([*left, data[at:]])
                rows.append((int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest(), np.stack([begin, end], 1).ravel().tolist(), kept))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.binary()]
            found = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([whole["doc_id"], whole["n_bytes"], *found], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    texts = texts.select("doc_id", "n_bytes", "text", "spans")
    schema = StructType([*texts.schema.fields[:2], StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("spans", ArrayType(LongType())), StructField("kept", BinaryType())])
    return texts.mapInArrow(run, schema)


def _with_keys(texts: DataFrame, keys: DataFrame, rows: int, how: str) -> DataFrame:
    """Texts met with keyed rows: picked in the scan where the keys are few, so that only their texts move."""
    if rows > BROADCAST_KEYS:
        return texts.join(keys, "key", how)
    picked = texts.join(F.broadcast(keys.select("key")), "key", "left_anti" if how == "left_anti" else "left_semi")
    return picked.join(keys.hint("merge"), "key", how) if how == "inner" else picked


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept`` of each row.

    ``spans`` lists the removed byte runs, start and end; ``kept`` has the bytes that are left, which may
    begin or end within a character. Texts are UTF-8 bytes, null is empty; strings never cross texts.
    Texts shorter than ``length`` keep all. Of equal texts of ``length`` bytes or more nothing is left, in
    any of them. Rows may repeat, in id and text. An empty frame gives an empty one.
    """
    if length < 2 * PERIOD:
        raise ValueError(f"the cover needs strings of {2 * PERIOD} bytes or more")
    plain = F.coalesce(F.col(text), F.lit(""))
    # a key that Spark knows is never null: the joins of the long texts below then read one shuffle of them
    texts = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(plain).cast("long").alias("n_bytes"), F.coalesce(F.unhex(F.md5(plain)), F.lit(b"")).alias("key"), plain.alias("text"))
    classes = texts.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"), F.max("n_bytes").alias("n_bytes"))
    classes = stored(classes, "text-classes")
    total = classes.agg(F.sum("n_bytes")).first()[0] or 0
    at_least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = texts.where(F.col("n_bytes") >= length)
    # later copies of a text stay out: the class has one
    later = long.select("doc_id", "key").join(classes.where("copies > 1").select("key", "first"), "key").where("doc_id > first")
    later = stored(later.select("doc_id", "key").distinct(), "later-copies")
    copies = later.count()
    one = long.join(F.broadcast(later) if copies <= BROADCAST_KEYS else later, ["doc_id", "key"], "left_anti").select("key", "text")
    sample_bytes = total * len(COVER) * 9 // PERIOD
    candidates = stored(_tied_samples(one, max(at_least, sample_bytes // BUCKET_BYTES), length).groupBy("key").agg(F.first("runs").alias("runs")), "tied-samples")
    found = candidates.count()
    spans = _repeated(_with_keys(one, candidates, found, "inner"), max(at_least, total * 9 // 4 // BUCKET_BYTES), length).groupBy("key").agg(F.first("spans").alias("spans"))
    gone = classes.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select("key")
    spans = stored(spans.join(gone, "key", "left_anti"), "spans")
    n_cut, n_gone = spans.count(), gone.count()
    # a class with spans that is not gone has one row; short texts meet no keys
    whole = _with_keys(long, spans.select("key").union(gone), n_cut + n_gone, "left_anti").unionByName(texts.where(F.col("n_bytes") < length))
    none = F.lit(0).cast("long")
    return (
        _with_keys(long.drop("text"), gone, n_gone, "left_semi")
        .select(
            "doc_id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.sha2(F.lit(""), 256).alias("kept_sha256"), F.array(none, "n_bytes").alias("spans"), F.lit(b"").alias("kept"),
        )
        .unionByName(_cut(_with_keys(long, spans, n_cut, "inner")))
        .unionByName(whole.select(
            "doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"),
            F.sha2("text", 256).alias("kept_sha256"), F.array().cast("array<bigint>").alias("spans"), F.col("text").cast("binary").alias("kept"),
        ))
    )
