"""Small text expressions and Arrow helpers that several operators share."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import fresh_path

#: A word, wherever a contract counts words: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_list(text: Column) -> Column:
    """All words in order; null gives an empty list."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % modulus


def in_fold(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether the id falls in the fold; a null id falls in none."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(False))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to a new folder of the shared storage and read it back: cuts the lineage durably."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python workers get at most so many rows at a time from what is run inside: a batch of texts stands whole in the JVM and in the worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    if before is None or not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def place_of(docs: DataFrame, name: str) -> int:
    """Place of a column; its name as written goes first, then upper and lower case are alike."""
    names = docs.columns
    return names.index(name) if name in names else [c.lower() for c in names].index(name.lower())


def own(name: str) -> str:
    """A column name that no input has."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty) one after another, and the offset of each row's first byte."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: ASCII white space of the word pattern, as a table over byte values.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Odd 64-bit numbers, fixed so that every run and executor hashes alike.
_RANDOM = np.random.Generator(np.random.PCG64(20240501))
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_BACK = np.uint64(pow(int(STEP), -1, 2**64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection), so that low and high bits are alike random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), alike for equal bytes wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * powers(STEP, len(data)), out=total[1:])
    back = powers(STEP_BACK, len(data) + 1)
    return mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes of many rows, and the number of words of each row."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = word.copy()
    if len(data):
        first[1:] &= ~word[:-1] | edge[1:-1]
    last = word.copy()
    if len(data):
        last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))
