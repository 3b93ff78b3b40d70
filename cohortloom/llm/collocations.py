"""Phrases whose words stand together more often than their parts would by chance, per language.

Counting takes one pass over the texts for each length, from single words to ``LONGEST`` words. A
phrase can only be frequent if the two phrases one word shorter inside it are, so each pass counts
the pairs of frequent shorter phrases that overlap in all but one word. A task adds up its texts
and sends one row per phrase. The frequent phrases found so far go to the tasks while they are at
most ``MOST_KNOWN``; beyond that a pass counts without that knowledge: more rows, the same result.

The frequent phrases are then kept as two sorted streams: in prefix order, where a phrase comes
right after what it begins with, and in suffix order, the same over reversed words. The streams of
all lengths are read in lockstep, the last phrase of each length in hand, so the counts of
all first parts of a phrase (and, in suffix order, of all its last parts) are there when it comes
by; so is the phrase that it extends. Nothing is looked up by hash. The streams are cut into ranges
that each task reads alone; what the first phrase of a range begins with is handed to it along with the range.

Rows: null texts are empty; a null language is ``und``; repeated rows count each; an empty table
gives an empty one; other columns are not read. Memory follows the longest stretch of one
text without a separator; very long texts are taken in blocks that end at separators.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import stored

LONGEST = 5
MOST_KNOWN, MOST_KNOWN_BYTES = 2_000_000, 64 << 20
#: A task hands on what it has counted when it holds so many different phrases.
MOST_HELD = 1_000_000
BLOCK = 8 << 20
UNKNOWN = "und"

_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(string.ascii_uppercase.encode() + _SEPARATORS, string.ascii_lowercase.encode() + b"\n" * len(_SEPARATORS))
#: Stands between pieces; no UTF-8 text has this byte.
_BREAK = b"\xff"


def _blocks(batches) -> Iterator[tuple[str, list[bytes]]]:
    """Words of many texts of one language, breaks among them."""

    def cut(data: bytes) -> Iterator[bytes]:
        while len(data) > 2 * BLOCK and (at := data.find(_BREAK, BLOCK)) >= 0:
            yield data[:at]
            data = data[at:]
        yield data

    waiting: dict[str, list[bytes]] = {}
    size: Counter = Counter()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = (text.as_py() or "").encode().translate(_PLAIN)
            waiting.setdefault(lang, []).append(re.sub(rb"\n+", b" \xff ", data))
            size[lang] += len(data)
            if size[lang] > BLOCK:
                for part in cut(b" \xff ".join(waiting.pop(lang))):
                    yield lang, part.split()
                size[lang] = 0
    for lang, texts in waiting.items():
        for part in cut(b" \xff ".join(texts)):
            yield lang, part.split()


def _count_words(batches) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            counts.pop(_BREAK, None)
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), words, pa.array(counts.values(), pa.int64())], names=["lang", "phrase", "f"])
        held.clear()

    for lang, words in _blocks(batches):
        held.setdefault(lang, Counter()).update(words)
        if sum(map(len, held.values())) > MOST_HELD:
            yield from handed()
    yield from handed()


class _Known:
    """What earlier passes found: the frequent words, and per length the frequent pairs of shorter phrases; None where that is too much to send."""

    def __init__(self, words: dict[str, pa.Array] | None, pairs: list[np.ndarray | None]):
        self.words = words
        self.pairs = pairs

    def lasting(self) -> bool:
        """Whether its numbers mean the same everywhere."""
        return self.words is not None and all(p is not None for p in self.pairs)

    def start(self) -> dict[str, int]:
        """The number of each language's first word."""
        sizes = [len(words) for words in self.words.values()]
        return dict(zip(self.words, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(int).tolist())) if sizes else {}


def _places(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each number among the sorted known ones, -1 for others."""
    if not len(known):
        return np.full(len(found), -1, np.int64)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return np.where(known[at] == found, at, -1)


def _overlapping(index: np.ndarray) -> np.ndarray:
    """Places where a phrase and the one that starts a word later are both known."""
    return np.flatnonzero((index[:-1] >= 0) & (index[1:] >= 0))


def _pair(index: np.ndarray, at: np.ndarray) -> np.ndarray:
    return index[at] << 32 | index[at + 1]


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, counts, len(keys)).astype(np.int64)


def _word_numbers(pairs: list[np.ndarray], keys: np.ndarray) -> list[np.ndarray]:
    """The words of phrases that are given as pairs of shorter ones, one array per place."""
    first, second = keys >> 32, keys & 0xFFFFFFFF
    if not pairs:
        return [first, second]
    *shorter, level = pairs
    return [*_word_numbers(shorter, level[first]), _word_numbers(shorter, level[second])[-1]]


def _spelled(words: pa.Array, numbers: list[np.ndarray]) -> pa.Array:
    return pc.binary_join_element_wise(*(words.take(pa.array(i)) for i in numbers), " ")


def _indexed(known: _Known, lang: str, block: list[bytes], numbers: dict[str, dict[bytes, int]]) -> tuple[np.ndarray, list[np.ndarray], pa.Array | None]:
    """Per place of a block the number of the longest phrase length reached that starts there (-1: none), the pairs behind the numbers, and the words."""
    words = None
    if known.words is not None:
        if lang not in numbers:
            start = known.start().get(lang)
            numbers[lang] = {} if start is None else {w.encode(): start + i for i, w in enumerate(known.words[lang].to_pylist())}
        find = numbers[lang].get
        index = np.array([find(w, -1) for w in block], np.int64)
    else:
        here = {w: i for i, w in enumerate(dict.fromkeys(block))}
        index = np.array([here[w] for w in block], np.int64)
        if _BREAK in here:
            index[index == here[_BREAK]] = -1
        words = pa.array([b"" if w == _BREAK else w for w in here], pa.binary()).cast(pa.string())
    pairs = []
    for level in known.pairs:
        at = _overlapping(index)
        found = _pair(index, at)
        level = np.unique(found) if level is None else level
        index = np.full(len(index), -1, np.int64)
        index[at] = _places(found, level)
        pairs.append(level)
    return index, pairs, words


def _count_pairs(known: _Known):
    """Counts of the phrases one word longer than ``known`` reaches, as pairs of its numbers."""

    def run(batches):
        numbers: dict[str, dict[bytes, int]] = {}
        held, n = [], 0
        for lang, block in _blocks(batches):
            index, _, _ = _indexed(known, lang, block, numbers)
            held.append(np.unique(_pair(index, _overlapping(index)), return_counts=True))
            n += len(held[-1][0])
            if n > 4 * MOST_HELD:
                held = [_added(*(np.concatenate(x) for x in zip(*held)))]
                n = len(held[0][0])
                if n > 2 * MOST_HELD:
                    yield _pair_batch(held)
                    held, n = [], 0
        if held:
            yield _pair_batch(held)

    return run


def _pair_batch(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    keys, counts = _added(*(np.concatenate(x) for x in zip(*held)))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["key", "f"])


def _spell(known: _Known):
    """Frequent pairs as text, with their language."""

    def run(batches):
        words = pa.concat_arrays(list(known.words.values()))
        langs, starts = pa.array(list(known.words), pa.string()), np.array(list(known.start().values()))
        for batch in batches:
            keys = batch.column(0).to_numpy()
            numbers = _word_numbers(known.pairs, keys)
            lang = langs.take(pa.array(np.searchsorted(starts, numbers[0], side="right") - 1))
            yield pa.RecordBatch.from_arrays([lang, _spelled(words, numbers), batch.column(1), batch.column(0)], names=["lang", "phrase", "f", "key"])

    return run


def _count_spelled(known: _Known):
    """The same counts where numbers do not last from one block to the next: phrases are told apart by their text."""

    def run(batches):
        numbers: dict[str, dict[bytes, int]] = {}
        everything = pa.concat_arrays(list(known.words.values())) if known.words else None
        for lang, block in _blocks(batches):
            index, pairs, words = _indexed(known, lang, block, numbers)
            keys, counts = np.unique(_pair(index, _overlapping(index)), return_counts=True)
            if len(keys):
                phrases = _spelled(everything if words is None else words, _word_numbers(pairs, keys))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), phrases, pa.array(counts)], names=["lang", "phrase", "f"])

    return run


def frequent_phrases(docs: DataFrame, least: int, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, m, f`` of all phrases of 1 to ``LONGEST`` words with ``f >= least``, and ``lang, n``."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    counted = stored(counted, "words")
    totals = stored(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    level = counted.where(F.col("f") >= least)
    found = [level.select("lang", "phrase", F.lit(1).alias("m"), "f")]
    rows, size = level.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("phrase") + 8), F.lit(0))).first()
    known = _Known(None, [])
    if rows <= MOST_KNOWN and size <= MOST_KNOWN_BYTES:
        words = level.select("lang", "phrase").orderBy("lang", "phrase").toArrow()
        langs = words.column("lang").combine_chunks()
        known.words = {name: words.column("phrase").combine_chunks().cast(pa.string()).filter(pc.equal(langs, name)) for name in langs.unique().to_pylist()}
    for m in range(2, LONGEST + 1):
        if not rows:
            break
        sent = spark.sparkContext.broadcast(known)
        if known.lasting():
            counted = texts.mapInArrow(lambda batches, sent=sent: _count_pairs(sent.value)(batches), "key long, f long")
            counted = counted.groupBy("key").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
            counted = counted.mapInArrow(lambda batches, sent=sent: _spell(sent.value)(batches), "lang string, phrase string, f long, key long")
        else:
            counted = texts.mapInArrow(lambda batches, sent=sent: _count_spelled(sent.value)(batches), "lang string, phrase string, f long")
            counted = counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
        level = stored(counted, f"phrases-{m}")
        found.append(level.select("lang", "phrase", F.lit(m).alias("m"), "f"))
        rows = level.count()
        pairs = level.select("key").orderBy("key").toArrow().column("key").to_numpy() if known.lasting() and rows <= MOST_KNOWN else None
        known = _Known(known.words, [*known.pairs, pairs])
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return phrases, totals


def _in_lockstep(batches) -> Iterator[pa.RecordBatch]:
    """Read the sorted streams of all lengths together: beside each phrase, the counts of what it begins with, shortest first."""
    hand: list[tuple[str, int]] = []
    place = None
    for batch in batches:
        part, lang, words, count, own = (batch.column(i).to_pylist() for i in range(5))
        keep, parts = [], []
        for i in range(len(part)):
            if place != (part[i], lang[i]):
                hand, place = [], (part[i], lang[i])
            shared = 0
            while shared < min(len(hand), len(words[i]) - 1) and hand[shared][0] == words[i][shared]:
                shared += 1
            hand = hand[:shared]
            if own[i]:
                keep.append(i)
                parts.append([f for _, f in hand])
            # every phrase a frequent one begins with is frequent, so the hand has one entry per word
            hand.append((words[i][-1], count[i]))
        columns = [batch.column(i).take(pa.array(keep, pa.int64())) for i in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.list_(pa.int64()))], names=["lang", "words", "f", "parts"])


def _stream(phrases: DataFrame, words: Column, name: str) -> DataFrame:
    """``lang, words, f, parts``: the phrases in order of ``words``, ``parts`` the counts of their first 1 to m - 1 words."""
    tasks = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = phrases.select("lang", words.alias("words"), "f").repartitionByRange(tasks, "lang", "words")
    rows = stored(ranges.select(F.spark_partition_id().alias("part"), "lang", "words", "f", F.lit(True).alias("own")), name)
    first = rows.groupBy("part").agg(F.min(F.struct("lang", "words")).alias("first"))
    # at most LONGEST - 1 phrases a range: what its first phrase begins with
    begins = first.where(F.size("first.words") > 1).select(
        F.col("part").alias("to"), F.col("first.lang").alias("lang"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("first.words") - 1), lambda k: F.slice("first.words", 1, k))).alias("words"),
    )
    handed = rows.join(F.broadcast(begins), ["lang", "words"]).where(F.col("part") != F.col("to"))
    handed = handed.select(F.col("to").alias("part"), "lang", "words", "f", F.lit(False).alias("own"))
    ordered = rows.unionByName(handed).repartition(tasks, "part").sortWithinPartitions("part", "lang", "words")
    return ordered.mapInArrow(_in_lockstep, "lang string, words array<string>, f long, parts array<long>")


def collocations(docs: DataFrame, least: int = 100, most: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``most`` best phrases.

    ``a`` is a phrase's count, ``l`` and ``r`` those of the two parts of the cut with the lowest
    ``score``, floor(1000 a n / (l r)), ``n`` the language's number of words. A phrase that a longer one
    with the same count contains is left out.
    """
    phrases, totals = frequent_phrases(docs, least, text, lang)
    words = F.split("phrase", " ")
    ahead = _stream(phrases, words, "prefix-order")
    behind = _stream(phrases, F.reverse(words), "suffix-order")
    ahead = stored(ahead.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"), F.col("parts").alias("firsts")), "firsts")
    behind = stored(behind.where(F.size("words") > 1).select("lang", F.reverse("words").alias("words"), F.col("f").alias("a"), F.col("parts").alias("lasts")), "lasts")
    # a phrase is covered by a longer one exactly if it is by one of a word more, as counts can only fall on the way there
    longer = F.size("words") - 1
    covered = ahead.where((longer > 1) & (F.col("a") >= F.element_at("firsts", -1))).select("lang", F.slice("words", F.lit(1), longer).alias("words"))
    covered = covered.unionByName(behind.where((longer > 1) & (F.col("a") >= F.element_at("lasts", -1))).select("lang", F.slice("words", F.lit(2), longer).alias("words")))
    both = ahead.join(behind.select("lang", "words", "lasts"), ["lang", "words"]).join(covered, ["lang", "words"], "left_anti").join(totals, "lang")

    def cut(k: Column) -> Column:
        left, right = F.element_at("firsts", k), F.element_at("lasts", F.size("words") - k)
        exact = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)"))
        score = F.call_function("div", exact, left.cast("decimal(19,0)") * right.cast("decimal(18,0)"))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    scored = both.withColumn("cut", F.array_min(F.transform(F.sequence(F.lit(1), longer), cut)))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of many parts first, so that no task sees all phrases of a language
    salt = F.pmod(F.xxhash64("phrase"), F.lit(64))
    near = scored.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("place") <= most)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
