"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

The items are few and indexed; the corpus is the stream of queries. A passage is a window of words.
Its score for an item is the sum, over the item's words in the passage, of the words' BM25 impacts.
As in block-max WAND, items stand in blocks with the largest impact of each word per block, so that a
passage whose bound stays below a block's lowest threshold skips the block; in the other blocks, many
passages together, an item is left out whose score in a passage's two halves stays below its threshold.
What reaches the threshold is verified: both halves of the item, its question and its
answer, must overlap with the text around by word trigrams. Items too short for that are found as a
whole: word for word, by case and white space alone not told apart. A character of a script without
spaces counts as a word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import mixed, own, place_of, span_hashes, utf8, word_list, word_spans

#: Words of half a passage; passages overlap by half, so that any run of so many words is in one.
STEP = 64
#: Items in a block of the index.
BLOCK = 16
GRAM = 3
#: Scores of half passages by item that are held at a time.
CELLS = 1 << 18


@dataclass(frozen=True)
class Rules:
    """BM25 parameters, thresholds, the shortest item that is found by overlap, and the items of one index."""

    k1: float = 1.2
    b: float = 0.75
    share: float = 0.5  # of the score that the item itself has
    overlap: float = 0.5  # of the distinct trigrams of the question, and of the answer
    least_words: int = 8
    most_items: int = 20_000


#: Scripts without spaces between words.
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")


def _folded(texts: pa.Array) -> pa.Array:
    """Lower case in any alphabet: a leak in capitals is a leak. Characters of scripts without spaces stand alone."""
    lower = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    if (utf8(lower)[0] >= 0xE0).any():  # such characters have three bytes or more
        lower = pc.replace_substring_regex(lower, "([" + "".join(rf"\p{{{x}}}" for x in UNSPACED) + "])", r" \1 ")
    return lower


def _item_words(text: Column) -> Column:
    return word_list(F.regexp_replace(F.lower(text), "([" + "".join(rf"\p{{Is{x}}}" for x in UNSPACED) + "])", " $1 "))


def _lettered(folded: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that are left without punctuation, and their number in each text."""
    data, offsets = utf8(pc.replace_substring_regex(folded, r"[^\p{L}\p{N}\p{M}]+", " "))
    starts, ends, count = word_spans(data, offsets)
    return span_hashes(data, starts, ends), count


def _run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of so many words from each place on."""
    value = np.zeros(max(len(words) - size + 1, 0), np.uint64)
    for k in range(size):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(value)])
    return value


class Index:
    """Impacts of words on items, by block, with their upper bounds."""

    def __init__(self, items: list[tuple[str, str]], holders: dict[str, int], total: int, mean: float, rules: Rules):
        folded = _folded(pa.array([t for _, t in items], pa.string()))
        data, offsets = utf8(folded)
        starts, ends, count = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        names = [bytes(data[a:b]).decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        self.ids = [i for i, _ in items]
        self.vocabulary, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        item = np.repeat(np.arange(len(items)), count)
        df = np.array([holders.get(names[i], 1) for i in first], float)
        idf = np.log(1 + (total - df + 0.5) / (df + 0.5))
        pair, often = np.unique(word.astype(np.int64) * len(items) + item, return_counts=True)
        w, i = pair // len(items), pair % len(items)
        impact = idf[w] * often * (rules.k1 + 1) / (often + rules.k1 * (1 - rules.b + rules.b * count[i] / max(mean, 1)))
        self.words, self.items, self.impact = w, i, impact
        self.edges = np.searchsorted(w, np.arange(len(self.vocabulary) + 1))
        own_score = np.bincount(i, impact, minlength=len(items))
        # a window holds 2 * STEP words, at least STEP of them of a longer item's run
        self.threshold = rules.share * own_score * np.minimum(1, STEP / np.maximum(count, 1))
        # short items are not found by their score
        self.threshold[count < rules.least_words] = np.inf
        self.own_score = own_score
        self.short: dict[int, dict[int, list[tuple[int, str]]]] = {}
        plain, sizes = _lettered(folded)
        for number in np.flatnonzero(count < rules.least_words).tolist():
            run = plain[int(sizes[:number].sum()) : int(sizes[: number + 1].sum())]
            if len(run):
                whole = " ".join(folded[number].as_py().split())
                self.short.setdefault(len(run), {}).setdefault(int(_run_hashes(run, len(run))[0]), []).append((number, whole))
        self.blocks = -(-len(items) // BLOCK)
        self.bound = np.zeros((len(self.vocabulary), self.blocks), np.float32)
        np.maximum.at(self.bound, (w, i // BLOCK), impact)
        self.highest = self.bound.max(axis=1, initial=0)
        self.lowest = np.array([self.threshold[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.blocks)])
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.vocabulary >> np.uint64(42)).astype(np.int64)] = True
        self.length = count
        self.halves = []
        for number in range(len(items)):
            words_of = hashes[np.cumsum(count)[number] - count[number] : np.cumsum(count)[number]]
            middle = len(words_of) // 2
            self.halves.append((_grams(words_of[:middle]), _grams(words_of[middle:])))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that the index knows, and their numbers."""
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(42)).astype(np.int64)])
        at = np.searchsorted(self.vocabulary, hashes[maybe])
        at[at == len(self.vocabulary)] = 0
        same = self.vocabulary[at] == hashes[maybe]
        return maybe[same], at[same]


def _grams(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the trigrams; of the whole where it is shorter."""
    return np.unique(_run_hashes(words, min(GRAM, len(words))))


def _promising(index: Index, live: np.ndarray, joined: np.ndarray, edges: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The passages, named by their first halves, in which some item may reach its threshold.

    The scores of the two halves, added, are no less than the passage's: a word that both have counts once there.
    First the blocks are told apart by their bounds, then the items of the blocks that are left.
    """
    postings = np.diff(index.edges)
    threshold = index.threshold * (1 - 1e-6)
    rows, kept = max(1, CELLS // max(len(index.ids), 1)), []
    for begin in range(0, len(live), rows):
        some = live[begin : begin + rows]
        halves = np.unique(np.concatenate([some, some[joined[some]] + 1]))
        size = edges[halves + 1] - edges[halves]
        half = np.repeat(np.arange(len(halves)), size)
        words = word[np.repeat(edges[halves] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        left, right, two = np.searchsorted(halves, some), np.searchsorted(halves, some + 1), joined[some]
        # of each half and block
        bound = np.zeros((len(halves) + 1, index.blocks))
        full = np.flatnonzero(size)
        bound[full] = np.add.reduceat(index.bound[words], (np.cumsum(size) - size)[full], axis=0, dtype=float) if len(full) else 0
        may = bound[left] + np.where(two[:, None], bound[right], 0) >= index.lowest * (1 - 1e-6)
        wanted = np.zeros((len(halves) + 1, index.blocks), bool)
        wanted[left] = may
        wanted[right[two]] |= may[two]
        # of each half and item of these blocks
        each = postings[words]
        entry = np.repeat(index.edges[words] - np.cumsum(each) + each, each) + np.arange(each.sum())
        of = np.repeat(half, each)
        item = index.items[entry]
        use = wanted[of, item // BLOCK]
        score = np.bincount(of[use] * len(index.ids) + item[use], index.impact[entry[use]], minlength=(len(halves) + 1) * len(index.ids)).reshape(-1, len(index.ids))
        kept.append(some[((score[left] + np.where(two[:, None], score[right], 0)) >= threshold).any(axis=1)])
    return np.concatenate(kept) if kept else live


def _whole(index: Index, folded: pa.Array) -> Iterator[tuple[int, int]]:
    """Texts and the short items that they hold word for word, punctuation included."""
    if not index.short:
        return
    words, count = _lettered(folded)
    text_of = np.repeat(np.arange(len(count)), count)
    plain: dict[int, str] = {}
    for size, known in index.short.items():
        runs = _run_hashes(words, size)
        at = np.flatnonzero(np.isin(runs, np.array(list(known), np.uint64)))
        at = at[text_of[at] == text_of[at + size - 1]]
        for text, run in sorted(set(zip(text_of[at].tolist(), runs[at].tolist(), strict=True))):
            if text not in plain:
                plain[text] = " ".join(folded[text].as_py().split())
            for item, whole in known[run]:
                left, right = r"(?<!\w)" if whole[0].isalnum() else "", r"(?!\w)" if whole[-1].isalnum() else ""
                if re.search(left + re.escape(whole) + right, plain[text]):
                    yield text, item


def _hits(index: Index, texts: pa.Array, rules: Rules) -> list[list[dict]]:
    """Verified hits of each text."""
    folded = _folded(texts)
    data, offsets = utf8(folded)
    starts, ends, count = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    first = np.cumsum(count) - count
    text_of = np.repeat(np.arange(len(count)), count)
    # half passages: chunk c of a text and the next one are a passage
    chunks = -(-count // STEP)
    base = np.cumsum(chunks) - chunks
    place, word = index.find(hashes)
    chunk = base[text_of[place]] + (place - first[text_of[place]]) // STEP
    key = np.unique(chunk * len(index.vocabulary) + word)
    chunk, word = key // len(index.vocabulary), key % len(index.vocabulary)
    n = int(chunks.sum())
    text_of_chunk = np.repeat(np.arange(len(count)), chunks)
    joined = np.append(text_of_chunk[1:] == text_of_chunk[:-1], False) if n else np.zeros(0, bool)
    best = np.bincount(chunk, index.highest[word], minlength=n + 1)[: n + 1]
    bound = best[:n] + np.where(joined, best[1 : n + 1], 0)
    live = np.flatnonzero(bound >= index.lowest.min(initial=np.inf))
    edges = np.searchsorted(chunk, np.arange(n + 2))
    out: list[list[dict]] = [[] for _ in range(len(count))]
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    for c in _promising(index, live, joined, edges, word).tolist():
        words = np.unique(word[edges[c] : edges[c + (2 if joined[c] else 1)]])
        # skip blocks, then items, that cannot reach their threshold
        blocks = np.flatnonzero(index.bound[words].sum(axis=0) >= index.lowest * (1 - 1e-6))
        if not len(blocks):
            continue
        lists = [np.arange(index.edges[w], index.edges[w + 1]) for w in words.tolist()]
        entry = np.concatenate(lists)
        entry = entry[np.isin(index.items[entry] // BLOCK, blocks)]
        score = np.bincount(index.items[entry], index.impact[entry], minlength=len(index.ids))
        text = int(text_of_chunk[c])
        for item in np.flatnonzero((score >= index.threshold) & (index.length >= rules.least_words)).tolist():
            reach = int(index.length[item])
            low = max(first[text], first[text] + (c - base[text]) * STEP - reach)
            high = min(first[text] + count[text], first[text] + (c - base[text] + 2) * STEP + reach)
            around = _grams(hashes[low:high])
            shares = [np.isin(half, around).mean() if len(half) else 1.0 for half in index.halves[item]]
            if min(shares) >= rules.overlap:
                found[text, item] = max(found.get((text, item), (0.0, 0.0, 0.0)), (float(score[item]), float(shares[0]), float(shares[1])))
    for text, item in _whole(index, folded):
        found[text, item] = (float(index.own_score[item]), 1.0, 1.0)
    for (text, item), (score, question, answer) in sorted(found.items()):
        out[text].append({"item": index.ids[item], "score": score, "question": question, "answer": answer})
    return out


_HITS = "array<struct<item:string,score:double,question:double,answer:double>>"
_HIT_TYPE = pa.list_(pa.struct([("item", pa.string()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:  # noqa: B008
    """All columns of ``docs`` as the struct ``row``, with ``hits``: the benchmark items that its text holds.

    Items of fewer than ``rules.least_words`` words are found only as a whole, word for word. Null items and
    those without a letter or digit identify nothing.
    Word statistics are those of all items. Only an index of at most ``rules.most_items`` items is sent to
    the tasks at a time: a larger benchmark is searched block by block, every block against every row.
    Null texts have no hit; an empty benchmark none either. Rows are read whole and not moved.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).where(F.size(word_list(F.col("text"))) > 0)
    items = items.groupBy("id", "text").agg(F.count("*").alias("copies"))
    words = items.select("id", "text", F.explode(_item_words(F.col("text"))).alias("word"))
    holders = words.distinct().groupBy("word").agg(F.count("*").alias("n"))
    total, length = items.count(), words.count()
    key, place = own("row"), place_of(docs, text)
    result = docs.select(F.struct("*").alias("row"), F.array().cast(_HITS).alias("hits"))
    parts = -(-total // rules.most_items)
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part)
        rows = sorted((r["id"] or "", r["text"]) for r in block.collect())
        needed = holders if parts == 1 else holders.join(words.join(block, ["id", "text"], "left_semi").select("word").distinct(), "word", "left_semi")
        shared = spark.sparkContext.broadcast(Index(rows, {r["word"]: r["n"] for r in needed.collect()}, total, length / max(total, 1), rules))
        given = result.select(F.col("row").alias(key), F.col("hits"))
        kind = given.schema.simpleString()[len(f"struct<{key}:") :].rsplit(",hits:", 1)[0]

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for whole in batches:
                for start in range(0, whole.num_rows, 1024):
                    batch = whole.slice(start, 1024)
                    found = _hits(index, pc.struct_field(batch[key], [place]), rules)
                    if parts > 1:
                        found = [a + b for a, b in zip(batch["hits"].to_pylist(), found, strict=True)]
                    yield pa.RecordBatch.from_arrays([batch[key], pa.array(found, _HIT_TYPE)], ["row", "hits"])

        result = given.mapInArrow(run, f"row {kind}, hits {_HITS}")
    return result


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    return find_leaks(docs, benchmark, **options).where(F.size("hits") == 0).select("row.*")
