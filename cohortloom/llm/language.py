"""Language of a text by segmentation-marginalised unigrams over a fixed public vocabulary.

A language is a distribution over the pieces of a public tokenizer's vocabulary. The probability of
a word is the sum over all its segmentations into pieces, by the forward algorithm; a text's is the
product over its words. The distributions are fitted by expectation maximisation, forward and
backward over the same segmentations.

Words are what the pieces of the vocabulary cannot cross, so a batch of texts is reduced to its
distinct words first, and all words run through the recursion together, one character a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import batches_of, mixed, own, place_of, powers, stored
from cohortloom.session import fresh_path
from cohortloom.sources.published import remove_folder

WORD_START = "▁"
UNDECIDED = "und"
#: Texts pass through the recursion in blocks of so many characters of distinct words.
BLOCK_CHARS = 400_000
BATCH_ROWS = 1024
#: Distinct words of a language that a task of the fit takes.
TASK_WORDS = 100_000
_CODE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_CODE), -1, 2**64))


def read_vocabulary(path: str) -> list[str]:
    """The text pieces of a sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Pieces:
    """The vocabulary as a table from the hash of a piece to its number; number ``size`` is any other single character."""

    def __init__(self, pieces: list[str]):
        codes, offsets = _code_points(pieces)
        lengths = np.diff(offsets)
        self.size, self.longest = len(pieces), int(lengths.max(initial=1))
        sums, back = _sums(codes), powers(_BACK, len(codes) + 1)
        keys = mixed((sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]] + lengths.astype(np.uint64))
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], order.astype(np.int32)
        self.seen = np.zeros(1 << 22, bool)
        heads = (self.keys >> np.uint64(42)).astype(np.int64)
        self.seen[heads] = True
        #: Place of the first key with each head of 22 bits, and the most keys that share one.
        self.first = np.zeros(1 << 22, np.int32)
        self.first[heads[::-1]] = np.arange(self.size - 1, -1, -1)
        self.shared = int(np.bincount(np.cumsum(np.diff(heads, prepend=-1) > 0)).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each piece, -1 where there is none."""
        found = np.full(len(keys), -1, np.int32)
        heads = (keys >> np.uint64(42)).astype(np.int64)
        maybe = np.flatnonzero(self.seen[heads])
        at = self.first[heads[maybe]]
        for _ in range(self.shared):
            same = self.keys[at] == keys[maybe]
            found[maybe[same]] = self.ids[at[same]]
            maybe, at = maybe[~same], np.minimum(at[~same] + 1, self.size - 1)
        return found


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)


def _sums(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(1)) * powers(_CODE, len(codes)), out=out[1:])
    return out


def _lattice(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece number [position, length - 1, word] that ends at each position, and the words' lengths."""
    codes, offsets = _code_points([WORD_START + w for w in words])
    lengths = np.diff(offsets)
    n, top = int(lengths.max()), min(pieces.longest, int(lengths.max()))
    grid = np.full((n, top, len(words)), -1, np.int32)
    sums, back = _sums(codes), powers(_BACK, len(codes) + 1)
    starts = np.repeat(offsets[:-1], lengths)
    place, word = np.arange(len(codes)) - starts, np.repeat(np.arange(len(words)), lengths)
    for size in range(1, top + 1):
        end = np.flatnonzero(place >= size - 1)
        first = end + 1 - size
        found = pieces.find(mixed((sums[end + 1] - sums[first]) * back[first] + np.uint64(size)))
        if size == 1:
            found[found < 0] = pieces.size
        grid[place[end], size - 1, word[end]] = found
    return grid, lengths


def _chunks(words: list[str]) -> Iterator[np.ndarray]:
    """Numbers of words of like lengths, so many that their grid stays bounded."""
    order = np.argsort([len(w) for w in words], kind="stable")
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * (len(words[order[stop]]) + 1) <= BLOCK_CHARS // 4:
            stop += 1 if stop - start < 64 else min(64, len(order) - stop)
        yield order[start:stop]
        start = stop


def _forward(grid: np.ndarray, probability: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward sums [position + 1, word] of one language, and the logarithm of each position's scale."""
    n, top, words = grid.shape
    alpha, scale = np.zeros((n + 1, words)), np.zeros((n + 1, words))
    alpha[0] = 1
    padded = np.append(probability, 0.0)  # -1, no piece, has probability 0
    for end in range(n):
        total = np.zeros(words)
        shift = scale[end] if end else scale[0]
        for size in range(1, min(top, end + 1) + 1):
            before = end + 1 - size
            total += alpha[before] * np.exp(scale[before] - shift) * padded[grid[end, size - 1]]
        live = total > 0
        step = np.where(live, total, 1.0)
        alpha[end + 1] = np.where(live, 1.0, 0.0)
        scale[end + 1] = shift + np.log(step)
    return alpha, scale


def word_scores(words: list[str], pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's probability [word, language]."""
    out = np.zeros((len(words), len(probability)))
    for chunk in _chunks(words):
        grid, lengths = _lattice([words[i] for i in chunk], pieces)
        for language, p in enumerate(probability):
            _, scale = _forward(grid, p)
            out[chunk, language] = scale[lengths, np.arange(len(chunk))]
    return out


def expected_counts(words: list[str], weight: np.ndarray, pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    """Expected use of each piece over all segmentations of the weighted words, under one distribution."""
    counts = np.zeros(pieces.size + 1)
    for chunk in _chunks(words):
        grid, lengths = _lattice([words[i] for i in chunk], pieces)
        n, top, size_of = grid.shape
        _, forward = _forward(grid, probability)
        at = np.arange(size_of)
        whole = forward[lengths, at]
        # the entries that are pieces; few are, beyond the single characters
        used = {(end, size): np.flatnonzero(grid[end, size - 1] >= 0) for end in range(n) for size in range(1, min(top, end + 1) + 1)}
        backward = np.full((n + 1, size_of), -np.inf)
        backward[lengths, at] = 0.0
        pieces_used, shares, shift = [], [], np.zeros(size_of)
        for place in range(n - 1, -1, -1):
            # relative to the next position that leads to the word's end
            shift = np.where(np.isfinite(backward[place + 1]), backward[place + 1], shift)
            total = np.zeros(size_of)
            parts = []
            for size in range(1, min(top, n - place) + 1):
                use = used[place + size - 1, size]
                if len(use):
                    piece = grid[place + size - 1, size - 1, use]
                    part = np.exp(backward[place + size, use] - shift[use]) * probability[piece]
                    total[use] += part
                    parts.append((use, piece, part))
            reach = forward[place] + shift - whole
            for use, piece, part in parts:
                pieces_used.append(piece)
                shares.append(np.exp(reach[use]) * part * weight[chunk][use])
            with np.errstate(divide="ignore"):
                here = shift + np.log(total)
            backward[place] = np.where(total > 0, here, backward[place])
        counts += np.bincount(np.concatenate(pieces_used), np.concatenate(shares), minlength=pieces.size + 1)
    return counts


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words of a batch; the word number of every word in order; its row."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    rows = pc.list_parent_indices(split).to_numpy()
    coded = pc.dictionary_encode(pc.list_flatten(split))
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    numbers, distinct = coded.indices.to_numpy(), coded.dictionary
    some = pc.greater(pc.binary_length(distinct), 0).to_numpy(zero_copy_only=False)  # white space at an end leaves an empty word
    keep = some[numbers] if len(numbers) else np.zeros(0, bool)
    return distinct, numbers[keep], rows[keep]


@dataclass(frozen=True)
class LanguageModel:
    """Piece probabilities [language, piece], the last piece standing for any other character."""

    languages: list[str]
    pieces: list[str]
    probability: np.ndarray


def _counted_words(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n): how often each language's rows, those with a text and a language, have each word."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                for name in pc.unique(batch["lang"]).to_pylist():
                    distinct, numbers, _ = _words(batch["text"].filter(pc.equal(batch["lang"], name)))
                    count = np.bincount(numbers, minlength=len(distinct))
                    used = np.flatnonzero(count)
                    words = distinct.take(pa.array(used)).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), words, pa.array(count[used])], ["lang", "word", "n"])

    labelled = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    return labelled.mapInArrow(gather, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, vocabulary: list[str], text: str = "text", lang: str = "lang", rounds: int = 2, smoothing: float = 0.05) -> LanguageModel:
    """Fit a distribution for every value of ``lang`` on all rows with a text and a language.

    The rows are read once and reduced to the words of each language with their counts; every round then passes over these
    only. The vocabulary bounds what reaches the driver: one number for each language and piece. Without any
    such row the model knows no language.
    """
    spark = docs.sparkSession
    languages = sorted(r["lang"] for r in docs.select(F.col(lang).cast("string").alias("lang")).where(F.col(text).isNotNull() & F.col("lang").isNotNull()).distinct().collect())
    if not languages:
        return LanguageModel([], vocabulary, np.zeros((0, len(vocabulary) + 1)))
    path = fresh_path(spark, "language-words")
    with batches_of(spark, BATCH_ROWS):
        _counted_words(docs, text, lang).write.parquet(path)
    words = spark.read.schema("lang string, word string, n long").parquet(path)
    # few bytes, but a long calculation on each: as many tasks as a shuffle has, and more for many words
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words.count() // TASK_WORDS)
    probability = np.full((len(languages), len(vocabulary) + 1), 1.0 / (len(vocabulary) + 1))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, languages, probability))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, order, now = shared.value
            pieces, counts = Pieces(names), np.zeros_like(now)
            for batch in batches:
                for number, name in enumerate(order):
                    own_rows = batch.filter(pc.equal(batch["lang"], name))
                    if own_rows.num_rows:
                        counts[number] += expected_counts(own_rows["word"].to_pylist(), own_rows["n"].to_numpy().astype(float), pieces, now[number])
            number, some = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(some.astype(np.int32)), pa.array(counts[number, some])], ["language", "piece", "n"])

        expected = words.repartition(tasks, "lang", "word").sortWithinPartitions("lang").mapInArrow(expect, "language int, piece int, n double")
        gathered = expected.groupBy("language", "piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.zeros_like(probability)
        counts[gathered["language"].to_numpy(), gathered["piece"].to_numpy()] = gathered["n"].to_numpy()
        probability = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
        shared.unpersist()
    remove_folder(spark, path)
    return LanguageModel(languages, vocabulary, probability)


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as the struct ``row``, with ``lang_pred``, ``score`` and ``per_char``.

    ``per_char`` is the logarithm of the text's probability in that language, for each character and word start of
    its words without digits; NULL where there are none. ``score`` is the posterior of the predicted language, all languages being equally likely before.
    A text that is null or has no letter, and any text under a model without languages, gets ``und``
    and 0. Ties go to the first language by name. Texts are read whole; rows are not moved.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.probability))
    key, answer, place = own("row"), own("answer"), place_of(docs, text)
    given = docs.select(F.struct("*").alias(key), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(answer))
    schema = given.schema.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, names, probability = shared.value
        pieces = Pieces(names)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                has = batch[answer].to_numpy(zero_copy_only=False)
                texts = pc.struct_field(batch[key], [place]).take(pa.array(np.arange(len(has)), mask=~has))  # NULL where there is nothing to tell
                best, top, each = np.full(len(texts), UNDECIDED, object), np.zeros(len(texts)), np.full(len(texts), np.nan)
                if languages and has.any():
                    distinct, numbers, rows = _words(texts)
                    by_word = word_scores(distinct.to_pylist(), pieces, probability)
                    totals = np.stack([np.bincount(rows, by_word[numbers, i], minlength=len(texts)) for i in range(len(languages))], axis=1)
                    likely = np.exp(totals - totals.max(axis=1, keepdims=True))
                    likely /= likely.sum(axis=1, keepdims=True)
                    choice = likely.argmax(axis=1)
                    best[has] = np.array(languages, object)[choice][has]
                    top[has] = likely[np.arange(len(texts)), choice][has]
                    # numbers, addresses and keys say nothing about the language
                    plain = ~pc.match_substring_regex(distinct, "[0-9@]").to_numpy(zero_copy_only=False)[numbers]
                    numbers, rows = numbers[plain], rows[plain]
                    totals = np.stack([np.bincount(rows, by_word[numbers, i], minlength=len(texts)) for i in range(len(languages))], axis=1)
                    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False) + 1.0
                    with np.errstate(invalid="ignore"):
                        each[has] = (totals[np.arange(len(texts)), choice] / np.bincount(rows, chars[numbers], minlength=len(texts)))[has]
                yield pa.RecordBatch.from_arrays([batch[key], pa.array(best, pa.string()), pa.array(top), pa.array(each, from_pandas=True)], ["row", "lang_pred", "score", "per_char"])

    row = schema[len(f"struct<{key}:") :].rsplit(f",{answer}:", 1)[0]
    return given.mapInArrow(score, f"row {row}, lang_pred string, score double, per_char double")


def known_languages(
    docs: DataFrame, vocabulary: list[str], least_score: float = 0.35, leeway: float = 4.0, least_spread: float = 0.3, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` in one of the languages that its labels teach, with all their columns.

    A row goes if its text is null or has no letter, if no language is clearly likelier than the others (``least_score``), or
    if even the likeliest one explains its characters far worse than it does its own texts. That limit lies, for each language,
    ``leeway`` times as far below the median of ``per_char`` as the lowest hundredth of its labelled texts (or ``least_spread``, if
    that is more), so a language that no label teaches goes, and so do random letters. The model and the
    medians come from all labelled rows; every row is scored once, and the scored rows are written once. Repeated rows each stay or go alike; without
    labels, and of an empty table, nothing stays; columns named like the results are kept as they are.
    """
    model = fit_languages(docs, vocabulary, text, lang)
    with batches_of(docs.sparkSession, BATCH_ROWS):
        predicted = stored(predict_language(docs, model, text), "language-scores")
    told = predicted.where(F.col("lang_pred") == F.col("row").getField(lang).cast("string"))
    typical = told.groupBy("lang_pred").agg(F.percentile_approx("per_char", 0.5, 10_000).alias("middle"), F.percentile_approx("per_char", 0.01, 10_000).alias("low")).collect()
    limit = F.lit(float("-inf"))
    for r in typical:  # one row a language
        if r["middle"] is not None:
            lowest = r["middle"] - leeway * max(r["middle"] - r["low"], least_spread)
            limit = F.when(F.col("lang_pred") == r["lang_pred"], F.lit(lowest)).otherwise(limit)
    explained = F.coalesce(F.col("per_char") >= limit, F.lit(True))
    return predicted.where((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= least_score) & explained).select("row.*")
