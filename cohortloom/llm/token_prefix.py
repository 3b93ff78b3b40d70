"""Token counts of every prefix of a text under a public byte-level BPE vocabulary.

The count of a prefix follows from a shorter one: a BPE encoding is the one sequence of tokens in
which every adjacent pair is stable, that is, encodes to itself. So the last token of a prefix is
the one suffix that is a token and stable after the last token of what stands before it, and the
prefix has one token more than that. One pass from left to right fills both tables. Each different
piece of text (a word, a number, a run of white space) is worked out once per task and then looked
up, and the counts of a text are those of its pieces, added up.

The counts are those of the library for each prefix taken as a text of its own: where cutting a
text changes how it falls into pieces (inside white space, a contraction or a special string), the
prefix has the count of its own pieces.

Rows: null texts are empty and have no tokens; repeated rows and ids are counted one by one; an
empty table gives an empty one; columns named like the results are kept inside ``row``. Long texts
are taken in blocks of pieces; memory follows the longest text by four bytes a character.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from cohortloom.llm.text import own

# The public byte-level pre-tokeniser's pattern, and its contractions of two letters.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CONTRACTIONS = ("'re", "'ve", "'ll")
#: Letters, digits, signs and white space that stand in for characters that the two Unicode tables class differently.
STAND_INS = ("é", "1", "!", "\t")
BLOCK = 200_000
#: What a task keeps of known pieces and pairs; all of it can be worked out again.
MOST_PIECES, MOST_COUNTS, MOST_PAIRS = 300_000, 4_000_000, 500_000
NEVER = 1 << 40


def read_tokenizer(path: str) -> str:
    """The tokenizer file, read where the job is defined and sent along with it."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _byte_of() -> dict[str, int]:
    """The printable characters that stand for bytes in the file: visible ones for themselves, the rest from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Prefix counts under one tokenizer; keeps what it has worked out, within bounds."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normalisation is counted here")
        byte = _byte_of()
        vocabulary = {"".join(chr(byte[c]) for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token)}
        self._rank: dict[int, int] = {}
        parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = ("".join(chr(byte[c]) for c in part) for part in (merge if isinstance(merge, list) else merge.split(" ")))
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if (len(left) > 1 and a not in parts) or (len(right) > 1 and b not in parts):
                raise ValueError("a merge uses a token that no earlier merge makes")
            self._rank[a << 32 | b] = rank
            parts.setdefault(whole, (a, b, rank))
        self._right = {i: self._spine(parts, i, 1) for i in vocabulary.values()}
        self._left = {i: self._spine(parts, i, 0) for i in vocabulary.values()}
        self._tokens = ahocorasick.Automaton()
        sound: set[int] = set()
        for token, i in sorted(vocabulary.items(), key=lambda item: len(item[0])):
            # A token counts if encoding its bytes gives it back: its parts do, and no other merge crosses their border first.
            if len(token) == 1 or (i in parts and parts[i][0] in sound and parts[i][1] in sound and self._stable(*parts[i])):
                sound.add(i)
                self._tokens.add_word(token, (len(token), i))
        self._tokens.make_automaton()
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special strings with conditions are not counted here")
        self._special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self._classes = Tokenizer.from_str(file).pre_tokenizer
        self._stand_in: dict[str, str] = {}
        self._seen: set[str] = set(map(chr, range(128)))
        self._pairs: dict[int, bool] = {}
        self._forget()

    @staticmethod
    def _spine(parts: dict, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one end of a token while it is merged, each with the rank at which it is used up."""
        out, used = [], NEVER
        while True:
            out.append((token, used))
            if token not in parts:
                return out
            used = parts[token][2]
            token = parts[token][side]

    def _stable(self, first: int, second: int, before: int = NEVER) -> bool:
        """Whether no merge joins two tokens at their border, or none of a rank below ``before``.

        Equal ranks go from left to right: a symbol used up by the same merge on its left is gone, one on the right is still there.
        """
        for x, x_used in self._right[first]:
            for y, y_used in self._left[second]:
                rank = self._rank.get(x << 32 | y)
                if rank is not None and rank < x_used and rank <= y_used and rank < before:
                    return False
        return True

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._n_counts = 0
        self._counts = np.zeros(1 << 16, np.int32)
        self._start = np.zeros(1 << 12, np.int64)
        self._length = np.zeros(1 << 12, np.int64)
        self._total = np.zeros(1 << 12, np.int32)
        self._space = np.zeros(1 << 12, bool)

    def _of_piece(self, piece: str) -> list[int]:
        """The dynamic programme over the bytes of one piece: token counts after each of its characters."""
        data = piece if piece.isascii() else piece.encode().decode("latin-1")
        n = len(data)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        pairs, done = self._pairs, 0
        for end, (size, token) in self._tokens.iter(data):
            end += 1
            if end == done:
                continue
            start = end - size
            if start:
                before = last[start]
                key = before << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= MOST_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._stable(before, token)
                if not fits:
                    continue
            last[end], count[end] = token, count[start] + 1
            done = end
        if len(data) != len(piece):
            ends = np.cumsum([1 if c < "\x80" else 2 if c < "ࠀ" else 3 if c < "\U00010000" else 4 for c in piece])
            return [count[e] for e in ends]
        if piece in CONTRACTIONS:  # cut after its first letter, it is a quotation mark and a word
            count[2] = 2
        return count[1:]

    def _add(self, piece: str) -> int:
        counts = self._of_piece(piece)
        i = self._index[piece] = len(self._index)
        while self._n_counts + len(counts) > len(self._counts):
            self._counts = np.concatenate([self._counts, np.zeros_like(self._counts)])
        if i >= len(self._start):
            grown = (np.concatenate([a, np.zeros_like(a)]) for a in (self._start, self._length, self._total, self._space))
            self._start, self._length, self._total, self._space = grown
        self._counts[self._n_counts : self._n_counts + len(counts)] = counts
        self._start[i], self._length[i], self._total[i], self._space[i] = self._n_counts, len(counts), counts[-1], piece.isspace()
        self._n_counts += len(counts)
        return i

    def _learn(self, text: str) -> None:
        """Look at characters not met before: does the library class them by older Unicode tables?"""
        for c in set(text) - self._seen:
            self._seen.add(c)
            theirs = [len(self._classes.pre_tokenize_str(other + c)) == 1 for other in ("a", "1", "!")]
            if theirs != [len(PIECES.findall(other + c)) == 1 for other in ("a", "1", "!")]:
                self._stand_in[c] = STAND_INS[theirs.index(True)] if True in theirs else STAND_INS[3]

    def _pieces(self, text: str) -> Iterator[str]:
        """The text's pieces; characters that the library classes otherwise go by their stand-ins."""
        if not text.isascii():
            self._learn(text)
            if self._stand_in and not self._stand_in.keys().isdisjoint(text):
                stands = text.translate(str.maketrans(self._stand_in))
                return (text[match.start() : match.end()] for match in PIECES.finditer(stands))
        return iter(PIECES.findall(text)) if len(text) <= BLOCK else (match.group() for match in PIECES.finditer(text))

    def _id(self, piece: str) -> int:
        return self._index[piece] if piece in self._index else self._add(piece)

    def _plain(self, text: str) -> np.ndarray:
        """Counts of a text without special strings."""
        blocks, base, run, run_base = [], 0, "", 0
        pieces = self._pieces(text)
        while block := list(islice(pieces, BLOCK)):
            if len(self._index) > MOST_PIECES or self._n_counts > MOST_COUNTS:
                self._forget()
            known = list(map(self._index.get, block))
            if None in known:
                known = [self._id(p) if i is None else i for i, p in zip(known, block)]
            ids = np.array(known, np.int64)
            lengths, totals = self._length[ids], self._total[ids].astype(np.int64)
            first = np.cumsum(lengths) - lengths
            before = base + np.cumsum(totals) - totals
            counts = self._counts[np.arange(first[-1] + lengths[-1]) + np.repeat(self._start[ids] - first, lengths)] + np.repeat(before, lengths)
            # White space before a word gives its last character to the next piece; a cut there has the whole run as one piece.
            for i in np.flatnonzero(self._space[ids[:-1]]).tolist():
                if block[i + 1][0].isspace():
                    counts[first[i + 1]] = before[i] + self._total[self._id(block[i] + block[i + 1][0])]
            if run and block[0][0].isspace():
                counts[0] = run_base + self._total[self._id(run + block[0][0])]
            run, run_base = (block[-1], int(before[-1])) if block[-1].isspace() else ("", 0)
            base = int(before[-1] + totals[-1])
            blocks.append(counts.astype(np.int32))
        return np.concatenate([np.zeros(1, np.int32), *blocks])

    def counts(self, text: str | None) -> np.ndarray:
        """Element i: the number of tokens of the first i characters; the last one is the text's."""
        text = text or ""
        if self._special is None or not (found := list(self._special.finditer(text))):
            return self._plain(text)
        out, base, at = [np.zeros(1, np.int32)], 0, 0
        for match in found:
            # Up to the special string's last character it is ordinary text to a prefix that ends inside it.
            upto = self._plain(text[at : match.end() - 1])
            out.append(upto[1:] + np.int32(base))
            base += int(upto[match.start() - at]) + 1
            out.append(np.array([base], np.int32))
            at = match.end()
        out.append(self._plain(text[at:])[1:] + np.int32(base))
        return np.concatenate(out)


@lru_cache(maxsize=2)
def prefix_counter(file: str) -> PrefixCounter:
    """One counter per worker and tokenizer."""
    return PrefixCounter(file)


def _longest(counts: np.ndarray, budget: int) -> int:
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def _over_texts(docs: DataFrame, tokenizer: str, text: str, fields: list[T.StructField], answer) -> DataFrame:
    """All rows as ``row``, and beside it what ``answer`` says of their texts' prefix counts."""
    file = read_tokenizer(tokenizer)
    row, value = own("row"), own("text")
    packed = docs.select(F.struct("*").alias(row), F.col(text).alias(value))
    schema = T.StructType([T.StructField("row", docs.schema), *fields])
    types = [(f.name, f.dataType) for f in fields]

    def run(batches):
        counter = prefix_counter(file)
        for batch in batches:
            answers = [answer(counter.counts(t.as_py())) for t in batch.column(1)]
            columns = [pa.array([a[i] for a in answers], pa.list_(pa.int32()) if isinstance(kind, T.ArrayType) else pa.int64()) for i, (_, kind) in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *(name for name, _ in types)])

    return packed.mapInArrow(run, schema)


def token_prefixes(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """Every row as ``row`` with ``prefix_tokens``: element i + 1 is the token count of the first i code points.

    Stored once, the column answers by :func:`tokens_in`, :func:`fits` and :func:`longest_within` in
    the JVM whatever is asked later about truncation and budgets; no text is encoded again.
    """
    kind = T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), True))
    return _over_texts(docs, tokenizer, text, [kind], lambda counts: (counts,))


def token_counts(docs: DataFrame, tokenizer: str, budget: int, text: str = "text") -> DataFrame:
    """Every row as ``row`` with ``n_tokens`` and ``chars_within``, the code points of the longest prefix of at most ``budget`` tokens.

    For those who ask once: the prefix counts are worked out alike, but only the answers leave the task.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("chars_within", T.LongType())]
    return _over_texts(docs, tokenizer, text, fields, lambda counts: (int(counts[-1]), _longest(counts, budget)))


def tokens_in(prefixes: Column, chars: Column) -> Column:
    """Tokens of the first ``chars`` code points (all of them, if there are fewer)."""
    return F.element_at(prefixes, F.least(F.greatest(chars, F.lit(0)) + 1, F.size(prefixes)).cast("int")).cast("long")


def fits(prefixes: Column, budget: int) -> Column:
    """Whether the whole text has at most ``budget`` tokens."""
    return F.element_at(prefixes, -1) <= budget


def longest_within(prefixes: Column, budget: int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens; a longer one can have fewer tokens than a shorter one."""
    within = F.reverse(F.transform(prefixes, lambda n: n <= budget))
    return (F.size(prefixes) - F.array_position(within, True)).cast("long")


def truncated(text: Column, prefixes: Column, budget: int) -> Column:
    """The text cut to its longest prefix of at most ``budget`` tokens; null: empty."""
    return F.substring(F.coalesce(text, F.lit("")), F.lit(1), longest_within(prefixes, budget).cast("int"))
