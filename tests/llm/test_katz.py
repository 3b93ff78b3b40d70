"""The Katz model against the same model in plain Python, and its sums to one."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm.katz import CUTOFF, good_turing, score_texts
from cohortloom.llm.queries_katz import op8_katz
from cases import FOLDER, no_docs, odd_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "</s>"]


class Plain:
    def __init__(self, texts):
        lists = [tokens(t) for t in texts]
        self.texts = len(lists)
        self.words = Counter(w for ws in lists for w in ws)
        self.pairs = Counter(p for ws in lists for p in zip(["<s>", *ws[:-1]], ws, strict=True))
        self.n, self.v = sum(self.words.values()), len(self.words)
        often = [np.array([sum(c == r for c in x.values()) for r in range(1, CUTOFF + 2)], float) for x in (self.words, self.pairs)]
        self.dw, self.dp = map(good_turing, often)
        left = sum((1 - self.dw[min(c, CUTOFF + 1)]) * c for c in self.words.values())
        self.left, self.total = (left, self.n) if left > 0 else (1.0, self.n + 1)
        self.free, self.covered = defaultdict(float), defaultdict(float)
        for (a, b), c in self.pairs.items():
            self.free[a] += (1 - self.dp[min(c, CUTOFF + 1)]) * c
            self.covered[a] += self.word(b)

    def word(self, w):
        c = self.words[w]
        return self.dw[min(c, CUTOFF + 1)] * c / self.total if c else self.left / self.total

    def pair(self, a, b):
        c = self.texts if a == "<s>" else self.words[a]
        if not c:
            return self.word(b)
        full = c + (self.free[a] <= 0)
        n = self.pairs[a, b]
        return self.dp[min(n, CUTOFF + 1)] * n / full if n else max(self.free[a], 0 if self.free[a] > 0 else 1) / full / (1 - self.covered[a]) * self.word(b)

    def score(self, text):
        ws = tokens(text)
        return sum(math.log10(self.pair(a, b)) for a, b in zip(["<s>", *ws[:-1]], ws, strict=True))

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in tokens(text))


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    plain = Plain([t for i, t in docs if not held[i]])
    found = {r["doc_id"]: r for r in op8_katz(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for i, text in docs:
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(tokens(text)), plain.n)
        assert r["n_known"] == sum(plain.words[w] > 0 for w in tokens(text))
        assert r["base_score"] == pytest.approx(plain.base(text)) and r["score"] == pytest.approx(plain.score(text))
    for context in ["<s>", *list(plain.words)[:5]]:
        if context != "</s>":
            assert sum(plain.pair(context, w) for w in plain.words) + plain.pair(context, "never seen") == pytest.approx(1)


def test_good_turing_falls_back_where_counts_are_few():
    assert good_turing(np.zeros(CUTOFF + 1)).tolist() == [1.0, 0.5, 0.75, 1 - 0.5 / 3, 0.875, 0.9, 1.0]
    factors = good_turing(np.array([1000.0, 400, 220, 140, 100, 70]))
    assert (factors[1:-1] < 1).all() and (factors > 0).all()


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("train", F.col("doc_id") % 3 != 1)
    rows = score_texts(docs, F.col("train")).collect()
    assert len(rows) == docs.count()
    plain = Plain([r["text"] for r in docs.where("train").collect()])
    texts = Counter((len(tokens(r["text"])), round(plain.score(r["text"]), 6)) for r in docs.collect())
    assert Counter((r["n_tokens"], round(r[-1], 6)) for r in rows) == texts
    untrained = score_texts(docs.limit(3), F.lit(False), keep=["doc_id"]).collect()
    assert all(r["score"] == pytest.approx(0) and r["n_known"] == 0 for r in untrained)
    assert score_texts(no_docs(spark), F.lit(True), keep=["doc_id"]).count() == 0
