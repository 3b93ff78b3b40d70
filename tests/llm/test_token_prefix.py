"""Prefix token counts against the library that the vocabulary is made for."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.queries import QUERIES
from cohortloom.llm.queries_tokens import TOKENIZER
from cohortloom.llm.token_prefix import PrefixCounter, fits, longest_within, read_tokenizer, token_counts, token_prefixes, tokens_in, truncated
from cases import FOLDER, no_docs, odd_docs

PARTS = ["the", " ", "  ", "\n", "\t", "'ll", "'re", "'s", "don't", " 12", "345", "é", "日本語", "😀", "<|endoftext|>", "<|endo", "...", "----", "aaaaaaa",
         "XyZ", "՘", "꟎", "\U00010940", "int main(){", "    ", "'", "ﬀ", "\x1c", "\x85", "\r\n", "　"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(read_tokenizer(TOKENIZER))


def n_tokens(library, text):
    return len(library.encode(text, add_special_tokens=False))


def test_every_prefix_has_the_count_of_the_library(library, counter):
    rnd = random.Random(11)
    for _ in range(250):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        assert counter.counts(text).tolist() == [n_tokens(library, text[:i]) for i in range(len(text) + 1)], text


def test_blocks_and_forgetting_change_nothing(library, counter, monkeypatch):
    rnd = random.Random(12)
    text = "".join(rnd.choice(PARTS) for _ in range(400))
    whole = counter.counts(text)
    monkeypatch.setattr("cohortloom.llm.token_prefix.BLOCK", 3)
    monkeypatch.setattr("cohortloom.llm.token_prefix.MOST_PIECES", 2)
    monkeypatch.setattr("cohortloom.llm.token_prefix.MOST_PAIRS", 2)
    assert np.array_equal(PrefixCounter(read_tokenizer(TOKENIZER)).counts(text), whole)
    assert whole[-1] == n_tokens(library, text)


@pytest.mark.parametrize("text", ["x" * 30_000, " " * 30_000, "-=-" * 10_000, "日本" * 10_000, "a  \n b" * 5_000])
def test_long_pieces(library, counter, text):
    assert counter.counts(text)[-1] == n_tokens(library, text)


def test_stored_prefixes_answer_budgets(spark, library):
    stored = token_prefixes(odd_docs(spark), TOKENIZER)
    rows = stored.select("row.text", "prefix_tokens", fits("prefix_tokens", 100).alias("fits"), longest_within(F.col("prefix_tokens"), 7).alias("cut"),
                         truncated(F.col("row.text"), F.col("prefix_tokens"), 7).alias("cut_text"), tokens_in(F.col("prefix_tokens"), F.lit(5)).alias("five")).collect()
    assert len(rows) == odd_docs(spark).count()
    for r in rows:
        text = r.text or ""
        assert len(r.prefix_tokens) == len(text) + 1 and r.prefix_tokens[-1] == n_tokens(library, text)
        assert r.fits == (r.prefix_tokens[-1] <= 100) and r.five == n_tokens(library, text[:5])
        assert r.cut == max(i for i, n in enumerate(r.prefix_tokens) if n <= 7) and r.cut_text == text[: r.cut]


def test_counts_of_odd_and_no_rows(spark, library):
    rows = token_counts(odd_docs(spark), TOKENIZER, 50).collect()
    assert sorted(r.n_tokens for r in rows) == sorted(n_tokens(library, r.row.text or "") for r in rows)
    assert all(n_tokens(library, (r.row.text or "")[: r.chars_within]) <= 50 for r in rows)
    assert token_counts(no_docs(spark), TOKENIZER, 50).count() == 0


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = QUERIES["op11_tokens"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        i: (len(t.encode()), n := n_tokens(library, t), n > 1024) for i, t in texts.items()
    }


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        PrefixCounter(read_tokenizer(public_tokenizers.path("word_bpe_49k.json")))
