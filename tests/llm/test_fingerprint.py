"""Winnowing against a direct search of each window's smallest hash."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cohortloom.llm.fingerprint import K, WINDOW, add_fingerprint, fingerprint_with_next, next_blocks
from cases import FOLDER, no_docs, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def grams(spark, words):
    if not words:
        return []
    codes = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i").select(F.xxhash64("w")).collect()]
    if len(codes) < K:
        return [spark.createDataFrame([(" ".join(map(str, codes)),)], "w string").select(F.xxhash64("w")).first()[0]]
    rows = [(i, *codes[i : i + K]) for i in range(len(codes) - K + 1)]
    names = [f"c{i}" for i in range(K)]
    return [r[0] for r in spark.createDataFrame(rows, ", ".join(["i int", *[f"{n} long" for n in names]])).orderBy("i").select(F.xxhash64(*names)).collect()]


def winnowed(hashes):
    kept = {}
    for start in range(max(1, len(hashes) - WINDOW + 1) if hashes else 0):
        window = list(enumerate(hashes[start : start + WINDOW], start))
        place, value = min(window, key=lambda x: ((x[1] % 2**64) >> 28, -x[0]))
        kept[place] = value
    return sorted(kept.items())


@pytest.mark.parametrize("text", [None, "", "one", "one two", "one two three", "a a a a a a a a a a a a a a", " ".join(f"w{i * 7919 % 31}" for i in range(120))])
def test_smallest_of_each_window_rightmost_of_ties(spark, text):
    found = add_fingerprint(spark.createDataFrame([(text,)], "text string"), "text", "kept", "places").first()
    assert list(zip(found["places"], found["kept"], strict=True)) == winnowed(grams(spark, WORDS.findall(text or "")))


def test_a_shared_run_shares_a_hash(spark):
    run = " ".join(f"shared{i}" for i in range(K + WINDOW - 1))
    rows = [(f"before {run} after that",), (" ".join(f"x{i}" for i in range(40)) + " " + run,)]
    kept = [set(r["kept"]) for r in add_fingerprint(spark.createDataFrame(rows, "text string"), "text", "kept", "places").collect()]
    assert kept[0] & kept[1]


@pytest.mark.parametrize("per_block", [7, 500])
def test_each_row_meets_its_successor(spark, per_block):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    dealt = next_blocks(docs, "doc_id", "text", per_block=per_block)
    assert dealt.where("NOT guest").count() == docs.count()
    rows = dealt.orderBy("block", "guest", F.col("doc_id").desc()).collect()
    following = {a["doc_id"]: b["doc_id"] for a, b in zip(rows, rows[1:], strict=False) if a["block"] == b["block"] and not a["guest"]}
    ids = sorted([r["doc_id"] for r in docs.collect()], reverse=True)
    assert following == dict(zip(ids, [*ids[1:], ids[0]], strict=True))


def test_edited_texts(spark):
    docs = spark.createDataFrame([(1, "abcd"), (5, "x"), (9, "12345"), (12, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in fingerprint_with_next(docs).collect()}
    assert {i: r["edited"] for i, r in found.items()} == {12: "", 9: "123x", 5: "x", 1: "ab"}
    assert found[12]["near_edited"] == 1.0 and found[12]["n_chars"] == 0


def test_whole_table_against_plain_python(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    order = sorted(docs, reverse=True)
    found = fingerprint_with_next(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    by_text = {}
    for r in found:
        text = docs[r["doc_id"]]
        after = docs[order[(order.index(r["doc_id"]) + 1) % len(order)]]
        half = len(text) // 2
        assert hashlib.sha256(r["edited"].encode()).hexdigest() == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
        assert by_text.setdefault(text, r["kept"]) == r["kept"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert sum(r["near_edited"] > r["near_next"] for r in found) > 0.9 * len(found)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert fingerprint_with_next(docs).count() == docs.count()
    assert fingerprint_with_next(no_docs(spark)).count() == 0
