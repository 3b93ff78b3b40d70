"""Leaks of benchmark items against a direct search, and the bounds of the index."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import decontaminate as module
from cohortloom.llm.decontaminate import Index, Rules, decontaminate, find_leaks
from cohortloom.llm.queries_decontaminate import op9_decontamination
from cases import FOLDER, no_docs, odd_docs


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def test_whole_table(spark):
    items = {str(r["item_id"]): words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r["doc_id"]: set(filter(None, r["items"].split(","))) for r in op9_decontamination(spark, FOLDER).collect()}
    assert set(found) == set(docs)
    for i, text in docs.items():
        grams = {tuple(text[k : k + 5]) for k in range(len(text) - 4)}
        want = set()
        for name, item in items.items():
            own = {tuple(item[k : k + 5]) for k in range(len(item) - 4)}
            if own and len(own & grams) >= 0.6 * len(own):
                want.add(name)
        assert found[i] == want


def planted(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]

    def noise(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(i, " ".join(f"é{i}x{k}" if k % 2 else rng.choice(vocabulary) for k in range(size))) for i, size in enumerate([8, 20, 64, 65, 200, 500])]
    texts = [noise(n) + " " + text.upper() + " " + noise(n) for _, text in items for n in (0, 63, 500)]
    texts += [noise(1000) for _ in range(6)] + [items[2][1][: len(items[2][1]) // 3]]
    return spark.createDataFrame(items, "item_id int, text string"), spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_items_of_any_length_at_any_place(spark):
    items, docs = planted(spark)
    for rules in (Rules(), Rules(most_items=2)):
        found = {r["row"]["doc_id"]: {h["item"] for h in r["hits"]} for r in find_leaks(docs, items, rules).collect()}
        assert found == {i: ({str(i // 3)} if i < 18 else set()) for i in range(25)}
    assert sorted(r["doc_id"] for r in decontaminate(docs, items).collect()) == list(range(18, 25))


def test_block_bounds_are_not_below_any_impact():
    rng = np.random.default_rng(3)
    items = [(str(i), " ".join(f"w{x}" for x in rng.integers(0, 200, 30))) for i in range(50)]
    index = Index(items, {}, 50, 30.0, Rules())
    assert (index.impact <= index.bound[index.words, index.items // 16] * (1 + 1e-6)).all()
    assert index.lowest.shape == (4,) and (index.lowest[index.items // 16] <= index.threshold[index.items]).all()


@pytest.mark.parametrize("cells", [1, 500, 1 << 18])
def test_only_passages_that_may_reach_a_threshold_are_searched(monkeypatch, cells):
    rng = random.Random(7)
    frequent, rare = [f"w{i}" for i in range(60)], [f"r{i}" for i in range(2000)]
    items = [(str(i), " ".join(rng.choice(frequent if k % 2 else rare) for k in range(40))) for i in range(40)]
    known = [w for _, text in items for w in text.split()]  # of all items, so that no passage holds much of one
    texts = ["", *(" ".join(rng.choice(known) for _ in range(n)) for n in (1, 63, 64, 65, 700, 2000)), "x " * 70 + items[3][1] + " y", None, items[9][1]]
    index, seen, narrow = Index(items, {w: 30 for w in frequent}, 40, 40.0, Rules()), [], module._promising
    monkeypatch.setattr(module, "CELLS", cells)
    monkeypatch.setattr(module, "_promising", lambda index, live, *rest: seen.extend([live, narrow(index, live, *rest)]) or seen[-1])
    found = module._hits(index, pa.array(texts, pa.string()), Rules())
    assert [[h["item"] for h in hits] for hits in found] == [*([[]] * 7), ["3"], [], ["9"]]
    assert len(seen[0]) > 40 and len(seen[1]) <= 8
    monkeypatch.setattr(module, "_promising", lambda index, live, *rest: live)
    assert module._hits(index, pa.array(texts, pa.string()), Rules()) == found


def test_odd_rows_and_empty_benchmarks(spark):
    docs = odd_docs(spark)
    items = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, "the quick brown fox jumps over the lazy dog"), (5, "the quick brown fox jumps over the lazy dog")], "item_id int, text string")
    out = decontaminate(docs, items)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == [0, 1, 10, 11, 12, 2, 3, 4, 5, 6, 9, None]
    assert decontaminate(docs, items.where("item_id = 99")).count() == docs.count()
    assert decontaminate(no_docs(spark), items).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    long = "日本の首都はどこですか東京です富士山の高さは何メートルですか"
    items = spark.createDataFrame([(1, "Who wrote  Emma? Austen"), (2, "x < 3"), (3, "首都は東京"), (4, long), (5, "?!")], "item_id int, text string")
    texts = ["he asked: WHO wrote\nEmma? Austen.", "who wrote Emma, Austen", "if x < 3, stop", "x > 3", "日本の首都は東京です", "東京は首都", f"前置き{long}後", "?!", "ex < 3", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["row"]["doc_id"]: {h["item"] for h in r["hits"]} for r in find_leaks(docs, items).collect()}
    assert found == {0: {"1"}, 1: set(), 2: {"2"}, 3: set(), 4: {"3"}, 5: set(), 6: {"4"}, 7: set(), 8: set(), 9: set()}


def test_leaks_beyond_the_first_block_of_a_batch(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(30)], "item_id int, text string")
    docs = spark.createDataFrame([(i, None if i % 31 == 30 else " ".join(f"w{i % 31}x{k}" for k in range(20))) for i in range(3000)], "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["items"] for r in find_leaks(docs, items).selectExpr("row.doc_id", "transform(hits, h -> h.item) AS items").collect()}
    assert found == {i: [] if i % 31 == 30 else [str(i % 31)] for i in range(3000)}
