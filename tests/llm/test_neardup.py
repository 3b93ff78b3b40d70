"""Near-duplicates, components and sets against brute force."""

import random
import re

import pyarrow as pa
import pytest

from check_oracles import connect, differences
from cohortloom.llm.components import components, joined
from cohortloom.llm.neardup import keep_one, near_duplicates, shingle_sets
from cohortloom.llm.registry import ORACLES
from cases import FOLDER, no_docs, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed):
    rng = random.Random(seed)
    passage = [f"common{i}" for i in range(40)]
    rows = []
    for group in range(12):
        words = [f"g{group}w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 30, 120, 400]))]
        if group % 2:
            words[1:1] = passage
        for _ in range(rng.choice([1, 3, 9])):
            edited = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 12)):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(edited))
    rows += [None, "", "   ", "One Two", "one two", rows[0], rows[0].upper()]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_near_copies(spark, seed):
    rows = near_copies(seed)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_sets_have_the_patterns_shingles():
    texts = ["a b c d e f", "A b  C\td e f", "x", None, "", "a a a a a a a a"]
    values, at = shingle_sets(pa.array(texts))
    sets = [set(values[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)]
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert sets[0] == sets[1]


def test_chains_and_stars_of_links(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(500, 500), (7, 7), (3, 2)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 140)) and 500 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_added_to_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)]
    frame = lambda x: spark.createDataFrame(x, "a long, b long")
    want = {r["node"]: r["component"] for r in components(frame(links)).collect()}
    got = {r["node"]: r["component"] for r in joined(components(frame(links[:30])), frame(links[30:])).collect()}
    assert got == want
    assert joined(components(frame([])), frame([])).count() == 0


def test_whole_table_against_sql(spark):
    sql = ORACLES["op6_near_duplicates"] if "op6_near_duplicates" in ORACLES else None
    from cohortloom.llm import queries_neardup

    sql = sql or queries_neardup.NEAR_SQL
    assert differences(queries_neardup.op6_near_duplicates(spark, FOLDER), connect(FOLDER), sql) == []


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    out = keep_one(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(x for x in kept if x is not None) == [0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 12] and kept.count(None) == 1
    assert keep_one(no_docs(spark)).count() == 0


def test_copies_far_from_the_hub(spark):
    """A large group of copies whose edits take many of them out of the hub's reach, and a second family beside it."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(90)]
    rows = [" ".join(base)]
    for _ in range(400):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            words[rng.randrange(90)] = f"e{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    second = base[:50] + [f"v{i}" for i in range(40)]
    rows += [" ".join([*second[:k], f"x{k}", *second[k + 1 :]]) for k in range(60)]
    rows = list(enumerate(rows))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_pairs_that_only_whole_sets_tell_apart_are_few(spark, monkeypatch):
    """Of a group's members that the hubs do not connect, hardly a pair is compared."""
    from cohortloom.llm import neardup

    rng = random.Random(7)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(500):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(60)] = f"e{rng.randrange(10**6)}"
        rows.append(" ".join(words))
    seen = []
    kept = neardup._across

    def watched(lists):
        pairs = kept(lists)
        seen.append(pairs.count())
        return pairs

    monkeypatch.setattr(neardup, "_across", watched)
    rows = list(enumerate(rows))
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: c for i, (_, c) in want.items()}
    assert seen[0] < 5 * len(rows)
