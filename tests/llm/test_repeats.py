"""Removal of repeated passages against all windows of all texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cohortloom.llm.queries_repeats import op2_repeats
from cohortloom.llm.repeats import COVER, PERIOD, _merged, _sample, remove_repeats
from cases import FOLDER, no_docs, odd_docs


def brute(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[k : k + length] for b in texts for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def left_of(row):
    """What stands outside the removed runs of a row (text, spans)."""
    data, spans = (row[0] or "").encode(), row[1]
    return b"".join(data[a:b] for a, b in zip([0, *spans[1::2]], [*spans[::2], len(data)], strict=True))


def found(frame):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in frame.collect()), key=str)


def test_the_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_sample_and_merge():
    places, counts = _sample(np.array([0, 217, 218, 1000]), 218)
    assert counts.tolist() == [0, 0, 1, sum(p % PERIOD in COVER for p in range(1000 - 218 + 1))]
    assert [x.tolist() for x in _merged(np.array([0, 3, 10]), np.array([5, 10, 12]))] == [[0], [12]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_shifted_copies_overlaps_and_borders(spark, seed):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))

    passage = noise(900)
    rows = []
    for i in range(30):
        start, size = rng.randrange(0, 300), rng.choice([380, 399, 400, 401, 500, 600])
        rows.append((i, noise(rng.randrange(0, 700)) + passage[start : start + size] + noise(rng.randrange(0, 700))))
    rows += [(40, "ab" * 600), (41, "ab" * 199), (42, None), (43, ""), (44, rows[3][1]), (45, rows[3][1]), (46, rows[3][1][50:]), (47, noise(400)), (45, rows[3][1]), (None, rows[5][1])]
    assert found(remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert found(remove_repeats(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    assert found(remove_repeats(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert remove_repeats(no_docs(spark)).count() == 0


@pytest.mark.parametrize("few", [0, 500_000])
def test_kept_bytes_of_planted_passages(spark, monkeypatch, few):
    """What is left comes back itself: planted passages of over 50 words go, clean and short texts stay, copies leave nothing."""
    monkeypatch.setattr("cohortloom.llm.repeats.BROADCAST_KEYS", few)
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(6, 9))) for _ in range(n))

    heads, passages = [words(40) for _ in range(12)], [words(60) for _ in range(6)]
    rows = [(i, f"{heads[i]}\u00e9{passages[i // 2]}") for i in range(12)]
    rows += [(20, words(80)), (21, "short"), (22, "short"), (23, None), (24, words(90)), (None, words(70))]
    rows += [(30, words(75))] * 2
    frame = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found(frame) == brute(rows)
    text, got = dict(rows), frame.collect()
    for r in got:
        assert bytes(r["kept"]) == left_of((text[r["doc_id"]], r["spans"]))
        assert hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in got}
    assert [kept[i] for i in range(12)] == heads
    assert {i: kept[i] for i in (20, 21, 22, 23, 24, None)} == {i: text[i] or "" for i in (20, 21, 22, 23, 24, None)}
    assert kept[30] == ""


def test_query_returns_the_text_that_is_left(spark, tmp_path):
    """Bytes of a cut character are marked in ``text``; the digest is of the bytes."""
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(450))
    # \u00e9 and \u0129 end in the same byte, so the passage reaches into both
    rows = [(1, "one \u00e9" + passage), (2, "two \u0129" + passage + " end"), (3, "clean \u00e9"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in op2_repeats(spark, str(tmp_path)).collect()}
    assert {i: r["text"] for i, r in got.items()} == {1: "one \ufffd", 2: "two \ufffd end", 3: "clean \u00e9", 4: ""}
    assert got[1]["kept_sha256"] == hashlib.sha256(b"one \xc3").hexdigest() and got[1]["n_removed"] == 451
