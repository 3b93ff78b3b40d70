"""Collocations against plain Python, and the streams read in lockstep."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import collocations as module
from cohortloom.llm.collocations import collocations, frequent_phrases
from cases import no_docs, odd_docs

ROWS = "doc_id long, text string, lang string, rank long, words string"


def grams(docs):
    counts, total = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    return counts, total


def brute(docs, least, most):
    counts, total = grams(docs)
    phrases = {g: a for g, a in counts.items() if len(g[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, w), a in phrases.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    inside[lang, w[i:j]] = max(inside[lang, w[i:j]], a)
    out = {}
    for (lang, w), a in phrases.items():
        if 100 * inside[lang, w] >= 100 * a:
            continue
        cuts = [(1000 * a * total[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(rows)


def made_docs(seed, n=60):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "New", "York", "a", "naïve", "日本", "x\x01", "x", "x!", "bank", "river", "on", "on\xa0top"]
    stock = "new york stock exchange opened the day"
    docs = []
    for _ in range(n):
        parts = [" ".join(rnd.choices(words, k=rnd.randint(0, 12))) if rnd.random() < 0.6 else stock for _ in range(rnd.randint(0, 9))]
        docs.append((rnd.choice([" ", ". ", "\n", "\t", " ; "]).join(parts), rnd.choice(["en", "en", "de", None, "und"])))
    return docs + [(None, "en"), ("", "en"), ("  \t ", "de"), ("...", None), docs[0], docs[0]]


def mined(spark, docs, least, most=2000):
    frame = spark.createDataFrame([(i, t, lang, 5, "w") for i, (t, lang) in enumerate(docs)], ROWS).repartition(5)
    found = collocations(frame, least, most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("change", [{}, {"BLOCK": 40, "MOST_HELD": 5}, {"MOST_KNOWN": 0}, {"MOST_KNOWN": 25, "BLOCK": 40}])
def test_equals_brute_force_however_much_is_known(spark, monkeypatch, change):
    docs = made_docs(7)
    known, held = change.get("MOST_KNOWN"), change.get("MOST_HELD")
    for name, value in change.items():
        monkeypatch.setattr(module, name, value)
    assert (known, held) == (change.get("MOST_KNOWN"), change.get("MOST_HELD"))
    assert mined(spark, docs, 4) == brute(docs, 4, 2000)


def test_best_phrases_only(spark):
    docs = made_docs(8, 40)
    assert mined(spark, docs, 2, 6) == brute(docs, 2, 6)


def test_all_counts(spark):
    docs = made_docs(9)
    counts, total = grams(docs)
    frame = spark.createDataFrame([(i, t, lang, 5, "w") for i, (t, lang) in enumerate(docs)], ROWS)
    phrases, totals = frequent_phrases(frame, 3)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == {g: f for g, f in counts.items() if f >= 3}
    assert {r.lang: r.n for r in totals.collect()} == {lang: n for lang, n in total.items() if n}


def test_lockstep_over_many_ranges(spark):
    """However the sorted stream is cut, each phrase meets the counts of all that it begins with."""
    words = ["a", "a b", "a b c", "a b c d", "a b d", "a b\x01", "a\x01 b", "a\x01", "b", "b a", "b a a"]
    frame = spark.createDataFrame([(lang, w, len(w.split(" ")), 10 + i) for lang in ("x", "y") for i, w in enumerate(words)], "lang string, phrase string, m int, f long")
    f = {w: 10 + i for i, w in enumerate(words)}
    frame = frame.where("phrase != 'a b\x01'")
    for tasks in ("1", "3", "9", "20"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            rows = module._stream(frame, F.split("phrase", " "), "test").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert len(rows) == 20
        for r in rows:
            assert r.parts == [f[" ".join(r.words[:k])] for k in range(1, len(r.words))], (tasks, r)


def test_very_large_counts_stay_exact(spark, monkeypatch):
    big = 10**12 + 7
    phrases = spark.createDataFrame([("en", "a", 1, big + 5), ("en", "b", 1, big + 11), ("en", "a b", 2, big)], "lang string, phrase string, m int, f long")
    totals = spark.createDataFrame([("en", 10**15 + 3)], "lang string, n long")
    monkeypatch.setattr(module, "frequent_phrases", lambda *a: (phrases, totals))
    row = collocations(no_docs(spark)).first()
    assert row.score == 1000 * big * (10**15 + 3) // ((big + 5) * (big + 11))


def test_odd_and_no_rows(spark):
    docs = [(r.text, r.lang) for r in odd_docs(spark).collect()]
    assert sorted(map(tuple, collocations(odd_docs(spark), 5, 50).collect())) == brute(docs, 5, 50)
    assert collocations(no_docs(spark)).count() == 0
