"""Personal data against the plain patterns, and the disclosure of terms against its definition."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from cohortloom.llm.privacy import KINDS, Disclosure, find_base, find_personal, sanitise
from cohortloom.llm.queries_privacy import op4_privacy
from cases import FOLDER, no_docs, odd_docs

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or (kind == 1 and all(int(x) <= 255 for x in m[0].split("."))) or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                    or (kind == 3 and 9 <= len(digits) <= 15)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


HARD = [
    "a@b.co-_x@y.z a@b..c x@y.z.", "a@b.c@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 000.0.0.0255", "4111 1111-1111 1111 4111-1111  1111 1111",
    "+1 (555) 123-4567) +12 +1234567890123456", "é@b.c 😀 a.b+c@d-e.f-g.h 4111111111111111😀", "1" * 50_000, "1 2 " * 6000, "a@b" + ".c" * 9000,
    "\u0001a@b.cd\u0004", None, "", "+" * 3000 + "1", "a." * 20_000 + "@", "%@-.-", "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6-7 8 9",
    "12 34+56 78 90 12 34 56", "10.1.1.1.1@x.y", "1.1.1.1\n2.2.2.2", "a@b.c " * 2000, "0.0.0.0" * 40,
]


def test_patterns_in_hard_texts(spark):
    rows = find_base(spark.createDataFrame(list(enumerate(HARD)), "i int, text string"), "text", "found").collect()
    for r in rows:
        assert [(s["start"], s["kind"], s["stop"]) for s in r["found"]] == plain(r["text"]), r["i"]


def test_whole_table(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = op4_privacy(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = plain(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[1] == i for x in want) for i in range(4)]


def corpus():
    rows = [f"text {i} about weather and many usual words of number{i}" for i in range(40)]
    rows += [f"the agent zorblax wrote from zorblax@spy.example today usual {i}" for i in range(5)]
    rows += ["zorblax alone without any address", "once hapax at one@time.example"]
    return list(enumerate(rows))


def test_terms_follow_the_definition(spark):
    rows, rule = corpus(), Disclosure(generalise_at=0.5)
    found = {r["doc_id"]: r for r in find_personal(spark.createDataFrame(rows, "doc_id long, text string"), rule).collect()}
    assert not any(found[i]["terms"] for i in range(40)) and not found[45]["terms"] and not found[46]["terms"]
    n, with_entity = len(rows), 5
    for i in range(40, 45):
        text = rows[i][1]
        got = {text[t["start"] : t["stop"]]: t["disclosure"] for t in found[i]["terms"]}
        want = {}
        for word in set(re.findall(r"[^\W\d_]{3,}", text.replace("zorblax@spy.example", "| |"))):
            with_term = sum(word in re.findall(r"[^\W\d_]{3,}", t.lower()) for _, t in rows)
            score = min(1.0, math.log(5 * n / (with_term * with_entity)) / -math.log(with_entity / n))
            if score >= 0.5:
                want[word] = score
        assert got == pytest.approx(want)


def test_sanitised_texts(spark):
    docs = spark.createDataFrame([(*r, "x") for r in corpus()], "doc_id long, text string, row string")
    out = sanitise(docs)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == docs.columns
    assert all(texts[i] == t for i, t in corpus() if "@" not in t)
    assert texts[46] == "once hapax at <EMAIL>"
    assert "zorblax" not in texts[40] and "<EMAIL>" in texts[40]


def test_values_of_one_text_back_off_to_their_kind(spark):
    rows = [(i, f"plain text {i} of usual words") for i in range(200)]
    rows += [(i, f"usual mailbox u{i}@h{i}.example" + " filler" * 30 + " Mailbox again") for i in range(200, 220)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in find_personal(docs).collect()}
    for i, text in rows:
        marked = [text[t["start"] : t["stop"]] for t in found[i]["terms"]]
        assert [w for w in marked if w.lower() == "mailbox"] == (["mailbox", "Mailbox"] if i >= 200 else []) and "usual" not in marked
    score = math.log((20 + 3 * 20 / 220) / 23 * 220 / 20) / math.log(220 / 20)
    assert found[200]["terms"][0]["disclosure"] == pytest.approx(score, rel=1e-3)  # the number of texts is approximate


def test_terms_are_marked_far_from_their_entity(spark):
    far = " filler" * 40
    rows = corpus() + [(50 + i, f"agent zorblax wrote from zorblax@spy.example{far} Zorblax{far}") for i in range(3)]
    rows.append((60, f"other@mail.example{far} zorblax"))
    found = find_personal(spark.createDataFrame(rows, "doc_id long, text string"), Disclosure(generalise_at=0.7)).collect()
    marked = {r["doc_id"]: [rows_text[t["start"] : t["stop"]] for t in r["terms"]] for r in found for rows_text in [dict(rows)[r["doc_id"]]]}
    assert all({"zorblax", "Zorblax"} <= set(marked[50 + i]) for i in range(3)) and "zorblax" in marked[60]


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("text LIKE '%bob@%'").isEmpty() and out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert find_personal(docs).count() == docs.count()
    assert sanitise(no_docs(spark)).count() == 0 and find_personal(no_docs(spark)).count() == 0
