"""Frames that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"
#: Columns named like the operators' own results.
ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, size long, kept boolean, spans string, hits string, copies int"


def odd_rows() -> list[tuple]:
    long = " ".join(f"word{i % 700}" for i in range(20_000))
    texts = [None, "", "   \n\t", "a", "x" * 30_000, long, long, "the quick brown fox jumps over the lazy dog", "the quick brown fox jumps over the lazy dog",
             "mail bob@example.com or +1 555 123 4567", "naïve café 😀 texts", "\u0001\u0002", "!!! ??? 123"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 2}", len(t or ""), "r", 0.5, 7, True, "s", "h", 2) for i, t in enumerate(texts)]
    return [*rows, rows[7], (None, "the end", "en", "s1", 7, None, None, None, None, None, None, None)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), ODD)


def no_docs(spark):
    return spark.createDataFrame([], ODD)
