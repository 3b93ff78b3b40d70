"""Word helpers and the mix."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortloom.llm.mixing import mix, plan_mix
from cohortloom.llm.text import span_hashes, utf8, word_count, word_spans
from cases import no_docs, odd_docs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_word_spans_follow_the_pattern():
    texts = ["a b", None, "", " x\ty\u000bz ", "é 😀", "tail", "head "]
    data, offsets = utf8(pa.array(texts))
    starts, ends, count = word_spans(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert found == [w for t in texts for w in WORDS.findall(t or "")]
    assert count.tolist() == [len(WORDS.findall(t or "")) for t in texts]
    hashes = span_hashes(data, starts, ends)
    assert len(np.unique(hashes)) == len(set(found))


def water_filled(sizes: dict, weights=(5, 2, 1), budget=1.5, most=2.0) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = budget * sum(sizes.values()), {}
    while True:
        rest = {s: w for s, w in weight.items() if s not in capped}
        share = (total - sum(capped.values())) / sum(rest.values()) if rest else 0
        over = [s for s in rest if rest[s] * share > most * sizes[s]]
        if not over:
            return {**capped, **{s: rest[s] * share for s in rest}}
        capped.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 3, "c": 0, None: 50}, {"a": 0}, {"z": 7, "é": 90, "B": 2, "c": 30, "d": 1}])
def test_targets_are_shared_with_limits(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    found = plan_mix(spark.createDataFrame(rows, "doc_id long, source string, n long"), F.col("n")).collect()
    want = water_filled(sizes)
    for r in found:
        assert r["target"] == pytest.approx(want[r["row"]["source"]])
        assert 0 <= r["copies"] <= 2


def test_the_mix_comes_near_its_targets_and_agrees_with_itself(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.when(F.col("id") < 3000, 0).otherwise(F.col("id") % 4)).alias("source"), F.lit(10).alias("n"))
    planned = plan_mix(docs, F.col("n"))
    taken = planned.groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in taken)
    assert sorted(mix(docs, F.col("n")).collect()) == sorted(mix(docs, F.col("n")).collect())


def test_odd_rows_and_names(spark):
    docs = odd_docs(spark)
    out = mix(docs, word_count(F.col("text")))
    assert out.columns == docs.columns
    assert all(n <= 2 * 2 for n in [r["count"] for r in out.groupBy("doc_id", "text").count().collect()])
    assert mix(no_docs(spark), word_count(F.col("text"))).count() == 0
