"""Query 4: personal data of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.privacy import KINDS, TERM, find_personal
from cohortloom.llm.registry import query, table


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, TERM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op4_privacy")
def op4_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["stop"].alias("stop")))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["stop"].alias("stop")))
    return found.select(
        "doc_id", *[_count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_listed(plain), 256).alias("base_sha256"), _listed(F.array_sort(F.concat(plain, terms))).alias("spans"), F.size("terms").alias("n_term"),
    )


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda b: b["kind"] == kind)).cast("long")
