"""Winnowing fingerprints: the smallest hash of each window of word k-grams, with its position.

Only SQL functions run here. A text is cut into words, each run of ``k`` words is hashed, and of any
``window`` consecutive hashes the smallest is kept, the rightmost of equal ones. Two texts that share
a run of at least ``k + window - 1`` words share a kept hash, and its positions tell where.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.text import own, word_list

K = 3
WINDOW = 8
#: The low bits of an order code hold the position, counted down so that the rightmost of ties is least.
PLACE_BITS = 27
_PLACES = 2**PLACE_BITS - 1


def add_fingerprint(df: DataFrame, text: str, kept: str, places: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add the kept hashes of a text column and their positions (number of the first word), in text order.

    With fewer than ``k`` words the whole sequence is one gram; a text without words, null included,
    has none. With fewer hashes than a window holds, the smallest of all is kept. Hashes are compared
    by their upper bits, so that order and position fit one number. Every step is a column of its
    own: the next one reads it many times.
    """
    words, codes, grams, order = own("words"), own("codes"), own("grams"), own("order")
    ends = F.size(words) - F.lit(k - 1)
    df = df.withColumn(words, word_list(F.col(text)))
    df = df.withColumn(codes, F.transform(words, lambda w: F.xxhash64(w)))
    rolled = F.transform(F.slice(codes, 1, F.greatest(ends, F.lit(0))), lambda first, i: F.xxhash64(first, *[F.get(codes, i + j) for j in range(1, k)]))
    few = F.array(F.xxhash64(F.array_join(F.transform(codes, lambda c: c.cast("string")), " ")))
    df = df.withColumn(grams, F.when(ends >= 1, rolled).when(F.size(codes) > 0, few).otherwise(F.array().cast("array<bigint>")))
    place = F.lit(_PLACES)
    df = df.withColumn(order, F.transform(grams, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 64 - 36), PLACE_BITS).bitwiseOR(place - i)))
    # the smallest of 2, 4, ... codes from each place on, and at last of a whole window
    width = 1
    while width < window:
        step = min(width, window - width)
        wider = own("order")
        df = df.withColumn(wider, _least_with(order, step))
        order, width = wider, width + step
    windows = F.greatest(F.size(order) - F.lit(window - 1), F.least(F.size(order), F.lit(1)))
    df = df.withColumn(places, F.transform(F.array_distinct(F.slice(order, 1, windows)), lambda x: (place - x.bitwiseAND(_PLACES)).cast("int")))
    df = df.withColumn(kept, F.transform(places, lambda p: F.get(grams, p)))
    return df.drop(words, codes, grams, *[c for c in df.columns if c.startswith("order_")])


def _least_with(order: str, step: int) -> Column:
    """Each element, or the one ``step`` places later where that is smaller."""
    return F.transform(order, lambda x, i: F.least(x, F.get(order, i + step)))


def written(kept: Column, places: Column) -> Column:
    """A fingerprint as text: each hash in hexadecimal, ``@`` and its position; comma-joined."""
    return F.array_join(F.zip_with(kept, places, lambda h, p: F.concat(F.lower(F.hex(h)), F.lit("@"), p.cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two fingerprints; 1 for two empty ones."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def next_blocks(docs: DataFrame, id_column: str, text: str, per_block: int = 500, most_blocks: int = 50_000) -> DataFrame:
    """``doc_id``, ``text``, and the ``block`` of each row, with a copy of each block's first row as ``guest`` at the end of the block before.

    Blocks are ranges of ids (numbers) of about ``per_block`` rows, the greatest ids first; the first
    row of all is the guest of the last block. So the successor of every row stands in its own block,
    after one exchange and without a task that sees all rows. Only the limits of the blocks, at most
    ``most_blocks``, and the greatest id of each reach the driver. Null texts are empty ones; null ids
    come last.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = min(most_blocks, max(1, -(-plain.select("doc_id").count() // per_block)))
    found = plain.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0] if n > 1 else None
    limits = sorted({float(x) for x in found or []})
    splits = [float("-inf"), *limits, float("inf")] if limits else [float("-inf"), 0.0, float("inf")]
    number = own("number")
    located = plain.withColumn(number, F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    dealt = Bucketizer(splits=splits, inputCol=number, outputCol="block").transform(located).drop(number)
    dealt = dealt.withColumn("block", F.col("block").cast("int"))
    heads = sorted(dealt.groupBy("block").agg(F.max("doc_id").alias("head")).collect(), key=lambda r: -r["block"])
    hosts = [(r["head"], heads[i - 1]["block"]) for i, r in enumerate(heads)]
    # one row per block, at most most_blocks
    visits = spark.createDataFrame(hosts, f"head {docs.schema[id_column].dataType.simpleString()}, host int")
    met = dealt.join(F.broadcast(visits), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    own_place = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    visit = F.struct(F.col("host").alias("block"), F.lit(True).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(own_place)).otherwise(F.array(own_place, visit))
    return met.select("doc_id", "text", F.explode(places).alias("at")).select("doc_id", "text", "at.block", "at.guest")


def fingerprint_with_next(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, and of its edited form, and their likeness.

    The next document is the one before by id (after the smallest id comes the greatest); rows of equal
    ids follow by text. The edited text has the last half of its code points, rounded down, replaced by
    as many from the start of the next document, or all it has. Null texts are empty ones. A single row
    is its own next. Returns ``doc_id, n_chars, edited, kept, places, edited_kept, edited_places, near_edited, near_next``.
    """
    dealt = next_blocks(docs, id_column, text).repartition("block")
    marked = add_fingerprint(dealt, "text", "kept", "places")
    following = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    paired = marked.withColumn("next_text", F.lead("text").over(following)).withColumn("next_kept", F.lead("kept").over(following)).where("NOT guest")
    length = F.length("text")
    half = F.floor(length / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - half), F.substring(F.col("next_text"), F.lit(1), half))
    paired = paired.withColumn("n_chars", length.cast("long")).withColumn("edited", edited)
    both = add_fingerprint(paired, "edited", "edited_kept", "edited_places")
    return both.select(
        "doc_id", "n_chars", "edited", "kept", "places", "edited_kept", "edited_places",
        likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"), likeness(F.col("kept"), F.col("next_kept")).alias("near_next"),
    )
