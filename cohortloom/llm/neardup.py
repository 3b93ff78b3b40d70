"""Near-duplicate documents by bottom-k sketches, inverted lists and exact Jaccard similarity.

One hash function orders all word shingles; a document's sketch is the ``k`` smallest hashes of its
shingle set. Two sets of similarity 0.75 share, of the k smallest hashes of their union, about three
in four, and each of those is in both sketches. So the retained values are inverted, documents meet
in the lists of their rarest values, the sketch of the union estimates their similarity, and what
passes is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.components import components, joined
from cohortloom.llm.text import LOWER, mixed, own, span_hashes, stored, utf8, word_spans

SHINGLE = 5
K = 32
#: Similarity as a fraction of whole numbers: 100 * shared >= PERCENT * all.
PERCENT = 75
#: Two sketches of k = 32 hold at least so many common values, at similarity 0.75, but once in 239 million pairs
#: (of 32 draws that are common with probability 0.75, fewer than 9 are).
COMMON = 9
#: The union's sketch must hold so many common values of k = 32, which fails as rarely.
ESTIMATE = 9
#: Texts whose words a task holds at a time, some 40 bytes for each of theirs.
ROWS = 512
#: Most ids that are broadcast to pick the texts of candidates; beyond, ids and texts meet in a shuffle.
BROADCAST_IDS = 500_000


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and where each begins.

    Words are lower-cased (A-Z); fewer than ``width`` words make one shingle, none make none.
    """
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, count = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    first = np.concatenate([[0], np.cumsum(count)])
    grams = np.maximum(count - width + 1, np.minimum(count, 1))
    row = np.repeat(np.arange(len(count)), grams)
    begin = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    value = np.zeros(len(row), np.uint64)
    for i in range(width):
        inside = begin + i < first[1:][row]
        word = words[np.minimum(begin + i, len(words) - 1)] if len(words) else words
        value = np.where(inside, mixed(value * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(i + 1)), value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[new], value[new]
    return value, np.searchsorted(row, np.arange(len(count) + 1))


def sketches(docs: DataFrame, id_column: str, text: str, k: int = K) -> DataFrame:
    """``id, n, sign, sketch``: set size, a signature of the whole set, and its k smallest hashes; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                value, at = shingle_sets(batch["text"])
                size = np.diff(at)
                signs = []
                for salt in (0x51, 0xA7):
                    sums = np.concatenate([[0], np.cumsum(mixed(value + np.uint64(salt)))]).astype(np.uint64)
                    signs.append(mixed(sums[at[1:]] - sums[at[:-1]] + np.uint64(salt)).view(np.int64))
                kept = np.minimum(size, k)
                ends = np.concatenate([[0], np.cumsum(kept)])
                pick = np.repeat(at[:-1], kept) + np.arange(ends[-1]) - np.repeat(ends[:-1], kept)
                sketch = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(value[pick].view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["id"], pa.array(size), pa.array(signs[0]), pa.array(signs[1]), sketch], ["id", "n", "sign", "sign2", "sketch"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, n long, sign long, sign2 long, sketch array<long>")


def full_sets(docs: DataFrame) -> DataFrame:
    """``id, shingles``: the whole set of hashes of the rows ``id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                value, at = shingle_sets(batch["text"])
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(value.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["id"], lists], ["id", "shingles"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, shingles array<long>")


def _needed(n: Column) -> Column:
    """Common sketch values that a similar pair has at least: of a whole small set exactly, of a full sketch all but surely."""
    return F.least(F.ceil(n * PERCENT / 100.0), F.lit(COMMON)).cast("int")


def listings(sketched: DataFrame) -> DataFrame:
    """``value, id, weight``: the inverted lists in which every similar pair meets.

    With at least c common values, a pair still meets when each document leaves out its c - 1 most
    frequent ones. So values of frequent passages stand at the end of each sketch and are left out,
    and values that one document alone holds need no list. No list is cut. ``weight`` is the share of
    the document's values that others hold, too.
    """
    held = sketched.select("id", F.size("sketch").alias("n"), _needed(F.col("n")).alias("needed"), F.explode("sketch").alias("value"))
    return _rarest(held)


def _rarest(held: DataFrame) -> DataFrame:
    """Of each id's n values, all but the ``needed`` - 1 that the most ids hold, and those that no other holds.

    ``place`` counts an id's values that others hold, from the one that the most hold: from a value on,
    the id has so many left that it can share.
    """
    often = held.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    own_values = Window.partitionBy("id")
    from_most = own_values.orderBy(F.col("often").desc(), F.col("value").desc())
    placed = held.join(often, "value").select(
        "value", "id", "n", "needed", F.row_number().over(from_most).alias("place"), (F.count("*").over(own_values) / F.col("n")).alias("weight")
    )
    return placed.where("place >= needed").select("value", "id", "weight", "n", "place")


def _estimated(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose union's sketch does not rule out the similarity; small sets are compared whole."""
    slim = sketched.select("id", "n", "sketch")
    met = pairs.join(slim.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
    met = met.join(slim.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    # of the common values, those among the k smallest of the union; the order is that of unsigned numbers, as in the sketch
    flip = F.lit(-(2**63))
    common = F.array_intersect("s_a", "s_b")
    union = F.array_sort(F.transform(F.array_union("s_a", "s_b"), lambda x: x.bitwiseXOR(flip)))
    whole = (F.col("n_a") <= K) & (F.col("n_b") <= K)
    limit = F.get(union, F.least(F.size(union), F.lit(K)) - 1)
    in_union = F.size(F.filter(common, lambda x: x.bitwiseXOR(flip) <= limit))
    passes = F.when(whole, F.size(common) * 100 >= F.size(F.array_union("s_a", "s_b")) * PERCENT).otherwise(in_union >= ESTIMATE)
    return met.where(fits).where(passes).select("a", "b")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar: ``docs`` has ``id, text``."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    sets = stored(full_sets(_texts_of(ids, docs)).dropDuplicates(["id"]), "shingle-sets")
    met = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    met = met.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return met.where(shared * 100 >= (F.size("x") + F.size("y") - shared) * PERCENT).select("a", "b")


def _texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows ``id, text`` of these ids, picked in the scan where the ids are few."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _stars(lists: DataFrame) -> DataFrame:
    """Pairs ``a, b``: every member of a list with its hub, the member with the least that it holds alone.

    In a group of copies with edits that is the text they were edited from, or the one nearest to it.
    """
    hubs = lists.groupBy("value").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"))).alias("hub"))
    paired = lists.join(hubs.select("value", (-F.col("hub.id")).alias("hub")), "value").where("hub <> id")
    return paired.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()


def _placed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The members of lists that more than one component meets in, each with its component ``c``."""
    known = lists.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("c", F.coalesce("component", "id")).drop("component")
    known = stored(known, "placed-lists")
    several = known.groupBy("value").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("value")
    return known.join(several, "value", "left_semi")


def _can_share(place_a: str, place_b: str) -> Column:
    """Whether two sets can share enough from the value on in which they meet.

    If it is the rarest value they share, all they share is from there on, and similar sets share 3/7 of the sum
    of their sizes. A pair that shares a rarer value has met there.
    """
    all_of, needed = 100 + PERCENT, PERCENT
    return F.least(place_a, place_b) * all_of >= (F.col("n_a") + F.col("n_b")) * needed


def _across(open_lists: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of different components that meet in a list over whole sets and can be similar."""
    left, right = (open_lists.select("value", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "c", "n", "place")]) for side in "ab")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    met = left.join(right, (left["value"] == right["value"]) & (F.col("c_a") < F.col("c_b")) & fits & _can_share("place_a", "place_b"))
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def _around_second_hubs(open_lists: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a list's members with its best member outside the component of the best of all, where they can be similar."""
    best = F.max(F.struct("weight", (-F.col("id")).alias("id"), "c", "n", "place"))
    first = open_lists.groupBy("value").agg(best.alias("first")).select("value", F.col("first.c").alias("first_c"))
    others = open_lists.join(first, "value").where("c <> first_c")
    hubs = others.groupBy("value").agg(best.alias("hub"))
    hubs = hubs.select("value", (-F.col("hub.id")).alias("hub"), F.col("hub.c").alias("c_b"), F.col("hub.n").alias("n_b"), F.col("hub.place").alias("place_b"))
    met = others.withColumnRenamed("n", "n_a").join(hubs, "value").where("c <> c_b")
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return met.where(fits & _can_share("place", "place_b")).select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()


def similar_components(sketched: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, component`` of what similar pairs connect; what is similar to nothing has no row.

    First every list of the sketches compares its members with its hub only. Members that this connects need no
    further comparison. Those of lists that still hold more than one component are listed again by
    their whole sets: all but the ceil(0.75 n) - 1 most frequent of the hashes that another holds, in which
    every similar pair meets. There a second hub, outside the first one's component, is compared; what is left are
    pairs of different components, and only those are compared that have enough left to share from where they
    meet and whose sizes allow it. These bounds are exact. In a group of edited copies they rule out nearly all pairs
    that the hubs do not connect.
    """
    lists = stored(listings(sketched), "sketch-lists")
    tried = stored(_estimated(_stars(lists), sketched), "pairs")
    found = stored(components(stored(_confirmed(tried, docs), "near-links")), "components")
    ids = stored(_placed(lists, found).select("id").distinct(), "open-ids")
    sets = stored(full_sets(_texts_of(ids, docs)).dropDuplicates(["id"]), "open-sets")
    size = F.size("shingles")
    exact = stored(_rarest(sets.select("id", size.alias("n"), F.ceil(size * PERCENT / 100.0).cast("int").alias("needed"), F.explode("shingles").alias("value"))), "lists")
    for pairs_of in (_around_second_hubs, _across):
        pairs = stored(pairs_of(_placed(exact, found)).join(tried, ["a", "b"], "left_anti"), "pairs")
        links = stored(_confirmed(pairs, docs), "near-links") if pairs.count() else pairs
        if links.count():
            found = stored(joined(found, links), "components")
        tried = tried.unionByName(pairs)
    return found


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row.

    Documents whose shingle sets have a similarity of 0.75 or more are linked; the component's id is
    its smallest document id, and the document of that id is kept. Documents with the same set are one
    class and only its smallest id is compared. Empty sets are linked with nothing; rows with a null
    id are kept and have a null component. Ids are unique, or rows of an id share its text.
    """
    known = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    sketched = stored(sketches(known, "id", "text"), "sketches")
    some = sketched.where("n > 0 AND id IS NOT NULL")
    classes = some.groupBy("n", "sign", "sign2").agg(F.min("id").alias("class"))
    member = stored(some.select("id", "n", "sign", "sign2").join(classes, ["n", "sign", "sign2"]).select("id", "class"), "classes")
    heads = stored(sketched.join(member.where("id = class").select("id"), "id", "left_semi").dropDuplicates(["id"]).select("id", "n", "sketch"), "class-sketches")
    found = similar_components(heads, known.where("id IS NOT NULL"))
    lead = member.join(found.withColumnRenamed("node", "class"), "class", "left").groupBy("id").agg(F.min(F.coalesce("component", "class")).alias("component"))
    mark = own("id")
    out = sketched.select("id", "n").join(lead.withColumnRenamed("id", mark), F.col("id") == F.col(mark), "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that near-duplicate search keeps: one of each component, with all columns.

    Of rows that share an id one stays; rows with a null id, which name no document, all stay.
    """
    known = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = near_duplicates(known, "id")
    gone = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct(), "duplicates")
    again = stored(known.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "repeated-ids")
    row, key = own("row"), own("id")
    given = docs.select(F.struct("*").alias(row), F.col(id_column).alias(key))
    few = gone.count() <= BROADCAST_IDS
    ids = gone.withColumnRenamed("id", key)
    left = given.join(F.broadcast(ids) if few else ids, key, "left_anti")
    if again.isEmpty():
        return left.select(f"{row}.*")
    twice = again.withColumnRenamed("id", key)
    once = left.join(twice, key, "left_anti").unionByName(left.join(twice, key, "left_semi").dropDuplicates([key]).select(key, row))
    return once.select(f"{row}.*")
