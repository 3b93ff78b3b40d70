"""Personal data: base patterns, and terms that disclose the protected values by co-occurrence.

Only SQL functions run here. Base spans are e-mail and network addresses, card and phone numbers.
A value that stands in several texts is a protected entity: the words around it are its contexts,
and the corpus tells how much a word discloses it. With p(t) the share of texts that hold the word,
p(e) the share that hold the entity, and p(t, e) the share with the word in a context of the entity,

    disclosure(t; e) = PMI(t; e) / IC(e) = log(p(t, e) / (p(t) p(e))) / -log p(e)

which is 1 where the word always comes with the entity and 0 where it tells nothing. Most values stand
in one text only and have no estimate of their own: they back off to their kind, whose p(e | t) is
smoothed towards p(e). Words from ``generalise_at`` on are generalised to a placeholder, from
``remove_at`` on removed, wherever they stand in a text that holds a base span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import own, stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Most candidate terms that are broadcast to the scan; beyond, the words are joined by a shuffle.
BROADCAST_TERMS = 200_000
#: Most documents with spans whose keys are broadcast to pick their texts from the scan; beyond, all texts are shuffled.
BROADCAST_KEYS = 500_000

_OPEN, _SHUT, _DOT, _GAP, _OTHER = "\u0001", "\u0002", "\u0005", "\u0004", "\u0003"
_LOCAL, _DOMAIN = r"A-Za-z0-9._%+\-", r"A-Za-z0-9\-"
_EDGE = r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})"
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Disclosure:
    """When a context word counts as revealing: its reach in code points, the texts that an estimate for one value needs (for a kind, the weight of its share in the smoothing), and limits of disclosure."""

    reach: int = 80
    support: int = 3
    generalise_at: float = 0.9
    remove_at: float = 1.0


def _running(lengths: Column) -> Column:
    """Running sums of an array, in runs of 256 so that no array is copied too often."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 256).cast("int")), lambda i: F.slice(lengths, i * 256 + 1, 256))

    def sums(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.array(start), lambda seen, x: F.concat(seen, F.array(F.element_at(seen, -1) + x)))

    totals = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda a, x: a + x))
    starts = sums(totals, F.lit(0))
    parts = F.zip_with(runs, F.slice(starts, 1, F.size(totals)), lambda run, start: F.slice(sums(run, start), 2, 256))
    return F.flatten(parts)


def _marked(text: Column, pattern: str) -> Column:
    """The text cut at the pattern's matches: every second piece is a match."""
    return F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{_OPEN}$0{_SHUT}")), f"[{_OPEN}{_SHUT}]")


def _kept(value: Column, kind: int) -> Column:
    """Whether a match passes the kind's test."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return value.rlike(rf"\A{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}\z")
    if kind == 3:
        return F.length(digits).between(9, 15)
    twice = F.transform(
        F.reverse(F.split(digits, "(?!\\A)(?=.)")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2),
    )
    return F.length(digits).between(12, 19) & (F.aggregate(twice, F.lit(0), lambda a, x: a + x) % 10 == 0)


def find_base(df: DataFrame, text: str, spans: str) -> DataFrame:
    """Add the base spans of a text column: array of (start, kind, stop, value) by start, then kind.

    Positions count code points from 0, ends are exclusive. Null has none. The patterns are the usual
    ones in forms that never look back over a run twice: dots between letters of a domain and gaps
    between digits are first made characters of their own, at the same places, so that a run is one
    character class; a run is entered at its first character only.
    """
    pieces, base = own("pieces"), own("plain")
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _OPEN + _SHUT + _GAP + _DOT, _OTHER * 4)
    df = df.withColumn(base, plain)
    dotted = F.regexp_replace(base, rf"(?<=[{_DOMAIN}])\.(?=[{_DOMAIN}])", _DOT)
    email = rf"(?:(?<![{_LOCAL}{_DOT}])|\G)[{_LOCAL}{_DOT}]+@[{_DOMAIN}]+{_DOT}[{_DOMAIN}{_DOT}]+"
    joined = F.regexp_replace(base, "(?<=[0-9])[ \\-](?=[0-9])", _GAP)
    # 12 to 19 digits with a gap between any two are 12 to 37 characters; other runs cannot pass the test
    card = rf"(?<![0-9{_GAP}])[0-9{_GAP}]{{12,37}}(?![0-9{_GAP}])"
    ip = r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
    phone = r"\+[0-9][ ().0-9\-]+[0-9]"
    sources = [
        F.when(F.contains(F.col(base), F.lit("@")), _marked(dotted, email)),
        F.when(F.col(base).rlike(r"[0-9]\.[0-9]+\.[0-9]"), _marked(F.col(base), ip)),
        F.when(F.col(base).rlike("[0-9][0-9 \\-]{10}"), _marked(joined, card)),
        F.when(F.contains(F.col(base), F.lit("+")), _marked(F.col(base), phone)),
    ]
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>")
    found = []
    for kind, source in enumerate(sources):
        name, ends = f"{pieces}_{kind}", f"{pieces}_{kind}_ends"
        df = df.withColumn(name, source)
        df = df.withColumn(ends, F.when(F.size(name) > 1, _running(F.transform(name, F.length))))
        found.append(F.coalesce(F.when(F.size(name) > 1, _matches(name, ends, kind)), none))
    return df.withColumn(spans, F.array_sort(F.concat(*found))).drop(base, *[c for c in df.columns if c.startswith(pieces)])


def _matches(pieces: str, ends: str, kind: int) -> Column:
    found = F.transform(
        F.sequence(F.lit(1), F.size(pieces) - 1, F.lit(2)),
        lambda i: F.struct(F.get(F.col(ends), i - 1).alias("start"), F.lit(kind).alias("kind"), F.get(F.col(ends), i).alias("stop"), F.get(F.col(pieces), i).alias("value")),
    )
    return F.filter(found, lambda m: _kept(m["value"], kind))


def _entity(kind: Column, value: Column) -> Column:
    """The same key for the same address or number however it is written."""
    plain = F.lower(F.translate(value, _DOT, "."))
    return F.xxhash64(kind, F.when(kind >= 2, F.regexp_replace(value, "[^0-9]", "")).otherwise(plain))


def _context_words(context: Column, start: Column, cut_left: Column, cut_right: Column) -> Column:
    """Words of three letters or more in a piece of text that starts at ``start``: (term, start, stop); those cut at an edge left out."""
    pieces = F.split(context, _EDGE)
    placed = F.aggregate(
        pieces,
        F.struct(start.alias("at"), F.array().cast("array<struct<term:string,start:int,stop:int>>").alias("all")),
        lambda s, p: F.struct(
            (s["at"] + F.length(p)).alias("at"),
            F.concat(s["all"], F.array(F.struct(F.lower(p).alias("term"), s["at"].alias("start"), (s["at"] + F.length(p)).alias("stop")))).alias("all"),
        ),
    )["all"]
    end = start + F.length(context)
    return F.filter(placed, lambda w: w["term"].rlike(r"\A\p{L}{3,}\z") & ~(cut_left & (w["start"] == start)) & ~(cut_right & (w["stop"] == end)))


def _contexts(found: DataFrame, reach: int) -> DataFrame:
    """One row for each word in the context of a base span: ``id, text_key, kind, entity, term, start, stop``."""
    one = found.select("id", "text", "text_key", "base", F.explode("base").alias("span"))
    left_from = F.greatest(F.col("span.start") - reach, F.lit(0))
    left = F.substring(F.col("text"), left_from + 1, F.col("span.start") - left_from)
    right = F.substring(F.col("text"), F.col("span.stop") + 1, F.lit(reach))
    near = one.select(
        "id", "text_key", "base", F.col("span.kind").alias("kind"), _entity(F.col("span.kind"), F.col("span.value")).alias("entity"), left.alias("left"), left_from.alias("left_from"),
        right.alias("right"), F.col("span.stop").alias("right_from"),
    )
    words = F.concat(
        _context_words(F.col("left"), F.col("left_from"), F.col("left_from") > 0, F.lit(False)),
        _context_words(F.col("right"), F.col("right_from"), F.lit(False), F.length("right") == reach),
    )
    outside = F.filter(words, lambda w: ~F.exists("base", lambda b: (b["start"] < w["stop"]) & (w["start"] < b["stop"])))
    return near.select("id", "text_key", "kind", "entity", F.explode(outside).alias("w")).select("id", "text_key", "kind", "entity", "w.term", "w.start", "w.stop")


def _occurrences(found: DataFrame, terms: DataFrame) -> DataFrame:
    """``id, text_key, start, stop, disclosure`` of the given terms wherever they stand outside the base spans."""
    pieces = found.withColumn("pieces", F.split("text", _EDGE)).withColumn("ends", _running(F.transform("pieces", F.length)))
    words = F.zip_with("pieces", "ends", lambda p, end: F.struct(F.lower(p).alias("term"), (end - F.length(p)).alias("start"), end.alias("stop")))
    words = F.filter(words, lambda w: w["term"].rlike(r"\A\p{L}{3,}\z"))
    met = pieces.select("id", "text_key", "base", F.explode(words).alias("w")).select("id", "text_key", "base", "w.*").join(terms, "term")
    return met.where(~F.exists("base", lambda b: (b["start"] < F.col("stop")) & (F.col("start") < b["stop"]))).select("id", "text_key", "start", "stop", "disclosure")


def revealing_terms(docs: DataFrame, holding: DataFrame, contexts: DataFrame, rule: Disclosure, text: str = "text") -> DataFrame:
    """``term, disclosure`` of every context word at or above the lower limit, for the value or kind that it reveals most.

    Equal texts count once. A value has an estimate for the words that stand around it in
    ``rule.support`` texts or more; a kind has one for every word, smoothed by ``rule.support`` texts
    that hold the kind as often as all do. The words of all texts are counted, but only candidate terms
    leave the scan: those that would reach the limit if they stood in no text without base spans.
    """
    texts = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    total = float(max(texts.agg(F.approx_count_distinct("text_key", 0.01)).first()[0], 1))
    values = contexts.groupBy("entity", "term").agg(F.count_distinct("text_key").alias("together")).where(F.col("together") >= rule.support)
    entities = contexts.select("entity", "text_key").distinct().groupBy("entity").agg(F.count("*").alias("with_entity"))
    values = values.join(entities, "entity").select("term", "together", "with_entity", F.lit(False).alias("smooth"))
    # four kinds at most
    held = {r["kind"]: r["n"] for r in contexts.select("kind", "text_key").distinct().groupBy("kind").agg(F.count("*").alias("n")).collect()}
    known = F.create_map(*[F.lit(x) for kind, n in held.items() for x in (kind, n)]) if held else F.create_map().cast("map<int,bigint>")
    kinds = contexts.groupBy("kind", "term").agg(F.count_distinct("text_key").alias("together"))
    kinds = kinds.select("term", "together", known[F.col("kind")].alias("with_entity"), F.lit(True).alias("smooth"))
    least = _words(holding).distinct().groupBy("term").agg(F.count("*").alias("least"))
    # a context can cut into a run of letters that the text's words have whole
    pairs = values.unionByName(kinds).join(least, "term", "left").withColumn("least", F.greatest("least", "together"))
    pairs = stored(pairs.where(_disclosure(F.col("least"), rule.support, total) >= rule.generalise_at).drop("least"), "term-pairs")
    terms = pairs.select("term").distinct()
    few = terms.count() <= BROADCAST_TERMS
    met = _words(texts).join(F.broadcast(terms) if few else terms, "term", "left_semi")
    spread = met.distinct().groupBy("term").agg(F.count("*").alias("with_term"))
    scored = pairs.join(spread, "term").select("term", _disclosure(F.col("with_term"), rule.support, total).alias("disclosure"))
    return scored.where(F.col("disclosure") >= rule.generalise_at).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def _words(texts: DataFrame) -> DataFrame:
    """``text_key, term``: the different words of each text."""
    return texts.select("text_key", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{3,}"), F.lit(0)))).alias("term"))


def _disclosure(with_term: Column, support: int, total: float) -> Column:
    """PMI / IC of a pair whose term stands in ``with_term`` texts, at most 1."""
    share = F.least(F.col("with_entity") / total, F.lit(0.999999))
    given = F.when(F.col("smooth"), (F.col("together") + support * share) / (with_term + support)).otherwise(F.col("together") / with_term)
    return F.least(F.log(given * total / F.col("with_entity")) / -F.log(share), F.lit(1.0))


def find_personal(docs: DataFrame, rule: Disclosure = Disclosure(), id_column: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``doc_id, text_key, base, terms`` of each document: base spans, and (start, stop, disclosure) of the terms that reveal them.

    Rows of the same id and text share one result row for each of them; a null or empty text has no
    spans. A revealing term is marked wherever it stands in a text that holds a base span; a text
    without base spans has no terms. Only texts with base spans leave the scan.
    """
    known = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key"))
    base = find_base(known, "text", "base")
    holding = stored(base.where(F.size("base") > 0), "with-spans")
    # few rows: the contexts of the spans, used several times
    contexts = stored(_contexts(holding, rule.reach), "contexts")
    terms = stored(revealing_terms(docs, holding, contexts, rule, text), "terms")
    terms = F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms
    near = contexts.join(terms, "term").select("id", "text_key", "start", "stop", "disclosure")
    marked = _occurrences(holding, terms).unionByName(near).groupBy("id", "text_key", "start", "stop").agg(F.max("disclosure").alias("disclosure"))
    marked = marked.groupBy("id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "disclosure"))).alias("terms"))
    right_id, right_key = own("id"), own("key")
    marked = marked.withColumnsRenamed({"id": right_id, "text_key": right_key})
    met = base.drop("text").join(marked, F.col("id").eqNullSafe(F.col(right_id)) & (F.col("text_key") == F.col(right_key)), "left")
    none = F.array().cast("array<struct<start:int,stop:int,disclosure:double>>")
    return met.select(F.col("id").alias("doc_id"), "text_key", "base", F.coalesce("terms", none).alias("terms"))


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure(), id_column: str = "doc_id", text: str = "text") -> DataFrame:  # noqa: B008
    """``docs`` with base spans replaced by ``<EMAIL>`` and the like, revealing terms by ``<word>`` or, from ``remove_at`` on, by nothing.

    Overlapping spans are replaced as one, by the first. Rows without spans stay as they are, null
    texts null; all columns and all rows are kept.
    """
    found = find_personal(docs, rule, id_column, text).where(F.size("base") > 0).dropDuplicates(["doc_id", "text_key"])
    row, key = own("row"), own("key")
    given = docs.select(F.struct("*").alias(row), F.xxhash64(text).alias(key))
    spans = F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("stop"), F.concat(F.lit("<"), F.upper(F.get(F.array(*map(F.lit, KINDS)), b["kind"])), F.lit(">")).alias("mark"))),
        F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop"), F.when(t["disclosure"] >= rule.remove_at, "").otherwise("<word>").alias("mark"))),
    )
    right = found.select(F.col("doc_id").alias(f"{key}_id"), F.col("text_key").alias(f"{key}_right"), F.array_sort(spans).alias(f"{key}_spans"))
    right = stored(right, "sanitised-spans")
    same = F.col(f"{row}.{id_column}").eqNullSafe(F.col(f"{key}_id")) & (F.col(key) == F.col(f"{key}_right"))
    if right.count() <= BROADCAST_KEYS:  # only texts with spans move, the others stay where they are read
        keys = F.broadcast(right.select(f"{key}_id", f"{key}_right"))
        clean, given = given.join(keys, same, "left_anti").select(row), given.join(keys, same, "left_semi")
    else:
        clean = None
    met = given.join(right.hint("merge"), same, "left")
    old = F.col(f"{row}.{text}")
    built = F.aggregate(
        F.col(f"{key}_spans"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda s, x: F.when(x["start"] < s["at"], F.struct(F.greatest(s["at"], x["stop"]).alias("at"), s["parts"].alias("parts"))).otherwise(
            F.struct(x["stop"].alias("at"), F.concat(s["parts"], F.array(F.substring(old, s["at"] + 1, x["start"] - s["at"]), x["mark"])).alias("parts"))
        ),
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(old, s["at"] + 1, F.length(old))),
    )
    new = F.when(F.col(f"{key}_spans").isNull(), old).otherwise(built)
    changed = met.select(F.col(row).withField(text, new).alias(row)).select(f"{row}.*")
    return changed if clean is None else clean.select(f"{row}.*").unionByName(changed)
