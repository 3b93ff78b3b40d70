"""Main text of web pages by wrappers inferred from pages of the same host.

A page is a stream of tags and text slots. Runs of equal groups are folded into repeated groups, and
the streams of a host are aligned one after another: what agrees stays, text that differs becomes a
slot, what one side lacks becomes optional. The result is a union-free regular expression of tags,
slots, ``(...)+`` and ``(...)?``. A slot that carries the same text under a host's different contents is template; the
article is the text that is left inside the page's main region, without boilerplate elements.
"""

from __future__ import annotations

import html as html_text
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import own, stored

#: Elements whose text is no article, and words of class, id or role names that say so.
OUTSIDE = frozenset("nav header footer aside form menu dialog script style noscript template iframe svg canvas object button select textarea head title".split())
OUTSIDE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert advertisement adverts banner promo promoted sponsor sponsored cookie cookies consent"
    " gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search comment comments disqus reply replies respond"
    " discussion share sharing social related recommended breadcrumb breadcrumbs pagination pager toolbar widget copyright".split()
)
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same set ends, if it was left open.
LEFT_OPEN = {"p": "p", "li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
MAIN_WORDS = frozenset("article content entry main post story".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(.*?)(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|([^<]++)|<",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORDS = re.compile(r"[A-Za-z]+")
#: Longest group of symbols that is looked for as a repetition, pages of a host that make a template slot, and their share.
LONGEST_GROUP = 12
LEAST_PAGES = 5
TEMPLATE_SHARE = 0.8
#: Most hosts whose wrappers are broadcast; beyond, pages and wrappers meet in a shuffle.
BROADCAST_HOSTS = 20_000
#: A host's streams are aligned in so many parts first, so that no task folds them all.
PARTS = 16


class Page:
    """A parsed page: symbols of its stream, and its text blocks (text, first symbol, inside an article, kept, in a link)."""

    def __init__(self, source: str):
        self.symbols: list[str] = []
        self.blocks: list[tuple[str, int, bool, bool, bool]] = []
        stack: list[tuple[str, bool, bool, bool]] = []  # element, outside, main region, link
        words: list[str] = []
        linked, first = 0, -1

        def flush() -> None:
            nonlocal words, linked, first
            text = " ".join("".join(words).split())
            if text:
                outside = any(x[1] for x in where)
                self.blocks.append((text, first, any(x[2] for x in where), not outside, linked * 2 > len(text)))
            words, linked, first = [], 0, -1

        def shut(depth: int) -> None:
            # elements left open end here, as browsers do, so that streams of sloppy pages agree
            self.symbols += [f"</{x[0]}>" for x in reversed(stack[depth:]) if x[0] not in INLINE]
            del stack[depth:]

        where: list[tuple[str, bool, bool, bool]] = []
        for m in _TOKEN.finditer(source):
            raw, slash, name, rest, text = m[1], m[3], m[4], m[5], m[9]
            if name is None and m[7]:
                slash, name, rest = m[6], m[7], m[8]
            if raw or (name is None and text is None and m[0] != "<"):
                continue
            if name is None:
                text = html_text.unescape(text if text is not None else "<")
                if first < 0 and not text.strip():
                    if words:
                        words.append(text)
                    continue
                if first < 0:
                    where = list(stack)
                    first = len(self.symbols)
                    self.symbols.append("#")
                words.append(text)
                if any(x[3] for x in stack):
                    linked += len(text)
                continue
            name = name.lower()
            if name == "br":
                words.append(" ")
                continue
            if name not in INLINE:
                flush()
                if not slash:
                    ends = LEFT_OPEN.get(name, "").split() if name in LEFT_OPEN else []
                    if name in _ENDS_P:
                        ends = [*ends, "p"]
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] in ends:
                            shut(i)
                            break
                        if stack[i][0] not in INLINE:
                            break
            if slash:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        shut(i)
                        break
            elif name not in VOID:
                called = {w.lower() for n in _NAMES.finditer(rest or "") for w in _WORDS.findall(n[2] or n[3] or n[4] or "")}
                main = name in ("article", "main") or ("role" in (rest or "") and "main" in called)
                # a page's own header is no part of the article, a heading block inside an article is
                inside = any(x[2] for x in stack)
                outside = name in OUTSIDE and not (name == "header" and inside) or (not main and name != "body" and bool(called & OUTSIDE_WORDS))
                stack.append((name, outside, main and not outside, name == "a"))
                if name not in INLINE:
                    self.symbols.append(f"<{name}>")
        flush()
        shut(0)


@lru_cache(4096)
def folded(symbols: tuple[str, ...]) -> tuple[tuple[str, ...], tuple[int, ...]]:
    """The stream with runs of equal groups as one ``(...)+`` symbol, and the number of the symbol that each token went to (-1: inside a group)."""
    items = [(s, [i]) for i, s in enumerate(symbols)]
    changed = True
    while changed:
        changed = False
        for size in range(1, LONGEST_GROUP + 1):
            i, out = 0, []
            while i < len(items):
                unit = [s for s, _ in items[i : i + size]]
                repeats = 1
                while items[i][0][0] != "(" or size > 1:
                    at = i + repeats * size
                    if at + size > len(items) or items[at][0] != unit[0] or [s for s, _ in items[at : at + size]] != unit:
                        break
                    repeats += 1
                if repeats > 1:
                    out.append((f"({' '.join(unit)})+", [x for _, group in items[i : i + repeats * size] for x in group]))
                    i += repeats * size
                    changed = True
                else:
                    out.append(items[i])
                    i += 1
            items = out
    place = [-1] * len(symbols)
    for number, (symbol, group) in enumerate(items):
        if symbol[0] != "(":
            place[group[0]] = number
    return tuple(s for s, _ in items), tuple(place)


class Wrapper:
    """A union-free expression: symbols with the pages that have them, for a slot the text that all share, and the different contents."""

    def __init__(self, items: list[list] | None = None, pages: int = 0, contents: int | None = None):
        self.items, self.pages = [[*x, x[1]] if len(x) == 3 else x for x in items or []], pages
        self.contents = pages if contents is None else contents

    def align(self, other: Wrapper) -> Wrapper:
        """The expression of both sides' pages."""
        if not self.items or not other.items:
            return Wrapper(self.items or other.items, self.pages + other.pages, self.contents + other.contents)
        mine, theirs = _squared(self.items, other.items), _squared(other.items, self.items)
        out = []
        for kind, a, b, c, d in SequenceMatcher(None, [x[0] for x in mine], [x[0] for x in theirs], autojunk=False).get_opcodes():
            if kind == "equal":
                for x, y in zip(mine[a:b], theirs[c:d], strict=True):
                    out.append([x[0], x[1] + y[1], x[2] if x[2] == y[2] else None, x[3] + y[3]])
            else:  # what one side lacks is optional
                out += mine[a:b] + theirs[c:d]
        return Wrapper(out, self.pages + other.pages, self.contents + other.contents)

    def template(self) -> list[str | None]:
        """Each symbol's template text, by its hash: a slot that carries one text under most of the host's contents. Copies of a page are one content."""
        enough = max(LEAST_PAGES, TEMPLATE_SHARE * self.contents)
        return [t if s == "#" and n >= enough else None for s, _, t, n in self.items]

    def expression(self) -> str:
        return " ".join(s if n >= self.pages else f"({s})?" for s, n, *_ in self.items)


def _squared(items: list[list], other: list[list]) -> list[list]:
    """Single occurrences of a group that the other side repeats become that group."""
    for group in {x[0] for x in other if x[0][0] == "(" and x[0].endswith(")+")} - {x[0] for x in items}:
        unit = _members(group)
        i = 0
        while i + len(unit) <= len(items):
            if [x[0] for x in items[i : i + len(unit)]] == unit:
                items = [*items[:i], [group, min(x[1] for x in items[i : i + len(unit)]), None, min(x[3] for x in items[i : i + len(unit)])], *items[i + len(unit) :]]
            i += 1
    return items


def _members(group: str) -> list[str]:
    """The symbols of a group, nested groups whole."""
    out, depth, now = [], 0, ""
    for part in group[1:-2].split(" "):
        now = f"{now} {part}" if now else part
        depth += part.count("(") - part.count(")")
        if depth == 0:
            out.append(now)
            now = ""
    return out


def _mark(text: str) -> str:
    return xxhash.xxh3_64_hexdigest(text.encode("utf-8", "surrogatepass"))


def _slots(page: Page) -> tuple[tuple[str, ...], list[str | None]]:
    """The folded stream, and the mark of the text in each slot outside groups."""
    symbols, place = folded(tuple(page.symbols))
    marks: list[str | None] = [None] * len(symbols)
    for text, first, *_ in page.blocks:
        if place[first] >= 0:
            marks[place[first]] = _mark(text)
    return symbols, marks


def _content(page: Page) -> int:
    """Mark of the text of a page's main region, or of all that is no boilerplate element where there is none: equal for copies under any frame."""
    kept = [x for x in page.blocks if x[3]]
    return xxhash.xxh3_64_intdigest("\n".join(x[0] for x in [y for y in kept if y[2]] or kept).encode("utf-8", "surrogatepass")) - (1 << 63)


def host_of(url: Column) -> Column:
    """Lower-case host of an address; the empty text where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def infer_wrappers(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``host, pages, contents, wrapper`` of every host, from all of its pages.

    Equal streams are counted before they meet, so a host's work grows with its different streams; they
    are aligned in parts first, the most frequent first. ``wrapper`` is JSON: symbols, pages that have
    them, the mark of the text that they share, and their different contents. A content counts once on
    a host, with one of the streams that it came in, so copies of a page are no evidence of a template.
    """

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, tuple[str, ...]], list] = {}
            for host, source in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), strict=True):
                page = Page(source)
                symbols, marks = _slots(page)
                old = found.setdefault((host, symbols), [0, marks, set()])
                old[0] += 1
                old[2].add(_content(page))
                old[1] = [a if a == b else None for a, b in zip(old[1], marks, strict=True)]
            rows = [(host, json.dumps(s), _mark("\n".join(s)), n, json.dumps(marks), sorted(seen)) for (host, s), (n, marks, seen) in found.items()]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["host", "stream", "sign", "n", "marks", "seen"])

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        marks = None
        for text in rows["marks"]:
            now = json.loads(text)
            marks = now if marks is None else [a if a == b else None for a, b in zip(marks, now, strict=True)]
        one = rows.iloc[0]
        n = int(rows["n"].sum())
        items = [[s, n, m] for s, m in zip(json.loads(one["stream"]), marks, strict=True)]
        return pd.DataFrame({"host": [one["host"]], "sign": [one["sign"]], "part": [int(one["sign"], 16) % PARTS], "pages": [n], "wrapper": [json.dumps(items)]})

    def fold(rows: pd.DataFrame) -> Wrapper:
        whole = Wrapper()
        for row in rows.sort_values(["pages", "wrapper"], ascending=[False, True]).itertuples():
            items = json.loads(row.wrapper)
            whole = whole.align(Wrapper([[*x, row.contents] if len(x) == 3 else x for x in items], row.pages, row.contents))
        return whole

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        whole = fold(rows)
        return pd.DataFrame({"host": [rows.iloc[0]["host"]], "part": [rows.iloc[0]["part"]], "pages": [whole.pages], "contents": [whole.contents], "wrapper": [json.dumps(whole.items)]})

    def final(rows: pd.DataFrame) -> pd.DataFrame:
        whole = fold(rows)
        return pd.DataFrame({"host": [rows.iloc[0]["host"]], "pages": [whole.pages], "contents": [whole.contents], "wrapper": [json.dumps(whole.items)], "expression": [whole.expression()]})

    given = pages.where(F.col(html).isNotNull()).select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    # read twice: streams with their texts, and contents
    counted = stored(given.mapInArrow(streams, "host string, stream string, sign string, n long, marks string, seen array<long>"), "streams")
    distinct = counted.drop("seen").groupBy("host", "sign").applyInPandas(together, "host string, sign string, part int, pages long, wrapper string")
    contents = counted.select("host", "sign", F.explode("seen").alias("content")).groupBy("host", "content").agg(F.min("sign").alias("sign"))
    contents = contents.groupBy("host", "sign").agg(F.count("*").alias("contents"))
    distinct = distinct.join(contents, ["host", "sign"], "left").withColumn("contents", F.coalesce("contents", F.lit(0))).drop("sign")
    parts = distinct.groupBy("host", "part").applyInPandas(part, "host string, part int, pages long, contents long, wrapper string")
    return parts.groupBy("host").applyInPandas(final, "host string, pages long, contents long, wrapper string, expression string")


def main_text(page: Page, wrapper: Wrapper | None) -> str:
    """Blocks of the main region that are neither boilerplate by their elements nor template by the wrapper, in order."""
    template: set[int] = set()
    if wrapper is not None and any(wrapper.template()):
        symbols, marks = _slots(page)
        known, own_items = wrapper.items, [[s, 1, m] for s, m in zip(symbols, marks, strict=True)]
        texts = wrapper.template()
        place = folded(tuple(page.symbols))[1]
        for a, b, size in SequenceMatcher(None, [x[0] for x in known], [x[0] for x in own_items], autojunk=False).get_matching_blocks():
            for i in range(size):
                if texts[a + i] is not None and texts[a + i] == own_items[b + i][2]:
                    template.add(b + i)
        kept = [x for x in page.blocks if x[3] and (place[x[1]] < 0 or place[x[1]] not in template)]
    else:
        kept = [x for x in page.blocks if x[3]]
    if any(x[2] for x in kept):
        kept = [x for x in kept if x[2]]
    else:
        kept = [x for x in kept if not x[4]]  # without a main region, blocks that are mostly links are menus
    return "\n".join(x[0] for x in kept)


def extract(pages: DataFrame, wrappers: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """All columns of ``pages`` as the struct ``row``, with ``text``.

    Null and empty pages have an empty text; a page whose host has no wrapper is read without one. Pages
    are read whole, rows may repeat.
    """
    row, source, host, wrap = own("row"), own("html"), own("host"), own("wrapper")
    given = pages.select(F.struct("*").alias(row), F.col(html).alias(source), host_of(F.col(url)).alias(host))
    known = wrappers.select(F.col("host").alias(host), F.struct("pages", "contents", "wrapper").alias(wrap))
    few = known.count() <= BROADCAST_HOSTS
    met = given.join(F.broadcast(known) if few else known, host, "left").select(row, source, wrap)
    kind = met.schema.simpleString()[len(f"struct<{row}:") :].rsplit(f",{source}:", 1)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch[source].to_pylist(), batch[wrap].to_pylist(), strict=True):
                if wrapper is not None and wrapper["wrapper"] not in read:
                    if len(read) >= 1000:
                        read.clear()
                    read[wrapper["wrapper"]] = Wrapper(json.loads(wrapper["wrapper"]), wrapper["pages"], wrapper["contents"])
                texts.append(main_text(Page(page or ""), read[wrapper["wrapper"]] if wrapper is not None else None))
            yield pa.RecordBatch.from_arrays([batch[row], pa.array(texts, pa.string())], ["row", "text"])

    return met.mapInArrow(run, f"row {kind}, text string")


def extract_main_text(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Infer the wrappers of all hosts, write them to the shared folder, and extract every page."""
    return extract(pages, stored(infer_wrappers(pages, html, url), "wrappers"), html, url)
