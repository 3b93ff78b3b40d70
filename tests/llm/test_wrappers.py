"""Main text of pages, streams, folding and alignment."""

import html
import re

import pytest
from pyspark.sql import functions as F

from cohortloom.llm.queries_wrappers import op1_main_text
from cohortloom.llm.wrappers import Page, Wrapper, extract_main_text, folded, host_of, infer_wrappers, main_text
from cases import FOLDER


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p>a<p>b <b>c</b>d<br>e</p><div class='ad'>x</div>", "a\nb cd e"),
        ("<article><h1>T&amp;t</h1><p>one\n two<ul><li>x<li>y</ul><div class='comments'><p>c</div></article><footer>z", "T&t\none two\nx\ny"),
        ("", ""), ("<", "<"), ("<div title='a>b'>q</div>", "q"), ("<script>var a='</p>';</script>k", "k"), ("x<!-- unclosed", "x"),
        ("<article><header><h1>T</h1></header><p>u&nbsp;v&#x41;</p><aside>s</aside></article>", "T\nu vA"),
        ("<body><nav>m</nav><div><a href=1>link</a></div><p>text</p><form>f<input></form></body>", "text"),
        ("<main><p>a</p><div id=cookie-notice>c</div><div class='newsletter'>n</div></main><p>out</p>", "a"),
    ],
)
def test_pages(source, text):
    assert main_text(Page(source), None) == text


def test_folding_finds_nested_groups():
    assert folded(tuple("a b c c b c c b c c d".split()))[0] == ("a", "(b (c)+)+", "d")
    assert folded(())[0] == ()


def test_alignment_makes_slots_optional_and_repeated_groups():
    def wrapper(source):
        symbols, _ = folded(tuple(Page(source).symbols))
        return Wrapper([[s, 1, None] for s in symbols], 1)

    one = wrapper("<div>a</div><p>x</p><p>y</p>")
    two = wrapper("<div>b</div><h2>t</h2><p>x</p>")
    assert one.align(two).expression() == "<div> # </div> (<h2>)? (#)? (</h2>)? (<p> # </p>)+"


def test_template_text_is_left_out(spark):
    pages = [(i, f"http://H.example/{i}", f"<div>Subscribe to us</div><section><p>story {i} tells</p><p>more of {i}</p></section>") for i in range(8)]
    pages += [(50, None, None), (51, "http://h.example/x", ""), (52, "nonsense", "<p>alone</p>"), (0, "http://H.example/0", pages[0][2])]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["row"]["page_id"]: r["text"] for r in extract_main_text(frame).collect()}
    assert found[3] == "story 3 tells\nmore of 3" and found[50] == "" and found[51] == "" and found[52] == "alone"
    assert extract_main_text(frame).count() == len(pages)
    assert extract_main_text(frame.limit(0)).count() == 0
    wrapper = infer_wrappers(frame).where("host = 'h.example'").first()
    assert wrapper["pages"] == 10 and "(<p> # </p>)+" in wrapper["expression"]


def test_copies_keep_their_article(spark):
    def page(i):
        return f"<div>Ad {i % 3}</div><article><h1>Headline</h1><p>The whole story.</p></article>"

    pages = [(i, f"http://copies.example/{i}", page(i)) for i in range(12)] + [(20, "http://copies.example/x", "<article><h1>Other</h1><p>News.</p></article>")]
    pages += [(30 + i, f"http://mixed.example/{i}", f"<article><p>Read our terms.</p><h1>Title {i // 2}</h1></article>") for i in range(16)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["row"]["page_id"]: r["text"] for r in extract_main_text(frame).collect()}
    assert all(found[i] == "Headline\nThe whole story." for i in range(12)) and found[20] == "Other\nNews."
    assert all(found[30 + i] == f"Title {i // 2}" for i in range(16))


def test_hosts(spark):
    urls = ["http://User@A.example:80/x", "//b.example", "c.example/x", None, ""]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(host_of(F.col("u"))).collect()] == ["a.example", "b.example", "", "", ""]


def test_whole_table(spark):
    found = {r["page_id"]: r for r in op1_main_text(spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"] or "", re.DOTALL)
        blocks = re.split(r"</?(?:p|h1)>", article[1]) if article else []
        text = "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks) if x)
        assert found[r["page_id"]]["text"] == text and found[r["page_id"]]["n_chars"] == len(text)
