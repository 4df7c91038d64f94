import html
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskfold.llm import html_main as hm
from maskfold.llm.queries import QUERIES

from .helpers import SF, empty


def _reference(page):
    m = re.search(r"<article>(.*?)(</article>|\Z)", page or "", re.S)
    blocks = re.sub(r"</?(?:p|h1|br|div)[^>]*>", " ", m[1]) if m else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", "", blocks)).split())


@pytest.fixture(scope="module")
def model(spark):
    return hm.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op6_html"](spark, SF).collect()
    assert len(got) == len(pages)
    right = [r["text"] == _reference(pages[r["page_id"]]["html"]) for r in got]
    assert np.mean(right) >= 0.98
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in got)


def test_pages_of_another_set(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    got = hm.main_texts([r["html"] for r in pages], model)
    assert np.mean([a == _reference(r["html"]) for a, r in zip(got, pages)]) >= 0.97


def test_another_layout(model):
    page = """<html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body><header><nav><ul><li><a href=/>Home</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies, as you know.</p></div><div id="main-content"><h1>The title of it</h1>
<p>First paragraph with <a href=x>a link</a>, some text &amp; more, to be read by people who like to read long lines.</p>
<p>The second paragraph goes on and on, with commas, and more text so that it is long enough.<br>After a break</p></div>
<aside class="sidebar"><h3>Related</h3><p>Another story.</p></aside><div class="comments"><div class="comment"><p>Nice article, I liked it.</p></div></div>
<form><input name=q><button>Send</button></form><footer>&copy; somebody</footer></body></html>"""
    (text,) = hm.main_texts([page], model)
    assert "a link, some text & more" in text and "long enough. After a break" in text
    for other in ("cookies", "Home", "Another story", "Nice article", "Send", "somebody", "no"):
        assert not re.search(rf"\b{other}\b", text)


def test_decoding_has_no_contradiction():
    rng = np.random.default_rng(8)
    page = "<body><div><p>a</p><ul><li>b<b>c</b></li></ul></div><div>d<section><p>e</p></section></div></body>"
    nodes = hm.parse(page)
    for _ in range(200):
        state = hm.decode(nodes, np.log(rng.dirichlet(np.ones(3), len(nodes))))
        for i, node in enumerate(nodes[1:], 1):
            above = state[node.parent]
            assert above == hm.BOTH or state[i] == hm.OUT or (above == hm.MAIN and state[i] == hm.MAIN)


def test_parser():
    nodes = hm.parse("<ul><li>a<li>b</ul><p>c<p>d<br>e<!-- x --><b>f</p><table><tr><td>g<td>h</table><p cut")
    tags = [(n.tag, nodes[n.parent].tag if n.parent >= 0 else None) for n in nodes]
    assert tags[1:] == [("ul", "#page"), ("li", "ul"), ("li", "ul"), ("p", "#page"), ("p", "#page"), ("b", "p"), ("table", "#page"), ("tr", "table"), ("td", "tr"), ("td", "tr")]
    assert hm._text(nodes, lambda i: True) == "a b c d ef g h"


def test_sample_is_drawn_among_pages_with_one_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("html").limit(20)
    other = spark.range(6000).selectExpr("concat('<div><p>Page ', id, '.</p></div>', if(id % 3 = 0, '<!-- <article> -->', ''), if(id % 3 = 1, '<article>a</article><article>b</article>', '')) html")
    alone, among = hm.fit(pages), hm.fit(pages.union(other).repartition(5))
    assert np.array_equal(alone.base, among.base) and len(alone.trees) == len(among.trees)
    for one, two in zip(alone.trees, among.trees):
        assert all(np.array_equal(a.value, b.value) and np.array_equal(a.cut, b.cut) for a, b in zip(one, two))
    places = [7, 3, 9, 3, 5, 1]
    html = ["<article>x</article>"] * 4 + ["<p>x", "<ARTICLE >x"]
    batches = [hm.pa.RecordBatch.from_arrays([hm.pa.array(places), hm.pa.array(html)], names=["place", "html"])] * 2
    assert [b.column(0).to_pylist() for b in hm._first(3)(iter(batches))] == [[1, 3, 7]]
    assert hm.fit(other) is None


def _all(page):
    return hm._text(hm.parse(page), lambda i: True)


def test_parser_keeps_what_follows_an_unclosed_element():
    for tag in ("option", "select", "object", "svg", "math", "template", "iframe", "noscript"):
        assert _all(f"<div><{tag} id=x></div><article><p>kept</p></article>") == "kept"
    page = "<form><input list=l><datalist id=l><option value=a><option value=b>two</datalist></form><article><p>First.</p><p>Second.</p></article><aside>z</aside>"
    assert hm.main_texts([page], None) == ["First. Second."]
    assert hm.main_texts(["<select><option>a<option>b</select><p>c</p>"], None) == ["c"]
    assert [(n.tag, n.depth) for n in hm.parse("<select><optgroup><option>a<option>b<optgroup><option>c</select>d")[1:]] == [("select", 1), ("optgroup", 2), ("option", 3), ("option", 3), ("optgroup", 2), ("option", 3)]
    assert _all("a<script>b</script>c<style>d<p>e") == "a c"


def test_parser_keeps_text_of_formulas_and_fallbacks():
    page = "<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><noscript><p>Plain.</p></noscript><object data=f><p>Instead.</p></object><svg><text>Axis</text></svg></article>"
    assert hm.main_texts([page], None) == ["So x = 2 holds. Plain. Instead. Axis"]


def test_parser_takes_quotes_only_at_values():
    assert _all("<img alt=Bob's>First para.</p><p>Second isn't here</p>") == "First para. Second isn't here"
    assert _all("<p class=\"a\"\">one</p><p title='b''>it's</p>") == "one it's"
    assert _all("<p title=\"a > b\" alt = 'c>d'>e</p><a href=f?x='>g</a><i title==\"h>i\">j") == 'e gi">j'
    assert _all('<p title="open>k</p>l') == "k l" and _all("m<p '>n<p a='o") == "m n"
    assert _all("<p " + "=' " * 50_000 + '=" ' * 50_001 + ">q") == "q"


def _slow_parse(page):
    """The tree by walks to the root, as the rules say."""
    nodes, at, open_ = [hm.Node("#page", -1, 0, 0)], 0, 0
    for m in hm._MARKUP.finditer(page):
        if m.start() > at:
            nodes[open_].parts.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, node, last = m[2].lower(), open_, -1
        if m[1]:
            while node > 0 and nodes[node].tag != tag:
                node = nodes[node].parent
            open_ = nodes[node].parent if node > 0 else open_
            continue
        if tag in hm.ENDS_P:
            while node > 0 and nodes[node].tag in hm.INLINE:
                node = nodes[node].parent
            open_ = nodes[node].parent if nodes[node].tag == "p" else open_
        if tag in hm.ITEM_OF:
            ended, holders = hm.ITEM_OF[tag]
            node = open_
            while node > 0 and nodes[node].tag not in holders:
                last = node if nodes[node].tag in ended else last
                node = nodes[node].parent
            open_ = nodes[last].parent if last >= 0 else open_
        nodes.append(hm.Node(tag, open_, nodes[open_].depth + 1, 0))
        nodes[open_].parts.append(len(nodes) - 1)
        open_ = len(nodes) - 1
    if at < len(page):
        nodes[open_].parts.append(page[at:])
    return nodes


def test_parser_against_walks_to_the_root():
    rng = np.random.default_rng(4)
    tags = ["p", "b", "i", "div", "ul", "li", "dl", "dt", "dd", "table", "tr", "td", "th", "select", "optgroup", "option", "object", "section"]
    for _ in range(400):
        page = "".join(f"<{'/' if rng.random() < 0.35 else ''}{tags[rng.integers(len(tags))]}>{'x' if rng.random() < 0.3 else ''}" for _ in range(rng.integers(1, 60)))
        got, want = hm.parse(page), _slow_parse(page)
        assert [(n.tag, n.parent, n.depth, n.parts) for n in got] == [(n.tag, n.parent, n.depth, n.parts) for n in want], page


def test_deep_and_long_pages_take_time_in_proportion(model):
    many = 100_000
    pages = [
        "<article>" + "<div>" * many + "deep", "<article>a" + "</div>" * many, "<article>" + "<div>" * (many // 2) + "</p>" * (many // 2) + "x",
        "<p><object>" + "<b>" * (many // 3) + "<div></div>" * (many // 3) + "x", "<div>" * (many // 2) + "<li>a" * (many // 2),
    ]
    for page in pages:
        began = time.perf_counter()
        nodes = hm.parse(page)
        assert time.perf_counter() - began < 2
        assert sum(isinstance(p, str) for n in nodes for p in n.parts) >= 1
    assert hm.main_texts([pages[0]], None) == ["deep"]
    hm.main_texts(pages[:2], model)


def test_huge_pages_in_the_sample(spark):
    """A deep page and one of very many elements are drawn, and bound what reaches the driver."""
    rows = [("<body><article>" + "<div>" * 1500 + "deep</article></body>",), ("<body><nav>n</nav><article>" + "<p>a b.</p>" * 500_000 + "</article></body>",)]
    pages = spark.createDataFrame([(*r,) for r in rows], "html string")
    got = pages.select(F.monotonically_increasing_id().alias("key"), "html").mapInArrow(hm._training, "x binary, y binary, plain boolean").collect()
    assert len(got) == 2 * (hm.VARIANTS + 1) and max(len(r["y"]) for r in got) == hm.ELEMENTS
    small = spark.read.parquet(f"{SF}/pages.parquet").select("html").limit(20)
    fitted = hm.fit(small.union(pages.limit(1)))
    assert fitted is not None and len(fitted.trees) == hm.ROUNDS


def test_odd_pages(spark, model):
    long = "<article>" + "<p>some words, here.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<html></html>"), (4, "u", "plain &lt;text&gt;"), (5, "u", long), (6, "u", "<div>" * 3000 + "deep"), (6, "u", "<div>" * 3000 + "deep"), (None, "u", "<p>a"), (7, "u", "<")]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, text int")
    got = hm.extract(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    text = {r["page_id"]: r["text"] for r in got.collect()}
    assert text[1] == text[2] == text[3] == "" and text[4] == "plain <text>"
    assert text[5].count("some words, here.") == 20_000
    assert hm.extract(empty(pages), model).count() == 0 and hm.fit(empty(pages)) is None
    assert hm.main_texts(["<nav>x</nav><article><p>y</p><aside>z</aside></article>", "<p>a</p><footer>b</footer>"], None) == ["y", "a"]
