import html as H
import re
import time

import pytest

from keyedflow.llm import extract, queries


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style></head><body>{body}</body></html>"


def alone(body):
    return extract.extract_group([page(body)])[0]


def test_parts_that_are_no_article():
    body = """<header><h1>Site</h1></header><nav><ul><li><a href=x>menu</a></li></ul></nav>
    <div class="cookie-notice">We use cookies</div><!-- <p>not</p> --><script>var a = "</p><p>no";</script>
    <article><header><h1>Title &amp; more</h1></header><p>First  <b>bold</b>
    text&nbsp;here.<p>Second<br>line<script>x</script>.</p><form><input><p>form</p></form>
    <aside>side</aside><ul><li>one<li>two</ul><div id="adSlot">buy</div><blockquote>quote</blockquote>
    <section class="comments"><p>reader</p></section></article>
    <div class="sidebar">links</div><footer>&copy; end</footer>"""
    assert alone(body) == "Title & more\nFirst bold text here.\nSecond line.\none\ntwo\nquote"


@pytest.mark.parametrize("html,want", [
    ("", ""), ("   ", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a<p>b", "a\nb"), ("<p>a</p", "a"), ("<p>a<!-- x", "a"),
    ("<article><p>a &am", "a &am"), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<p>x<script>y", "x"),
    ("<div hidden><p>a</p></div><p>b</p>", "b"), ("<p title='a>b'>c</p>", "c"), ("</p></div><p>a</b></p>", "a"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<main><p>in</p></main><p>out</p>", "in"), ("<P CLASS=x>A</P>", "A"),
    ("<p>caf&eacute; &#233; &#xe9; &unknown; &amp</p>", "café é é &unknown; &"),
    ("<div>" * 3000 + "deep", "deep"),
])
def test_pages_alone(html, want):
    assert extract.extract_group([html]) == [want]


def test_induction_without_any_marks():
    """Nothing but position and repetition tells template from content."""
    pages = [
        page(f"<div><p>Welcome to the site</p></div><div><div><h2>Story {i}</h2><p>Text of {i}.</p>"
             + "".join(f"<p>More {i} {k}</p>" for k in range(i % 4)) + "<p>All rights reserved</p></div></div>"
             f"<div><a href=a>link {i}</a> <a href=b>other {i}</a></div>")
        for i in range(20)
    ]
    for i, text in enumerate(extract.extract_group(pages)):
        assert text == "\n".join([f"Story {i}", f"Text of {i}.", *(f"More {i} {k}" for k in range(i % 4))])


def test_copies_prove_nothing():
    html = page("<article><h1>Same</h1><p>Copied page</p></article>")
    assert extract.extract_group([html] * 50) == ["Same\nCopied page"] * 50


def test_common_paragraph_of_some_pages_stays():
    pages = [page(f"<article><p>Own {i}</p>{'<p>Passage</p>' if i % 2 else ''}</article>") for i in range(30)]
    got = extract.extract_group(pages)
    assert got[1] == "Own 1\nPassage" and got[2] == "Own 2"


def test_tree_matching():
    tree = lambda html: extract.tree_of(extract.parse(html))
    a, b = tree("<div><p>a</p><h2>b</h2><ul><li>c</ul></div>"), tree("<div><h2>x</h2><blockquote>z</blockquote><ul><li>y</ul></div>")
    assert extract.simple_tree_matching(a, b, {}) == 5  # root, div, h2, ul, li
    assert extract.simple_tree_matching(a, a, {}) == 6


def expected(html):
    """The article of the test tables, read by patterns of their own."""
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
    blocks = [" ".join(H.unescape(b).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op2_wrapper_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])
        assert r["text"] == expected(pages[r["page_id"]]["html"])


def test_edges(spark):
    rows = [(1, None, None, "x", 1), (2, "", "", "x", 1), (3, "http://u:p@Host.example:80/a?b", "<p>a</p>", "x", 1), (3, "http://u:p@Host.example:80/a?b", "<p>a</p>", "x", 1),
            (4, "//host.example", "<p>" + "long " * 200000, "x", 1), (5, "no host", "<p>b", "x", 1), (None, "http://host.example", "<p>c", "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, _part int")
    got = extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    texts = sorted(((r["page_id"] or 0, r["text"]) for r in got.collect()))
    assert [t for _, t in texts] == ["c", "", "", "a", "a", ("long " * 200000).strip(), "b"]
    assert extract.extract(df.limit(0)).count() == 0
    hosts = [r[0] for r in df.select(extract.host_of(df["url"])).collect()]
    assert hosts == ["", "", "host.example", "host.example", "host.example", "", "host.example"]


@pytest.mark.parametrize("html,want", [
    ('<div class="a""><p>Hello world</p></div>', "Hello world"), ("<p title=it's>text</p><p>it's</p>", "text\nit's"),
    ("<p a\"b='c>d' e>x</p>", "x"), ("<p>seen</p><p title=\"abc>" + "swallowed " * 50000, "seen"), ("<p =x y = z>t</p>", "t"),
])
def test_no_markup_in_the_text(html, want):
    """Quotes open a value only behind an equals sign, as in browsers; an unclosed one takes the rest of the page."""
    assert extract.extract_group([html]) == [want]


@pytest.mark.parametrize("html,want", [
    ("<div class='layout no-sidebar'><article><p>In</p></article></div>", "In"), ("<div class='post comments-open'><p>In</p></div>", "In"),
    ("<div class='alert-story'><p>In</p></div>", "In"), ("<div class='sidebar'><article><p>only</p></article></div>", "only"),
    ("<div class='sidebar'><article><p>teaser</p></article></div><article><p>In</p></article>", "In"),
    ("<div class='with-nav'><p>In</p></div><div class='sidebar-left'><p>s</p></div><div id='relatedPosts'><p>r</p></div>", "In"),
    ("<nav><article>n</article></nav><div hidden><article>h</article></div><p>In</p>", "In"),
])
def test_articles_are_not_lost_to_a_name(html, want):
    assert extract.extract_group([html]) == [want]


@pytest.mark.parametrize("html,want", [
    ("<p>Hello <span class='advert'>BUY</span> world</p>", "Hello world"), ("<p>a <span hidden>x</span>b</p>", "a b"),
    ("<p>a <span class='share'>b <span>c</span> d</span> e</p><p>f</p>", "a e\nf"), ("<p>x <span class=ad>open <p>next</p>", "x\nnext"),
    ("<p>a <b class='bold'>c</b></p>", "a c"), ("<div>a <span class='ad'><div>in</div>out</span> b", "a\nb"),
])
def test_inline_adverts_are_left_out_of_their_block(html, want):
    assert extract.extract_group([html]) == [want]


def test_nesting_of_any_depth():
    """Structure is kept at any depth: the article in a deep header stays, and deep trees are aligned."""
    start = time.process_time()
    deep = "<div>" * 200_000
    assert extract.extract_group([deep + "deep"]) == ["deep"]
    assert extract.extract_group(["<p>" + "<b>" * 200_000 + "deep"]) == ["deep"]
    assert time.process_time() - start < 60
    wrapped = "<div>" * 500
    pages = [f"{wrapped}<article><header><h1>T{i}</h1></header><p>own {i}</p><p>same</p></article><div>same {'</div>' * 501}" for i in range(20)]
    assert extract.extract_group(pages) == [f"T{i}\nown {i}" for i in range(20)]
