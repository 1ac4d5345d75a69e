import html
import re

import numpy as np
import pytest

from tablelift.llm import extract


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain text only", "plain text only"), ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600;</p>", "a <b> &amp; éé😀"),
    ("<article><p>one\n\t two<br>three<p>four <i>fi</i>ve</article>", "one two three four five"),
    ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Body</article><footer>f</footer>", "T Body"),
    ("<article><script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></article>", "yes"),
    ("<article><p>kept</p><aside>side</aside><form><p>form</p></form><div class='cookie-notice'>cookies</div><p class=\"ad\">buy</p><p>also</p></article>", "kept also"),
    ("<article><p>kept</p><section id=comments><article class=comment><p>I disagree</p></article></section></article>", "kept"),
    ("<article><header><p>by line</p></header><p>x</p><div hidden>h</div><div style='display: none'>h</div><p>y</p></article>", "x y"),
    ("<article><p>cut off in a tag <a href='x", "cut off in a tag"), ("<article><p>cut &am", "cut &am"),
    ("<article><p title='a > b'>quoted</p><p title=\"unclosed>text</p></article>", "quoted text"),
    ("<html><head><title>no</title><meta charset=utf-8></head><body><article><p>in</p></article><p>out of the article</p></body>", "in"),
    ("<body><div><p>" + "word " * 40 + "</p><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul></div>", ("word " * 40).strip()),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<article><p>a</p></article></div></nav><p>z", "a"), ("<script>never closed <p>x", ""),
])
def test_pages(page, text):
    assert extract.main_text(page) == text


LONG = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(("page", "text"), [
    ("<article><p title='the hidden truth'>text</p><p data-x='hidden' alt=hidden>more</p></article>", "text more"),
    (f"<div class='content has-sidebar'><p>{LONG}</p></div>", LONG), (f"<div class='post with-comments' id=no-ads><p>{LONG}</p></div>", LONG),
    (f"<div><p>{LONG}</p></div><article class=related><p>a card with some words</p></article>", LONG),
    (f"<div><p>{LONG}</p></div><article class='Sponsored-Box'><p>a card with some words</p></article>", LONG),
    ("<article><p>sum <math><mi>x</mi><mo>+</mo></math> done</p></article>", "sum x+ done"),
    ("<article><p>a</p><noscript><p>Enable scripts</p></noscript><p>b</p></article>", "a b"),
    ("<article><p>a</p><svg><path d='M0'><p>b</p><noscript><p>c</p></article>", "a b c"), ("<article><p>a</p><svg><text>drawn</text></svg><p>b</p></article>", "a b"),
    ("<article><p>a</p><div aria-hidden='true'>h</div><div aria-hidden=false>b</div><div style='color:red;DISPLAY : none'>h</div></article>", "a b"),
    ("<article><p>a</p><div class='main-nav'>menu</div><div id=cookie_notice-bar>cookies</div><div aria-label='Comments'>c</div><div aria-label='Comments are facts'>b</div></article>", "a b"),
])
def test_names_and_attributes_say_what_they_say(page, text):
    assert extract.main_text(page) == text


def test_a_teaser_is_not_the_page():
    page = f"<article><p>Read more about <a href=x>lamps</a></p></article><div><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>"
    assert f"Head {LONG} {LONG}" in extract.main_text(page)


def test_the_tree_fits_its_table():
    table = np.array(extract.LABELLED, dtype=float)
    right = 0
    for row in table:
        node = extract.tree()
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        right += node == row[-1]
    assert right >= len(table) - 1


def test_very_long_and_broken_pages():
    page = "<article>" + "<p>some words here</p>" * 20_000 + "<" * 5000
    assert extract.main_text(page).startswith("some words here some") and extract.main_text("<div>" * 3000 + "deep") == "deep"


def test_rows(spark):
    page = "<article><p>x</p></article>"
    rows = [(1, "u", page, "t"), (1, "u", page, "t"), (None, None, page, None), (2, "v", None, ""), (3, None, "", "")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract.extracted(table).collect()), key=repr)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "x", 1), (2, "v", "", 0), (3, None, "", 0)], key=repr)
    assert extract.extracted(table.limit(0)).collect() == []


def test_given_pages(spark):
    """The articles of the given pages, cut out by their plain pattern."""
    for r in extract.extracted(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")).join(spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html"), "page_id").collect():
        parts = re.split(r"</?(?:p|h1|article)>", re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1])
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>|<[a-z/]*\Z", "", x.replace("<br>", " "))).split()) for x in parts]
        assert r.text == " ".join(x for x in parts if x) and r.n_chars == len(r.text)
