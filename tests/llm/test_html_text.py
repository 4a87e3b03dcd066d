import html
import re

import numpy as np
from helpers import clashing

from protoclass.llm import html_text
from protoclass.llm.html_text import blocks, extract_text, main_text, runs
from protoclass.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_parts_that_are_not_the_article():
    page = ('<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>'
            '<div class="cookie-notice">We use cookies on this site, and we tell you so at length.</div><main><article><header><h1>Title</h1></header>'
            '<p>One <b>two</b> &amp; x &lt;y&gt;<p>Three\n\t four<ul><li>a<li>b</ul><div class="ad">buy</div><form><label>L</label><input value="v"></form>'
            '<script>if (a < b) { w("</p><p>no") }</script><p>Short</article><section id="comments"><p>A long comment of a reader, longer than the article itself.</section></main>'
            '<aside>side</aside><footer>&copy; foot</footer></body></html>')
    assert main_text(page) == "Title One two & x <y> Three four a b Short"


def test_without_markup_of_the_article():
    page = ('<div id="top-menu"><a>Home</a></div><div class="content"><p>A paragraph that goes on for long enough to count as text.</p><p>End.</p></div>'
            '<div class="sidebar">x</div><div class="comments"><p>first comment of all, and it is a long one indeed</p></div>')
    assert main_text(page) == "A paragraph that goes on for long enough to count as text. End."


def test_surge_and_dive():
    assert runs(np.array([3, 0, 0, 0, 50, 60, 0, 5, 0, 0, 0, 2])) == [(4, 9)] or runs(np.array([3, 0, 0, 0, 50, 60, 0, 5, 0, 0, 0, 2]))[0][0] == 4
    assert runs(np.array([], np.int64)) == [] and runs(np.array([0, 0])) == []


def test_broken_markup():
    assert main_text("<p>cut off in a tag <b") == "cut off in a tag"
    assert main_text("plain text only") == "plain text only"
    assert main_text("<article><p>x<!-- never closed <p>y") == "x"
    assert main_text("<article><p>a < b and c &am; &#x41; &unknown;</p>") == "a < b and c &am; A &unknown;"
    assert main_text(None) == "" and main_text("") == ""
    assert main_text("<article>" + "<div>" * 3000 + "deep") == "deep"


def test_nulls_long_pages_repeats_and_clashing_names(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x y z</p>"), (3, "u", long), (3, "u", long)]
    got = extract_text(clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"), "text", "n_chars")).collect()
    assert len(got) == 5 and [(r.text, r.n_chars) for r in got if r.page_id in (1, 2)] == [("", 0)] * 2
    assert all(r.n_chars == len(r.text) == 20_000 * 16 - 1 for r in got if r.page_id == 3)
    assert extract_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_query_against_a_plain_reading(spark):
    rows = {r.page_id: r for r in QUERIES["op8_html_text"](spark, SF).collect()}
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", p.html, re.S)[1]
        parts = [html.unescape(re.sub(r"<[^>]*>", "", x)) for x in re.split(r"</?p>|</?h1>|<br>", article)]
        want = " ".join(x for x in (" ".join(y.split()) for y in parts) if x)
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want) and rows[p.page_id].url == p.url


def test_wrappers_do_not_hide_the_article():
    article = '<article><div class="entry-header"><h1>Title</h1></div><p>Some text of the article that goes on for a while.</p><div class="ad">buy</div></article>'
    for wrapper in ('<div class="content has-sidebar">', '<div class="no-sidebar">', '<div class="post share-enabled">', "<form>", '<div id="widget">', '<div role="form"><div class="sidebar">'):
        for page in (wrapper + article, wrapper + article.replace("article>", "div>"), wrapper + article + '</div></form><div class="comments"><article>A comment.</article></div>'):
            assert main_text(page) == "Title Some text of the article that goes on for a while.", page
    assert main_text("<article><form><p>All of the text is in one form.</p></form></article>") == "All of the text is in one form."


def test_marks_are_whole_names():
    hidden = lambda name: blocks(f'<p>{"text " * 20}</p><div class="{name}">x</div>')[-1][1]
    assert all(map(hidden, ("ad", "cookie-notice", "topMenu", "site-header", "sidebar left", "widget_area", "post-comments", "comment-list")))
    assert not any(map(hidden, ("has-sidebar", "no-sidebar", "share-enabled", "entry-header", "post-header", "load", "nocomments")))


def test_surge_and_dive_decide_on_pages_with_an_article():
    long = "A paragraph that goes on for long enough to count as text."
    away = "<nav>a</nav>" + "".join(f'<div class="ad">{i}</div>' for i in range(4))
    page = f"<div>{long} Teaser.</div>{away}<div>{long} Lead.</div><article><p>{long}</p>{away}<p>End.</p></article>{away}<div>{long} Other.</div>"
    # The lead stands in the article's run; the article's short end, in none, is added; runs without the article go.
    assert main_text(page) == f"{long} Lead. {long} End."


def test_given_pages_without_their_article_tags(spark):
    """The line blocks alone read the same text."""
    for p in spark.read.parquet(f"{SF}/pages.parquet").collect():
        assert main_text(re.sub(r"</?article>", "", p.html)) == main_text(p.html)


def neutral(page):
    """The page with all elements of a block by one name, without attributes: nothing marks its parts."""
    page = re.sub(r"<(script|style|title)>.*?</\1>", "", page, flags=re.S)
    return re.sub(r"<(/?)(?:nav|ul|li|article|footer|h1|div|p|a)\b[^>]*>", r"<\1div>", page)


def test_switching_the_runs_off_changes_every_given_page(spark, monkeypatch):
    pages = [p.html for p in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    texts = [main_text(p) for p in pages]
    monkeypatch.setattr(html_text, "runs", lambda weights, article=None: [(0, len(weights))])
    assert all(t != main_text(p) and t in main_text(p) for t, p in zip(texts, pages, strict=True))


def test_runs_find_the_article_of_pages_without_marks(spark):
    """Names and classes sharpen the edges: without any the runs still hold the whole article, and little else."""
    pages = [p.html for p in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    want, got = [main_text(p) for p in pages], [main_text(neutral(p)) for p in pages]
    assert all(w in g for w, g in zip(want, got, strict=True))
    assert sum(map(len, got)) < 1.15 * sum(map(len, want))


def test_marks_lower_weights_and_do_not_rule_out():
    long = "A paragraph of a page that has all of its text in what it calls a sidebar. " * 40
    assert main_text(f'<div class="sidebar"><p>{long}</p></div><p>tiny</p>') == long.strip() + " tiny"
    links = "".join(f'<p><a href="/{i}">A title of some other page {i}</a></p>' for i in range(8))
    text = "A paragraph that goes on for long enough to count as text."
    assert main_text(f"{links}<p>{text}</p>{links}") == text
    assert main_text(f'<article><p>{text}</p><p><a href="/">Read on here.</a></p></article>{links}') == f"{text} Read on here."
