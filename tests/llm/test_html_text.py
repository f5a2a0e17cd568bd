"""Main text of pages: whole pages, tags read as browsers do, and cuts against all labellings."""
import html
import itertools
import random
import re

import pytest

from spanveil.llm import html_text

LONG = "The river ran past the old mill, and nobody had seen the miller, who lived alone, for a year."


def text(source, odds=None):
    page = html_text.Page(source)
    return "\n".join(b.text for b, good in zip(page.blocks, html_text.label(page, odds or {})) if good)


def test_minimum_cut_against_all_labellings():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 8)
        supplies = [rng.choice([-3, -1, 0, 0, 1, 2, 4]) for _ in range(n)]
        edges = [(a, b, rng.randint(0, 3)) for a in range(n) for b in range(a) if rng.random() < 0.5]

        def cost(side):
            return (sum(abs(s) for s, x in zip(supplies, side) if s and x != (s > 0))
                    + sum(c for a, b, c in edges if side[a] != side[b]))

        best = min(map(cost, itertools.product([False, True], repeat=n)))
        most = max((s for s in itertools.product([False, True], repeat=n) if cost(s) == best), key=sum)
        got = html_text.content_side(supplies, edges)
        assert cost(got) == best and sum(got) == sum(most)


def test_long_chains_end():
    n = 20_000
    side = html_text.content_side([5] + [0] * (n - 2) + [-5], [(i, i + 1, 1) for i in range(n - 1)])
    assert len(side) == n
    supplies = [1 if i % 7 else -3 for i in range(n)]
    assert len(html_text.content_side(supplies, [(i, i + 1, 2) for i in range(n - 1)])) == n


@pytest.mark.parametrize("source, want", [
    ("<article><h1>A</h1><p>b  c<br>d</article>", "A\nb c d"),
    ("<article><p>one<p>two<ul><li>x<li>y</ul>tail</article>", "one\ntwo\nx\ny\ntail"),
    ("<article><p><b>one<p>two</b> three</p></article>", "one\ntwo three"),
    ("<article>f&amp;g &lt;b&gt; &eacute;&#233;&#x41; &am &ampx <i>in</i>line</article>", "f&g <b> ééA &am &x inline"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
    ("<article><p>a<!-- <p>b --> c<script>var x = '</p>';</script>d<style>p{}</style></article>", "a cd"),
    ("<ARTICLE><P TITLE='a>b'>x</P></ARTICLE>", "x"),
    ("<article><p>1 < 2 </3 <a href=x>l</a></article>", "1 < 2 l"),
    ("<article><p>unclosed <b>text", "unclosed text"),
    ("<article><p>text</p></article><p", "text"),
    ("<article>a<noscript><p>n</p></noscript><template><p>t</p></template><svg><text>s</text></svg></article>", "a"),
    ("<article><pre>a\n  b</pre><hr>c<div>d</div>e</article>", "a b\nc\nd\ne"),
    ("", ""), ("<", "<"), ("<!--", ""), ("plain  words", "plain words"), ("<script>", ""), ("&#0;&nbsp;x", "� x"),
])
def test_tags_and_references(source, want):
    assert text(source) == want


@pytest.mark.parametrize("extra", [
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<div class='main-menu'><a href=x>Go</a></div>", f"<header><h1>Site</h1><p>{LONG}</p></header>",
    f"<footer><p>{LONG}</p></footer>", f"<aside><p>{LONG}</p></aside>", f"<div id=sidebar><div><p>{LONG}</p></div></div>",
    f"<div class='cookie-notice'>{LONG}</div>", f"<div class=ad>{LONG}</div>", f"<form><label>Name</label><input value=x>{LONG}<button>Send</button></form>",
    f"<section id='comments'><h2>Comments</h2><article class='comment'><p>{LONG}</p></article></section>", f"<div class='userComments'><p>{LONG}</p></div>",
    f"<div role=navigation>{LONG}</div>", f"<p hidden>{LONG}</p>", f"<div style='display: none'>{LONG}</div>", f"<div class=newsletter-signup>{LONG}</div>"])
def test_parts_that_are_no_article(extra):
    body = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>end {LONG}</p>"
    want = f"Title\n{LONG}\nShort.\nend {LONG}"
    assert text(f"<html><head><title>t</title></head><body>{extra}<article>{body}</article>{extra}</body></html>") == want
    assert text(f"<body>{extra}<main><div>{body}</div></main>{extra}") == want
    inside = body.replace("<p>Short.</p>", extra + "<p>Short.</p>")
    if not extra.startswith("<header"):
        assert text(f"<body><article>{inside}</article>") == want


def test_wrappers_are_no_refusal():
    want = f"Title\n{LONG}"
    for wrapper in ("<form id=all>{}</form>", "<div class='page with-sidebar'>{}<div class=sidebar>x</div></div>"):
        assert text(wrapper.format(f"<main><h1>Title</h1><p>{LONG}</p></main>")) == want
        assert text(wrapper.format(f"<article><h1>Title</h1><p>{LONG}</p></article>")) == want


def test_neighbours_decide_a_doubtful_block():
    odds = {"words 2": -1.0, "words 5": 3.0, "linked 3": -3.0}
    source = f"<div><p>{LONG}</p><p>Well, no.</p><p>{LONG}</p></div><ul><li><a>Next page</a><li><a>Last page</a></ul>"
    assert text(source, odds) == f"{LONG}\nWell, no.\n{LONG}"
    assert text("<div><p>Well, no.</p></div>", odds) == ""


@pytest.mark.parametrize("source", ["<a " * 200_000, "<p title='" * 50_000, "<div>" * 100_000 + "x", "<p><table>" * 20_000 + "x", "<!--" * 100_000,
                                    "<svg>" * 50_000, "x" * 2_000_000, "<b>" * 100_000 + "</i>" * 100_000, "<li>" * 50_000 + "</ul>" * 50_000, "&" * 300_000])
def test_long_odd_pages_end(source):
    text(source)


def test_query(spark, table):
    pages = table("pages")
    got = {r["page_id"]: r for r in html_text.extract(pages, html_text.fit(pages), keep=["page_id", "url"]).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:p|h1)>", re.sub("</?b>", "", article.replace("<br>", " ")))]
        want = "\n".join(p for p in parts if p)
        assert (got[row["page_id"]]["url"], got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (row["url"], want, len(want))


def test_nulls_repeats_clashes_and_nothing(spark):
    rows = [(1, "u", None, "old"), (1, "u", "<p>x</p>", "old"), (None, None, "<p>x</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(pages, html_text.fit(pages)).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("x", 1), ("x", 1)] and "html" in got[0]
    assert html_text.extract(pages.limit(0), html_text.fit(pages.limit(0))).count() == 0
