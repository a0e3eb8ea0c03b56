import itertools
import random

import pytest

from aloft.llm import htmltext
from aloft.llm.queries import QUERIES

PROSE = "The river ran on past the old mill, and nobody in the town could say where it went. It was late."
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav>
<div id="sidebar"><p>%(p)s</p></div><main><article><h1>Head &amp; tail</h1><p>%(p)s</p><p>Short.</p>
<div class="ad">Buy now, it is cheap and good.</div><ul><li>First point</li><li>Second point</li></ul>
<p>a<b>b</b>c<br>d &eacute;&#233;&nbsp;x</p><script>var t="</p><p>no</p>";</script></article>
<section class="comments"><p>%(p)s</p></section></main><div class="cookie-banner">We use cookies.</div>
<form><p>%(p)s</p><textarea>no</textarea></form><footer><p>%(p)s</p></footer></body></html>""" % {"p": PROSE}


def test_article_without_boilerplate():
    assert htmltext.main_text(PAGE) == f"Head & tail {PROSE} Short. First point Second point abc d éé x"


def test_class_words():
    page = (f'<body class="has-sidebar"><div class="page_content has-sidebar no-ads"><p>{PROSE}</p>'
            f'<div class="post-header"><h2>Part</h2></div><div class="ad_box">{PROSE}</div>'
            f'<div id="fb-comments">{PROSE}</div></div>')
    assert htmltext.main_text(page) == f"{PROSE} Part"


def test_without_any_marks():
    page = f"<div><a href=1>x</a> <a href=2>y</a></div><div><p>{PROSE}<p>{PROSE}</div><div><a>c</a></div>"
    assert htmltext.main_text(page) == f"{PROSE} {PROSE}"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<p></p>", ""), ("<!-- x", ""), ("<p>just", "just"), (f"<p>{PROSE}<div", PROSE),
    (f"<article><p>{PROSE}</i></b></p></article></div></div>", PROSE),
    (f"<article><a title='a>b' href=\"x>y\"></a><p>{PROSE}</article>", PROSE),
    (f"<article><p>{PROSE} 1 < 2 & 3</p></article>", f"{PROSE} 1 < 2 & 3"),
    (f"<body hidden><p>{PROSE}</p></body>", ""), (f"<article><p>{PROSE}<![CDATA[ z]]></p>", f"{PROSE} z")])
def test_broken_markup(page, text):
    assert htmltext.main_text(page) == text


def test_cut_is_minimum():
    r = random.Random(1)
    for _ in range(150):
        n = r.randint(1, 8)
        cost = [r.uniform(-3, 3) for _ in range(n)]
        links = [(i, j, r.uniform(0, 2)) for i in range(n) for j in range(i) if r.random() < 0.5]

        def price(side):
            return (sum(c for c, s in zip(cost, side) if c > 0 and not s)
                    - sum(c for c, s in zip(cost, side) if c < 0 and s)
                    + sum(w for i, j, w in links if side[i] != side[j]))
        best = min(price(s) for s in itertools.product([False, True], repeat=n))
        assert price(htmltext.min_cut(cost, links)) == pytest.approx(best)


def test_long_page_in_reasonable_time():
    import time
    start = time.time()
    assert len(htmltext.main_text("<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>")) > 400_000
    htmltext.main_text("<div>" * 5000 + "x" + '<a href="' * 2000)
    assert time.time() - start < 30


def test_query_and_odd_rows(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = QUERIES["op1_html_extraction"](spark, sf).collect()
    assert len(rows) == pages.count() and all(r.n_chars == len(r.text) for r in rows)
    odd = spark.createDataFrame([(1, "u", PAGE, "x"), (1, None, PAGE, "x"), (None, "u", None, "x"), (2, "u", "", "x")],
                                "page_id long, url string, html string, text string")
    got = htmltext.extract(odd).collect()
    assert [r.n_chars > 0 for r in got] == [True, True, False, False]
    assert htmltext.extract(odd.limit(0)).count() == 0


LONG = " ".join([PROSE] * 4)


@pytest.mark.parametrize("mark", ["section id='discussion'", "section id='related-work'", "div id='legal-status'",
                                  "div class='content-with-sidebar'", "article class='post tag-login'", "form"])
@pytest.mark.parametrize("outer", ["article", "div"])
def test_long_prose_outweighs_a_container_word(mark, outer):
    inner = f"<{mark}><p>{LONG}</p><p>{PROSE}</p><p>{LONG}</p></{mark.split()[0]}>"
    page = f"<body><nav><a href=1>Home</a></nav><{outer}><p>{LONG}</p>{inner}</{outer}></body>"
    assert htmltext.main_text(page) == f"{LONG} {LONG} {PROSE} {LONG}"


def test_link_lists_lose_inside_an_article():
    links = "".join(f"<li><a href={i}>More news {i}</a></li>" for i in range(6))
    page = f"<article><h1>Head</h1><p>{LONG}</p><p>{PROSE}</p><ul>{links}</ul><p>{LONG}</p></article>"
    assert htmltext.main_text(page) == f"Head {LONG} {PROSE} {LONG}"
    one = f"<article><h2><a href=1>Linked head</a></h2><p>{LONG}</p><p><a href=2>{PROSE}</a></p><p>{LONG}</p></article>"
    assert htmltext.main_text(one) == f"Linked head {LONG} {PROSE} {LONG}"


def test_short_and_hidden_text_of_boilerplate_still_goes():
    page = (f"<main><p>{LONG}</p><div class='related'><p>{PROSE}</p></div><div style='display: none'><p>{LONG}</p>"
            f"<p>{LONG}</p></div></main><footer><p>{PROSE}</p></footer>")
    assert htmltext.main_text(page) == LONG


def test_undecided_blocks_in_reasonable_time():
    import time
    start = time.time()
    page = "<div class='sidebar'>" + f"<p>{PROSE}</p><p>{LONG}</p><p><a href=1>x</a></p>" * 4000 + "</div>"
    htmltext.main_text(page)
    assert time.time() - start < 30


def test_the_cut_decides_on_the_table(spark, sf):
    """Some blocks of the given pages end on the other side than their own shape says, each way: short ones
    of articles stay, prose of sidebars and the like goes; the cut costs no more than the shapes' own labels."""
    kept = lost = total = 0
    for row in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect():
        found = htmltext.blocks(row.html or "")
        cost, links = htmltext.graph(found)
        side = htmltext.min_cut(cost, links)
        own = [c > 0 for c in cost]

        def price(labels, cost=cost, links=links):
            return (sum(abs(c) for c, s in zip(cost, labels) if s != (c > 0))
                    + sum(w for i, j, w in links if labels[i] != labels[j]))
        assert price(side) <= price(own) + 1e-9
        total += len(found)
        kept += sum(s and not o for s, o in zip(side[:len(found)], own))
        lost += sum(o and not s for s, o in zip(side[:len(found)], own))
    assert total > 500 and kept > 0 and lost > 0


def test_small_pages_equal_the_exhaustive_cut():
    r = random.Random(6)
    parts = [f"<p>{PROSE}</p>", "<p>Short.</p>", "<ul><li><a href=1>More</a></li></ul>", "<h2>Head</h2>",
             f"<div class='ad'>{PROSE}</div>", "<nav><a href=2>Home</a></nav>", f"<aside><p>{LONG}</p></aside>"]
    for _ in range(40):
        page = "<article>" * (r.random() < 0.5) + "".join(r.choices(parts, k=r.randint(1, 6)))
        found = htmltext.blocks(page)
        cost, links = htmltext.graph(found)

        def price(labels, cost=cost, links=links):
            return (sum(abs(c) for c, s in zip(cost, labels) if s != (c > 0))
                    + sum(w for i, j, w in links if labels[i] != labels[j]))
        best = min(itertools.product([False, True], repeat=len(cost)), key=price)
        assert price(htmltext.min_cut(cost, links)) == pytest.approx(price(best))
        assert htmltext.main_text(page) == " ".join(b.text for b, k in zip(found, best) if k)
