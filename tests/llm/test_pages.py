"""Main text of pages: marked parts, malformed markup, and parts only the site's tree gives away."""

import pytest

from tripledger.llm.pages import (
    DEEPEST, extracted, host, low_paths, main_text, parse, style_tree,
)

ARTICLE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style>
<script>var t="</p><p>no</p>";</script></head><body class="page">
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div>
<article><header><h1>Head &lt;line&gt; &am</h1></header><p><b>First   block
 with <a href="x">link</a>.<br><p>Second &eacute;&nbsp;&#233;<p>Third<ul><li>one<li>two</ul>
<form><p>Sign up</p><button>Go</button></form><div class="share">Share this</div>
<p>Second &eacute; &#233;</p></article>
<section id="comments"><p>Nice post</p></section><aside>More</aside>
<footer>&copy; 2024</footer></body></html>"""


def test_marked_parts_go_and_blocks_stay_in_order():
    assert main_text(ARTICLE, frozenset()).split("\n") == [
        "Head <line> &am", "First block with link.", "Second é é", "Third", "one", "two", "Second é é"]


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain & text", "plain & text"), ("<p>a<p>b", "a\nb"), ("<p>a</div></p>b", "a\nb"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<script>x", ""), ("<p>a<!-- open", "a"),
    ("<p title='>'>quoted</p>", "quoted"), ("<p title=\"open>text</p>", "text"),
    ("<table><tr><td>x<td>y<tr><td>z</table>", "x\ny\nz"), ("<nav>n", ""), ("<p>é\x0b\t é</p>", "é é"),
    ("<div>" * 3000 + "deep", "deep"), ("<p>" + "w " * 100_000 + "</p>", ("w " * 100_000).strip()),
])
def test_odd_markup(page, text):
    assert main_text(page, frozenset()) == text


def test_deep_pages_take_linear_time_and_memory():
    import time
    import tracemalloc

    for page in ("<div class='part'>" * 200_000 + "deep", "<div><p>" * 100_000 + "deep",
                 "<div>" * 100_000 + "deep" + "</div>" * 100_000 + "<p>end",
                 "".join(f"<i{'a' * (i % 50)}>x</b>" for i in range(50_000)),
                 "<ul>" + "<li><div>x" * 50_000):
        begin = time.perf_counter()
        assert main_text(page, frozenset({">body"}))
        assert time.perf_counter() - begin < 30
    tracemalloc.start()
    parse("<div class='part'>" * 100_000)
    assert tracemalloc.get_traced_memory()[1] < 100_000_000
    tracemalloc.stop()


def test_elements_beyond_the_deepest_level_share_a_path():
    blocks, every = parse("<div>" * 60 + "<p class='x'>a</p><p class='" + "long " * 30 + "'>b")
    assert every[59].path == every[50].path == ">div" * (DEEPEST + 1)
    assert blocks[0][0].path == ">div" * DEEPEST + ">p.x" and len(blocks[1][0].path) < 200


def test_host():
    assert host("https://u@WWW.a.org:80/x?y=http://b") == "=www.a.org:80"
    assert host("no scheme/x") == "=no scheme" and host(None) == "" and host("") == "="


def site(n, lead="http://s.example.org/"):
    return [(i, f"{lead}{i}", "<body><div class='intro'><div>Welcome to the site</div></div>"
             f"<div class='body7'><p>Own text {i}</p><p>and {i * 7} more</p>{'<p>x</p>' * (i % 3)}</div>"
             "<div class='end'><p>All rights</p></div></body>") for i in range(n)]


def texts(frame):
    return {r.id: r.text for r in frame.collect()}


def test_the_tree_of_a_site_gives_its_frame_away(spark):
    pages = spark.createDataFrame(site(20) + [(100, "http://other.org/", site(1)[0][2])],
                                  "page_id long, url string, html string").repartition(3)
    got = texts(extracted(pages))
    assert got[4] == "Own text 4\nand 28 more\nx"
    assert got[100] == "Welcome to the site\nOwn text 0\nand 0 more\nAll rights"  # one page tells nothing
    low = low_paths(style_tree(pages, "url", "html")).first().low
    assert ">body>div.intro" in low and ">body>div.end" in low and ">body>div.body#" not in low


def test_copies_of_an_article_keep_their_text(spark):
    pages = spark.createDataFrame([(i, "http://c.org/a", ARTICLE) for i in range(30)],
                                  "page_id long, url string, html string")
    assert set(texts(extracted(pages)).values()) == {main_text(ARTICLE, frozenset())}


def test_nulls_empty_table_and_clashing_columns(spark):
    rows = [(None, None, None), (1, None, "<p>a</p>"), (2, "u", ""), (2, "u", ""), (3, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS host", "2 AS low", "3 AS id", "4 AS text")
    got = sorted(((r.id, r.url, r.text) for r in extracted(pages).collect()), key=str)
    assert got == sorted([(None, None, ""), (1, None, "a"), (2, "u", ""), (2, "u", ""), (3, "u", "")],
                         key=str)
    assert extracted(pages.limit(0)).count() == 0


def test_the_tree_judges_inside_and_outside_of_articles(spark):
    rows = [(i, f"http://t.org/{i}", "<body><article><h2>Teaser of the day</h2></article><div class='body'>"
             f"<p>Long body {i}</p><p>of page {i * 3}</p></div></body>") for i in range(12)]
    rows += [(100 + i, f"http://n.org/{i}", f"<body><article><h1>Head {i}</h1><p>Own {i}</p><p>Please accept"
              f" our terms</p><div>Own end {i}</div></article></body>") for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = texts(extracted(pages))
    assert got[3] == "Long body 3\nof page 9"
    assert got[103] == "Head 3\nOwn 3\nOwn end 3"


def test_the_tree_alone_finds_adverts_and_footers_that_change_their_words(spark, monkeypatch):
    """Without the lists of words and tags that mark such parts, over the pages at hand: on hosts with
    eight pages or more, nine in ten go, and no block of an article does."""
    import os
    import re
    from collections import Counter

    from tripledger.llm import pages as operator
    path = "/root/testdata/sf0.1/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables are not here")
    monkeypatch.setattr(operator, "MARKED", re.compile("(?!)"))
    monkeypatch.setattr(operator, "CUT", frozenset("head script style noscript template".split()))
    rows = spark.read.parquet(path)
    found = {r.page_id: r for r in rows.collect()}
    hosts = Counter(host(r.url) for r in found.values())
    junk = left = 0
    for page, text in texts(extracted(rows)).items():
        if hosts[host(found[page].url)] < 8:
            continue
        given = found[page].html
        lines = set(text.split("\n"))
        for element, block, _ in parse(given)[0]:
            if ">article" in element.path:
                assert block in lines
            elif element.path.endswith((">div.ad", ">footer")):
                junk, left = junk + 1, left + (block in lines)
    assert junk > 3000 and left < 0.1 * junk


def test_copies_count_once_whatever_their_marked_parts(spark):
    rows = [(i, f"http://c.org/{i}", f"<body><nav>{i}</nav><article><p>Same</p></article></body>")
            for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert set(texts(extracted(pages)).values()) == {"Same"}


def test_a_section_is_judged_by_its_own_pages(spark):
    rows = [(i, f"http://big.org/{i}", f"<body><article><p>Own {i}</p></article>"
             + ("<section><p>Read our offers</p></section>" if i < 12 else "") + "</body>")
            for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = texts(extracted(pages))
    assert all(got[i] == f"Own {i}" for i in range(200))
