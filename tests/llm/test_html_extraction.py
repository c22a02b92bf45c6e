"""Main texts: hand-made pages, consensus of a host, the test table against its article elements."""

import html
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import html_extraction as he

LONG = "This is a sentence of the article, long enough to be no menu entry. "


def own(page):
    return he.extract(page, {})


@pytest.mark.parametrize("page, text", [
    ("", ""),
    ("<html><body></body></html>", ""),
    ("plain words", "plain words"),
    ("<p>one<p>two  \n three", "one\ntwo three"),
    ("<article><h1>Head</h1><p><b>Bold.<br><p>Next &amp; last&nbsp;one</article>", "Head\nBold.\nNext & last one"),
    ("<p>a &lt;b&gt; &#x41;&#66; &copy &unknown; 1 < 2 > 0", "a <b> AB © &unknown; 1 < 2 > 0"),
    ('<p title="a > b">x</p><p title=\'"\'>y</p><p a=b>z', "x\ny\nz"),
    ("<!-- <p>no</p> --><p>yes</p><!-->seen<!--->too<!-- open <p>no", "yes\nseentoo"),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes</p><noscript>no</noscript>", "yes"),
    ("<title>no</title><textarea>no</textarea><p>yes", "yes"),
    ("<ul><li>first<li>second</ul>", "first\nsecond"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ("<p>one<br>two<wbr>three", "one twothree"),
    ("<p>日本語　\U0001f600</p>", "日本語 \U0001f600"),
    ("<p>cut off <b", "cut off"),
    ("</div></p></article><p>stray ends</div>", "stray ends"),
    ("<div hidden>no</div><div style='display: none'>no</div><div aria-hidden=true>no</div><p>yes", "yes"),
])
def test_small_pages(page, text):
    assert own(page) == text


FRAMES = {
    "article": "<nav><a href=/>Home page of this site</a></nav><header><h1>Site</h1></header><article>{}</article><footer>All rights are with us, as they always were.</footer>",
    "classes": "<div class='top-nav menu'>" + "Go there now. " * 9 + "</div><div id=wrap><div class='post-17 entry-content'>{}</div><div class='sidebar-right'><p>"
               + LONG * 4 + "</p></div></div><div id=cookieNotice><p>" + LONG * 6 + "</p></div>",
    "main": "<header class=masthead>Name</header><main>{}<aside>" + LONG * 3 + "</aside><form>" + LONG * 5 + "<button>ok</button></form></main>",
    "comments": "<div class=story>{}<section id='comments'><h2>Comments</h2>" + ("<div class=comment><p>" + LONG * 2 + "</p></div>") * 9 + "</section></div>",
    "adverts": "<body class='has-sidebar'><div role=banner>Name</div><div class='layout no-sidebar'>{}<div class=ad-slot><p>" + LONG * 2
               + "</p></div><ins class=adsbygoogle>" + LONG + "</ins></div>",
    "tables": "<table><tr><td class=left><a href=a>one place</a><br><a href=b>other place</a></td><td class=right>{}</td></tr></table>",
    "bare": "<body><nav>x</nav>{}<footer>y</footer>",
    "role": "<div><div role=navigation>" + "Go there now. " * 9 + "</div><div role=main>{}</div><div role=contentinfo>" + LONG * 9 + "</div></div>",
    "deep": "<div><div><div><section><div class=c1>{}</div></section></div></div></div>",
    "subjects": "<article class='post-9 post type-post category-cookies tag-social-media tag-ads'>{}</article><div class='comment-list'><article class='comment-body'>" + LONG * 9 + "</article></div>",
    "media": "<main class='search results'>{}<video controls>Your browser cannot play this. " + LONG + "</video><div class='alert alert-info'>" + LONG + "</div></main>",
    "links": "<div class=content>{}<ul><li><a href=1>Other news of today</a><li><a href=2>More news of the week</a><li><a href=3>All</a></ul></div>",
}


@pytest.mark.parametrize("frame", FRAMES)
def test_the_article_in_its_frame(frame):
    body = "<h1>The title</h1>" + "".join(f"<p>{LONG}{i}</p>" for i in range(6)) + f"<ul><li>{LONG}<li>short</ul>"
    want = "\n".join(["The title", *[f"{LONG}{i}" for i in range(6)], LONG.strip(), "short"])
    assert own("<!DOCTYPE html><html><head><title>t</title></head>" + FRAMES[frame].format(body)) == want


def test_sections_belong_to_their_article():
    parts = "".join(f"<section><h2>Part {i}</h2><p>{LONG * 3}</p></section>" for i in range(3))
    got = own(f"<div><article><h1>Title</h1>{parts}</article><footer>{LONG}</footer></div>").split("\n")
    assert got[:2] == ["Title", "Part 0"] and len(got) == 7


def test_headings_of_an_article_header_stay_and_the_rest_goes():
    page = f"<article><header><h1>Title</h1><div class=share>Share it</div></header><p>{LONG}</p></article>"
    assert own(page) == "Title\n" + LONG.strip()


def test_a_title_beside_the_container_is_taken():
    page = f"<div><h1>Title</h1><div class=text><p>{LONG * 9}</p><p>{LONG * 9}</p></div></div>"
    assert own(page).startswith("Title\nThis is")


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "x", "<p><button>" + "<div>" * 50_000 + "x", "<a><div>" + "<span>" * 50_000 + "</a>" * 50_000 + "x",
    "<li><ul>" + "<div>" * 30_000 + "<li></li>" * 30_000 + "x", '<a href="' * 50_000, "<" * 50_000, "<!--" * 50_000,
    "<table><tr><td>" * 30_000 + "x", "&amp;" * 100_000, "word " * 500_000,
])
def test_odd_nesting_ends_and_loses_no_text(page):
    text = own(page)
    if page.endswith("x"):
        assert text == "x"


def test_the_host_decides_where_a_page_misleads(spark):
    """On one page of the host a box on other matters is longer than the article; votes of the others find the article."""
    normal = f"<div class=box><p>Buy.</p></div><div class=text9><p>{LONG * 5}</p></div>"
    odd = f"<div class=box><p>{LONG * 9}</p></div><div class=text7><p>The real text.</p></div>"
    rows = [(i, "http://A.example/x", normal) for i in range(20)] + [(99, "https://user@a.EXAMPLE:80/y", odd), (100, "http://b.example/", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in he.main_text(pages).collect()}
    assert got[99] == "The real text." and got[0] == (LONG * 5).strip() and got[100] == (LONG * 9).strip()
    paths = {(r.host, r.label): round(r.votes, 3) for r in he.host_paths(pages).collect()}
    assert paths == {("a.example", "div.text0"): 0.952, ("a.example", "div.box"): 0.048, ("b.example", "div.box"): 1.0}


def test_both_ways_of_meeting_the_paths_agree(spark):
    rows = [(i, f"http://h{i % 7}.example/", f"<nav>no</nav><div class=k{'abc'[i % 3]}><p>{LONG}{i}</p></div>") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    one = sorted(map(tuple, he.main_text(pages).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, he.main_text(pages).collect())) == one
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(one) == 200


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "not an address", ""), (2, "http://x.example", f"<p>{LONG}</p>"), (2, "http://x.example", f"<p>{LONG}</p>"),
            (3, "//x.example/p", "\x00 ￾ <p>odd"), (4, "", "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.selectExpr("*", "'c' AS host", "'c' AS paths", "'c' AS text", "'c' AS n_chars", "'c' AS votes", "'c' AS path", "'c' AS label")
    got = he.main_text(clash).collect()
    assert len(got) == 7 and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    by_id = {r.page_id: r for r in got}
    assert (by_id[1].text, by_id[1].n_chars, by_id[None].text) == ("", 0, "")
    assert by_id[2].text == LONG.strip() and by_id[4].n_chars == 999_999
    assert he.main_text(pages.limit(0)).count() == 0


def test_the_whole_table_against_its_article_elements(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in he.main_text(pages).collect()}
    rows = pages.filter(F.col("html").isNotNull()).collect()
    assert len(got) == pages.count()
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[r.page_id].text == "\n".join(p for p in parts if p)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_titles_in_the_header_of_an_article():
    body = f"<div class=entry-content><p>{LONG * 4}</p><p>{LONG * 4}</p></div>"
    entry = "<div id=page><header class=site-header><h1>Site</h1></header><div id=content><article><header class=entry-header><h1>Title</h1>" \
            "<div class=share>Share</div></header>" + body + "</article></div></div>"
    assert own(entry).split("\n")[0] == "Title" and "Share" not in own(entry)
    # the name of a site is no title
    assert own("<div id=page><header><h1>Site</h1></header>" + body + "</div>").startswith("This is")


def test_cells_of_a_frame_are_left_out():
    page = f"<table><tr><td colspan=2><a href=/>Home</a> | <a href=/b>About us</a></td></tr><tr><td><a href=1>One</a><br><a href=2>Two</a></td>" \
           f"<td><h1>Title</h1><p>{LONG * 3}<p>{LONG * 2}</td></tr><tr><td colspan=2>Copyright 2020 Example company</td></tr></table>"
    assert own(page) == "\n".join(["Title", (LONG * 3).strip(), (LONG * 2).strip()])
