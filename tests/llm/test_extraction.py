"""Main text of pages: what stays, what goes, and broken markup."""

import html
import re
from pathlib import Path

import pytest

from tallystrata.llm import extraction

SF = "/root/testdata/sf0.01"
LONG = "The quick brown fox was in the house of the old man and it would not go out for any of the food that he had put there."


def text(page):
    return extraction.main_text(page).replace(LONG, "LONG").split("\n")


def test_marked_parts_go():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><body class="single has-sidebar">
    <header class="site-header"><h1>Site</h1><p>{LONG}</p></header><nav><a href=x>Home</a></nav>
    <main id="main"><article class="post"><header><h1>My title</h1><p>By Ann</p></header><div class="entry-content"><p>{LONG}</p>
    <p>Short.</p><div class="ad">{LONG}</div><div class="cookieNotice">{LONG}</div><p>Again <a href=y>link</a> words.</p>
    <script>var t = "</p>";</script><form><p>{LONG}</p></form><p hidden>no</p></div><footer>Tagged</footer></article>
    <section id="comments"><article class="comment"><p>{LONG}</p></article></section></main>
    <aside><p>{LONG}</p></aside><div role="complementary">{LONG}</div><footer>&copy; x {LONG}</footer>"""
    assert text(page) == ["My title", "LONG", "Short.", "Again link words."]


def test_rules_without_any_mark():
    page = f"""<ul><li><a href=1>One</a><li><a href=2>Two</a></ul><h1>Head line</h1><p>{LONG}{LONG}<p>tiny<p>{LONG} {LONG}</p>
    <p>&copy; 2020 {LONG}</p><p>xx xy zz qq rr ss tt uu vv ww xx yy zz aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo</p><a href=x>next</a>"""
    assert text(page) == ["Head line", "LONGLONG", "tiny", "LONG LONG"]


def test_short_blocks_follow_their_nearest_neighbours():
    block = lambda t, heading=False: extraction.Block(t, 0, heading, 0)
    linked = extraction.Block("a b c", 5, False, 0)
    good = block(f"{LONG} {LONG}")
    kept = lambda *blocks: extraction.labels(list(blocks))
    assert kept(linked, block("x"), block("y"), block("z"), good) == [False, False, False, True, True]
    assert kept(good, block("x"), good, block("y"), linked, block("z"), linked) == [True, True, True, False, False, False, False]
    assert kept(linked, block("head", True), block("x"), good) == [False, True, True, True]
    assert kept(good, block("head", True), linked) == [True, False, False]
    assert kept(block("x"), block("y")) == [True, True] and kept() == []


def test_white_space_references_and_broken_markup():
    page = """<article><p title="a > b">1 < 2 &amp;&lt;b&gt; caf&eacute;&nbsp;x\t\n y</p><!-- <p>no</p> --><p>a<br>b<br> <br>c</p>
    <table><tr><td>1<td>2<tr><td>3</table><b>open <i>tags"""
    assert text(page) == ["1 < 2 &<b> café x y", "a b", "c", "1", "2", "3", "open tags"]
    assert text('<div class="ad">buy<article><h1>T</h1><p>x</article><footer>f') == ["T", "x"]
    assert text('<form><div class=menu>m</div><article><p>x</p></article></form>') == ["x"]
    assert text("<p>a</p><!-- open <p>b</p>") == ["a"] and text("<p>a</p><script>x <p>b</p>") == ["a"]
    assert text("<article><pre>x <span class='comment'># note</span></pre></article>") == ["x # note"]


def test_teasers_are_not_the_article():
    page = f"<div class=main><p>{LONG}{LONG}</p><p>{LONG}{LONG}</p></div><article><h3><a href=1>Other</a></h3><p>Teaser.</p></article>"
    assert text(page) == ["LONGLONG", "LONGLONG"]


def test_extract(spark):
    rows = [(1, "u", "<article><p>é x", 9), (1, None, None, 9), (None, "u", "", 9), (3, "u", "<nav>x</nav>", 9), (4, "u", "<p>" + "a b " * 200_000, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = extraction.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.url, r.text[:5], r.n_chars) for r in found.collect()), key=repr)
    assert got == sorted([(1, "u", "é x", 3), (1, None, "", 0), (None, "u", "", 0), (3, "u", "", 0), (4, "u", "a b a", 799_999)], key=repr)
    assert extraction.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("opener", ["<b>", "<div>", '<a title="', "<p><b>x", "<!--", "<", "<ul><li>"])
def test_hostile_markup_ends_in_time(opener):
    extraction.main_text(opener * 20_000)


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not at hand")
def test_articles_of_the_given_pages(spark):
    """Every block of the articles, and nothing else."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search("<article>(.*?)</article>", row.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert found[row.page_id] == "\n".join(b for b in blocks if b)
