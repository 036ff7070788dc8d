import html
import re

import pytest

from headwater.llm import html_text as H

LONG = "The house of the man was on the hill and it is not far from the sea, as you have said to them. " * 3


@pytest.mark.parametrize(("page", "text"), [
    (None, ""),
    ("", ""),
    ("plain  text &amp; more", "plain text & more"),
    ("<p>a&nbsp;b <i>c</i>d<br>e</p>", "a b cd e"),
    ("<article><h1>T</h1><p>x<p>y &#x41;&#66;<ul><li>one<li>two</ul></article>", "T\nx\ny AB\none\ntwo"),
    ("<nav><a href=x>m</a></nav><article><p>in</p></article><footer>f</footer>", "in"),
    ("<article><header>h</header><p>in</p><div class='user-comments'><p>no</p></div><aside>s</aside><form>f<p>g</p></form></article>", "in"),
    ("<main><p>in</p><script>if (a < b) document.write('</p>x');</script><style>p{}</style><!-- c <p>d</p> --></main>", "in"),
    ("<article><p>cut off <b>here</b> <a hre", "cut off here"),
    ("<article><p>a</p></article><div>out</div>", "a"),
    ("<div class='cookie notice'><p>We use</p></div><div role=navigation>n</div><article>x <span>y</span>z</article>", "x yz"),
    ("<head><title>t</title></head><body><div class=ad><p>buy</p><article><p>still ad</p></article></div><p>rest</p></body>", "rest"),
    (f"<div><a href=1>one two</a> <a>three</a></div><h2>Title</h2><p>{LONG}</p><p>short</p><div><a>x y z</a></div>", f"Title\n{LONG.strip()}\nshort"),
    ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ("<article><p>a &lt;b&gt; &copy &unknown;</p></article>", "a <b> © &unknown;"),
    ("<article><p title='a > b'>x</p><p>y", "x\ny"),
])
def test_pages(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<div class='content-sidebar-wrap'><p>no</p><article><p>in</p></article></div>", "in"),
    ("<main class='no-sidebar'><article class='category-social'><p>in</p></article></main>", "in"),
    ("<body><article class='post related'><p>in</p></article><div class='user-comments'><p>no</p></div></body>", "in"),
    (f"<article><p>teaser</p></article><div><p>{LONG}</p><p>short</p></div><footer>f</footer>", f"teaser\n{LONG.strip()}\nshort"),
    (f"<article><p>a</p></article><aside><p>{LONG}</p></aside><div class=sidebar><p>{LONG}</p></div>", "a"),
])
def test_words_do_not_reject_articles_nor_articles_other_text(page, text):
    assert H.main_text(page) == text


def test_open_blocks_take_the_nearest_label():
    blocks = [H.Block("x", 0, tag, H.OPEN) for tag in ("p", "p", "h2", "p", "p")]
    assert H.second_pass(blocks, [1, 0, 0, 0, -1]) == [1, 1, -1, -1, -1]
    assert H.second_pass(blocks, [-1, 0, 1, 0, -1]) == [-1, -1, 1, 1, -1]
    assert H.second_pass(blocks, [0] * 5) == [1] * 5


def test_whole_table(spark, sf_dir):
    rows = H.op6_html_extraction(spark, sf_dir).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"(?s)<article>(.*?)</article>", pages[r.page_id])[1]
        pieces = re.split(r"</?(?:p|h1)>", re.sub(r"</?(?:b|i|a)\b[^>]*>|<br>", " ", inside))
        expected = [" ".join(html.unescape(p).split()) for p in pieces]
        assert r.text == "\n".join(p for p in expected if p)
        assert r.n_chars == len(r.text)


def test_other_columns_stay_and_clashing_ones_go(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "old", 7), (2, None, None, None, None)], "page_id long, url string, html string, text string, tag int")
    assert sorted(tuple(r) for r in H.extract(pages).select("page_id", "url", "tag", "text", "n_chars").fillna("-").collect()) == [(1, "u", 7, "a", 1), (2, "-", None, "", 0)]
    assert H.extract(pages.limit(0)).count() == 0


def test_quotes_open_values_only_after_equals():
    assert H.main_text("<article><p class=it's>One two three</p><p>Four don't five</p><p>Six</p></article>") == "One two three\nFour don't five\nSix"
    assert H.main_text('<p title="x>Hello</p>') == "Hello"
    assert H.main_text("<p 5\">One</p><p title = 'a > b' x=\"c > 'd\">Two</p><p a==\"e\">Three</p>") == "One\nTwo\nThree"
    assert H.main_text("<p " + "=  " * 200_000 + ">One</p>") == "One"
