import html
import re

import pytest

from layerspark.llm import htmltext


def test_articles_of_the_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in htmltext.extract(pages).collect()}
    for r in pages.collect():
        article = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        want = "\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


LONG = "Words of the story go on and on in this paragraph, as they do. " * 6


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("<", "<"),
        ("<p", ""),
        ("<p>one<p>two &lt;&nbsp;&amp; x<br>y", "one\ntwo < & x y"),
        ("a<b>c</b>d", "acd"),
        ("<script>var t='</p>'</script><style>p{}</style><p>x</p>", "x"),
        ("<p>a<!-- <p>no</p> --> b</p>", "a b"),
        ("<p title='a>b'>x</p>", "x"),
        ("<ul><li>one<li>two</ul>", "one\ntwo"),
        ("<article><header><h1>T</h1></header><p>x</p></article><header>site</header>", "T\nx"),
        (f"<article><p>{LONG}</p></article><div class='comments'><p>{LONG}</p></div>", LONG.strip()),
        (f"<article><p>x</p></article><div id=cookie-notice>{LONG}</div><form>{LONG}</form>", "x"),
        (f"<body><div><a href=1>one link</a> <a href=2>two link</a></div><div><p>{LONG}</p><p>x</p></div>", LONG.strip() + "\nx"),
        (f"<body><div class=shadow><p>{LONG}</p></div>", LONG.strip()),
    ],
)
def test_small_pages(page, want):
    assert htmltext.main_text(page) == want


def test_long_and_broken_pages_end():
    assert htmltext.main_text("<div>" * 2000 + "x") == "x"
    assert htmltext.main_text("<a " * 20_000) == ""
    assert htmltext.main_text("<b>" * 20_000 + "t") == "t"
    assert htmltext.main_text("<article>" + "<p>word</p>" * 20_000) == "\n".join(["word"] * 20_000)


def test_density_by_definition():
    tree = htmltext.parse("<body><p>abcd</p><p>ab <b>cd</b></p></body>")
    own, sums = htmltext.densities(tree)
    at = {t: i for i, t in enumerate(tree.tag)}
    assert own[at["body"]] == 8 / 3 and sums[at["body"]] == 8 and own[at["b"]] == 2


def test_nulls_repeats_and_clashes(spark):
    schema = "page_id long, url string, html string, text int, n_chars int"
    rows = [(1, None, None, 1, 1), (1, None, None, 1, 1), (None, "u", "<p>é</p>", None, None)]
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in htmltext.extract(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, "u", "é", 1), (1, None, "", 0), (1, None, "", 0)]
    assert htmltext.extract(spark.createDataFrame([], schema)).count() == 0
