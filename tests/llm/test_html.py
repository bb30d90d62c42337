"""Main text of pages: planted articles, furniture, malformed markup."""

import random

import pytest

from sluice.llm import html

LONG = "The quick report of the day is that the river was high and the bridge had to be closed for the night by the city."
ARTICLE = f"<article><h1>A title &amp; more</h1><p>{LONG}</p><p>Short.</p><p>{LONG}  <b>Bold\n text</b><br>next</p></article>"
WANT = f"A title & more\n{LONG}\nShort.\n{LONG} Bold text next"
FURNITURE = [
    "<nav><ul><li><a href=/>Home</a></li><li><a href=/x>News of the day and the week</a></li></ul></nav>",
    f"<header><p>{LONG}</p></header>", f"<footer>&copy; {LONG}</footer>", f"<aside><p>{LONG}</p></aside>",
    f'<div class="ad">{LONG}</div>', f'<div id="cookie-notice"><p>{LONG}</p></div>', f"<form><p>{LONG}</p><input></form>",
    f'<script>var t="<p>{LONG}</p>";</script>', f"<style>p:after{{content:'{LONG}'}}</style>", f"<!-- {LONG} -->",
    f'<section class="comments"><article class="comment"><p>{LONG}</p></article></section>',
    f'<div role="complementary"><p>{LONG}</p></div>', f'<div class="sideBar"><p>{LONG}</p></div>',
    f"<noscript><p>{LONG}</p></noscript>", f'<p hidden>{LONG}</p>',
]


@pytest.mark.parametrize("piece", FURNITURE)
def test_furniture_goes(piece):
    for page in (f"<body>{piece}{ARTICLE}</body>", f"<body>{ARTICLE}{piece}</body>"):
        assert html.main_text(f"<html><head><title>T</title></head>{page}</html>") == WANT


def test_furniture_inside_the_article_goes():
    for piece in FURNITURE[4:8]:
        page = ARTICLE.replace("<p>Short.", piece + "<p>Short.")
        assert html.main_text(page) == WANT


WRAPPERS = [
    "<main class='has-sidebar'>{}</main>", "<div id='page' class='right-sidebar'>{}</div>", "<form id=aspnetForm>{}</form>",
    "<div class='site-header-fixed widgets'>{}</div>", "<section class='related newsletter'>{}</section>",
    "<div id='comments-open' class='post'><div class='social'>{}</div></div>", "<body class='modal-open'><div class='nav-menu'>{}</div></body>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_wrappers_do_not_swallow_the_article(wrapper):
    assert html.main_text(wrapper.format(ARTICLE)) == WANT
    assert html.main_text(wrapper.format(FURNITURE[0] + ARTICLE + FURNITURE[4])) == WANT
    inside = ARTICLE.replace("<article>", "<article class='post has-sidebar social-history tags'>")
    assert html.main_text(wrapper.format(inside)) == WANT
    plain = wrapper.format(f"<p>{LONG}</p><p>{LONG}</p>")
    if "main" not in wrapper:  # without a marked article: what holds the text is no furniture
        assert html.main_text(f"<html>{plain}</html>") == f"{LONG}\n{LONG}"


def test_hints_count_beside_an_article_that_stands_free():
    comments = f"<div class='comments'><article><p>{LONG * 5}</p></article><article class='comment'>{LONG}</article></div>"
    assert html.main_text(f"<body>{ARTICLE}{comments}</body>") == WANT
    teaser = f"<article class='related-post'><p>{LONG}</p></article>"
    assert html.main_text(f"<body>{teaser}{ARTICLE}</body>") == WANT
    page = f"<body><div><p>{LONG}</p><p>{LONG}</p></div><section class='comments'><article class='comment'>{LONG}</article></section></body>"
    assert html.main_text(page) == f"{LONG}\n{LONG}"


def test_many_open_elements_take_linear_time():
    import time

    for unit in ("<div>", "<b>", "<p><i>", "<a><b></i>", "<li>", "<td></p>", "<form class=nav>"):
        began = time.perf_counter()
        html.main_text(unit * 100_000 + "text")
        assert time.perf_counter() - began < 6, unit


@pytest.mark.parametrize("text", [
    "Het kabinet heeft vrijdag besloten dat gemeenten volgend jaar meer geld krijgen, al blijft onduidelijk hoeveel precies. Burgemeesters reageerden verheugd, maar waarschuwden voor tekorten.",
    "Правительство объявило, что строительство моста начнётся весной, если позволит погода. Жители города давно ждали этого решения, сообщила мэрия вчера вечером на встрече.",
])
def test_sentences_of_other_languages(text):
    assert html.main_text(f"<body><div><p>{text}</p><p>{text}</p></div></body>") == f"{text}\n{text}"


def test_random_pages():
    rng = random.Random(1)
    for _ in range(60):
        around = rng.sample(FURNITURE, 4)
        page = f"<!DOCTYPE html><html><body>{''.join(around[:2])}{ARTICLE}{''.join(around[2:])}</body></html>"
        assert html.main_text(page) == WANT
        cut = rng.randrange(len(page))
        for line in html.main_text(page[:cut]).split("\n")[:-1]:  # a page cut off: whole blocks stay right
            assert line in WANT or line in LONG


def test_malformed_markup():
    assert html.main_text("<article><p><b>One open bold.<br><p>Two <i>open</p><p>Three</article><p>after") == "One open bold.\nTwo open\nThree"
    assert html.main_text(f"<article><p>{LONG} a < b &lt;tag&gt; &#233;&eacute;&nbsp;x &unknown; &am") == f"{LONG} a < b <tag> éé x &unknown; &am"
    assert html.main_text(f"<article><p>{LONG}</p><p class='x") == LONG
    assert html.main_text(f'<article><p title="a > b">{LONG}</p></article>') == LONG
    assert html.main_text(f"<ARTICLE><P>{LONG}</P></ARTICLE>") == LONG


def test_pages_without_article_use_the_rules():
    links = "".join(f"<li><a href=/{i}>link number {i} to a page of the site</a></li>" for i in range(5))
    page = f"<body><ul>{links}</ul><div><p>{LONG}</p><p>Short one.</p><p>{LONG}</p></div><p>xyzzy</p><ul>{links}</ul></body>"
    assert html.main_text(page) == f"{LONG}\nShort one.\n{LONG}\nxyzzy"  # the last short block: nearest decided neighbours disagree, the good one counts
    assert html.main_text(f"<body><ul>{links}</ul></body>") == ""


def test_rows(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", ARTICLE), (3, "u", ARTICLE), (None, None, "<article>é</article>"), (4, "u", "<p>" * 20_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'mine' as n_chars", "'mine' as row")
    got = html.extract(df, keep=["page_id", "url", "row", "n_chars"]).collect()
    assert [(r["page_id"], r["text"], r["n_chars"], r["row"]) for r in got] == [
        (1, "", 0, "mine"), (2, "", 0, "mine"), (3, WANT, len(WANT), "mine"), (3, WANT, len(WANT), "mine"),
        (None, "é", 1, "mine"), (4, "", 0, "mine"),
    ]
    assert html.extract(df.limit(0)).collect() == []
