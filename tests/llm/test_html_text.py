import html
import re

import pytest

from sojourn.llm.html_text import BlockRules, extract, main_text

PAGE = """<html><head><title>T</title><script>if (a < b) x = "</div>"; </script></head><body>
<header class="top"><h1>Site</h1><a href=x>Home</a></header>
<nav><a>one</a><a>two</a></nav><div class="cookie-notice">Cookies are used on this site and you have to accept them all right now before reading on.</div>
<div id=content><h2>Head</h2>
<p>This is the first long paragraph of the text that is in the main part of the page, and it has many of the words that are in the list.</p>
<p>Short.</p>
<p>Another one of the long paragraphs with the words that are in the list of stop words and it is long enough to be good at once.</p></div>
<div class="comments"><p>I think that this is the best of all the comments that have been written on the page so far and it is long enough.</p></div>
<form><p>Enter your name in the field and then press the button to be a part of it all.</p></form><footer>c &copy; 2020</footer></body></html>"""


def article_of(page):
    """What the given tables hold between article tags, block by block."""
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages_give_exactly_their_articles(spark):
    from sojourn.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def given_pages():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    return pages, [article_of(x) for x in pages]


def test_given_pages_without_the_element():
    """The rules find the text by itself, too; what they lose has no stop word in it or is a line or two."""
    pages, articles = given_pages()
    found = [main_text(x.replace("<article>", "<div>").replace("</article>", "</div>")) for x in pages]
    assert sum(a == b for a, b in zip(articles, found, strict=True)) >= 0.95 * len(pages)


@pytest.mark.parametrize(
    "rules, inside", [(BlockRules(stop_density=5, long_chars=10**6), True), (BlockRules(stop_density=5), False), (BlockRules(short_chars=10**6), False),
                      (BlockRules(long_chars=10**6), False), (BlockRules(good=9), False), (BlockRules(link_density=-1), False)]
)
def test_thresholds_decide(rules, inside):
    """Inside an article, too, text is judged; outside every threshold counts."""
    pages, _ = given_pages()
    if not inside:
        pages = [x.replace("<article>", "<div>").replace("</article>", "</div>") for x in pages]
    assert sum(main_text(x) != main_text(x, rules) for x in pages) > 0.1 * len(pages)


def test_a_heading_goes_with_what_it_introduces():
    good = "<p>" + "the words of a text that is long and has many of them in it " * 3 + "</p>"
    links = "<p>" + "".join(f"<a href=x>link number {k}</a> " for k in range(9)) + "</p>"
    advert = "<div class=ad>Buy it now</div>"
    kept = main_text(f"{links}<h2>Text</h2>{good}{advert}<p>Short.</p>{advert}{good}<h2>Links</h2>{links}").split("\n")
    assert kept[0] == "Text" and "Short." in kept and "Links" not in kept and "Buy it now" not in kept


def test_a_page_without_article_element():
    lines = main_text(PAGE).split("\n")
    assert [x[:12] for x in lines] == ["Head", "This is the ", "Short.", "Another one "]


def test_parts_of_an_article_that_are_not_text():
    page = (
        "<body><nav><p>menu <article class='post'><header><h1>Title</h1></header><p>One &amp; two&nbsp;three.</p>"
        "<div class='advert'>Buy the best of it now</div><aside>More</aside><!-- <p>no</p> --><style>p{}</style>"
        "<p>a < b<br>c</p><section class=comments><article class=comment><p>The comment of a reader that is of no use to you</p></article>"
        "</section><footer>By me</footer></article><footer>End"
    )
    assert main_text(page) == "Title\nOne & two three.\na < b c"


def test_references_and_broken_markup():
    assert main_text("<p>a &lt; b < c &amp d &#233;&#x41;</p>") == "a < b < c & d éA"
    assert main_text("<article><p title='a > b'>x</p><p unclosed") == "x"
    assert main_text("<article><p>x</p><script>never closed <p>y</p>") == "x"
    assert main_text("<article><p>x</p><!-- never closed <p>y</p>") == "x"
    assert main_text("plain text only") == "plain text only"
    assert main_text("<p></p>") == "" and main_text("") == "" and main_text(None) == ""


def test_short_blocks_follow_their_neighbours():
    good = "<p>" + "the words of a text that is long and has many of them in it " * 3 + "</p>"
    links = "<p>" + "".join(f"<a href=x>link number {k}</a> " for k in range(9)) + "</p>"
    kept = main_text(f"{good}<p>near good</p>{good}{links}<p>near bad</p>{links}").split("\n")
    assert "near good" in kept and "near bad" not in kept and len(kept) == 3


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "", ""), (None, "u", "<p>the one of it</p>", "", ""), (2, "u", "", "", ""), (2, "u", "", "", ""), (3, "u", "<article><p>" + "w " * 300_000, "", "")]
    got = extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, len("the one of it")), (1, 0), (2, 0), (2, 0), (3, 599_999)]
    assert extract(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize(
    "attributes, shown",
    [
        ('data-overflow="hidden"', True),
        ('title="the hidden truth"', True),
        ("onclick=\"this.style.visibility='hidden'\"", True),
        ('data-hidden data-id="sidebar" data-role="menu" data-class=ads', True),
        ('title="a style=display:none b" aria-hidden="false"', True),
        ("hidden", False),
        ('title=x HIDDEN=""', False),
        ('aria-hidden = "true"', False),
        ("title='a \"b\"' style='display: none'", False),
        ("class=ads", False),
    ],
)
def test_only_whole_attribute_names_count(attributes, shown):
    text = "this is the text of the page and it is long enough to be kept by the rules as it has many of the words that they look for, and more of them"
    assert main_text(f"<html><body><div {attributes}><p>{text}</p></div></body></html>") == (text if shown else "")
