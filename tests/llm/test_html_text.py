"""Main text of pages of several layouts, and of odd input."""

import random
import re
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from paddock.llm import html_text

PARAGRAPH = "This is the text of an article that is about the thing and it was written for all of the people in the town by the one who was there."


def page(body):
    return f'<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{a:b}}</style><script>var t="</p>";</script></head><body>{body}</body></html>'


@pytest.mark.parametrize(
    "body, want",
    [
        ("<nav><ul><li><a href=x>Home</a></li></ul></nav><article><h1>A  title</h1><p><b>One.<br><p>Two &amp; three</p></article><footer>&copy; x</footer>", "A title\nOne.\nTwo & three"),
        (f"<div class='menu'><a>Home</a></div><div><h1>Title here</h1><p>{PARAGRAPH}<p>Short.<p>{PARAGRAPH}</div><div id=comments><p>{PARAGRAPH}</p></div>", f"Title here\n{PARAGRAPH}\nShort.\n{PARAGRAPH}"),
        (f"<main><header><h1>Head</h1></header><p>{PARAGRAPH}</p><aside>Aside</aside><form><p>Name</p><input></form><div class='cookie-notice'>We use</div></main>", f"Head\n{PARAGRAPH}"),
        ("<article><p>a&nbsp;b\n\t c</p><ul><li>x<li>y</ul><pre>k  l</pre></article>", "a b c\nx\ny\nk l"),
        ("<article><p>1 &lt; 2 <!-- no <p> --> &#233;</p><section class='comments'><p>Nice</p></section></article>", "1 < 2 é"),
        ("<p><a href=x>Only</a> <a>links</a></p>", ""),
        ("<article><p>cut in the mid", "cut in the mid"),
        (f"<article><p>whole</p><p class='x", "whole"),
    ],
)
def test_layouts(body, want):
    assert html_text.main_text(page(body)) == want


FOREIGN = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw, są oni obdarzeni rozumem oraz sumieniem i powinni postępować wobec innych w duchu braterstwa."
CARD = "<article class='card'><h3>Other</h3><p>Teaser.</p></article>"


@pytest.mark.parametrize(
    "body, kept, gone",
    [
        # the body stands outside the only article, which is a card or a comment
        (f"<div><h1>Title</h1><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><div><a href=x>More</a></div>{CARD}", ["Title", PARAGRAPH, PARAGRAPH], []),
        (f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><article class='comment'><p>Mine: {PARAGRAPH}</p></article>", [PARAGRAPH, PARAGRAPH], ["Mine"]),
        # text and link rules inside an article; its title may be a link
        (f"<article><h1><a href=x>Title</a></h1><p>{PARAGRAPH}</p><p>Short.</p><ul><li><a href=x>Elsewhere</a></li></ul></article>", ["Title", PARAGRAPH, "Short."], ["Elsewhere"]),
        # no list of stop words fits
        (f"<div><a href=x>Menu</a></div><div><p>{FOREIGN}</p><p>{FOREIGN}</p></div>", [FOREIGN, FOREIGN], ["Menu"]),
    ],
)
def test_text_decides_before_the_article_element(body, kept, gone):
    got = html_text.main_text(page(body)).split("\n")
    assert [line for line in got if line in kept] == kept
    assert not any(word in line for word in gone for line in got)


def test_odd_pages_take_linear_time():
    for text in ("<b>" * 100_000, "<div>" * 100_000, "</p>" * 100_000, "<" * 100_000, "<a href=\"" * 20_000, "<!--" * 50_000, "&" * 100_000):
        html_text.main_text(text)


@pytest.mark.parametrize(
    "body, want",
    [
        (f"<article><h2 id='related-work'>Related work</h2><p>{PARAGRAPH}</p><section id='search-algorithms'><h3>Search</h3><p>Brief.</p></section></article>", f"Related work\n{PARAGRAPH}\nSearch\nBrief."),
        (f"<article><p>{PARAGRAPH}</p><div class='legal-aspects'><h3>Legal</h3><p>{PARAGRAPH}</p></div></article>", f"{PARAGRAPH}\nLegal\n{PARAGRAPH}"),
        (f"<div class='layout sidebar-left'><div class='col side-by-side'><h1>Title</h1><p>{PARAGRAPH}</p></div><div class='sidebar'>Aside</div></div>", f"Title\n{PARAGRAPH}"),
        (f"<div class='layout sidebar-left'><article><p>Short.</p></article></div><footer>&copy; x</footer>", "Short."),
        (f"<article><p>{PARAGRAPH}</p><div class='share-buttons'>Tell others</div><div id='comments'><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div></article>", PARAGRAPH),
    ],
)
def test_hints_do_not_decide_alone(body, want):
    assert html_text.main_text(page(body)) == want


def test_deep_hints_take_linear_time():
    for text in ("<div class=sidebar>x" * 50_000, "<div class=related-work>x" * 50_000, "<article><article class=comment>x" * 30_000):
        html_text.main_text(text)


def _inherit(first, mains=None, apart=None, sizes=None, loose=frozenset()):
    n = len(first)
    return html_text._inherit(first, mains or [-1] * n, apart or [False] * n, sizes or [100] * n, loose)


def test_neighbours():
    good, bad, open_ = html_text.GOOD, html_text.BAD, html_text.OPEN
    assert _inherit([open_, good, open_, open_, open_, bad, open_]) == [1, 1, 1, 1, 0, 0, 0]
    assert _inherit([open_, open_]) == [0, 0]
    # an article is a border for both sides, and bad neighbours in it count as farther away
    mains = [-1, -1, 0, 0, 0, 0, 0, -1]
    assert _inherit([bad, open_, good, open_, open_, open_, bad, open_], mains) == [0, 0, 1, 1, 1, 1, 0, 0]
    assert _inherit([good, open_, open_, open_, open_, bad, open_, open_], [-1, 0, 0, 0, 0, 0, 0, -1])[1:] == [0, 0, 0, 0, 0, 0, 0]
    # a menu inside an article says nothing about its text
    assert _inherit([bad, open_, good], [0, 0, 0], [True, False, False]) == [0, 1, 1]
    assert _inherit([open_, bad], [0, -1]) == [1, 0]


@pytest.mark.parametrize("seed", range(30))
def test_neighbours_against_a_plain_search(seed):
    chance = random.Random(seed)
    n = chance.randrange(1, 40)
    first = [chance.choice([1, 0, None, None]) for _ in range(n)]
    got = _inherit(first)
    for i, f in enumerate(first):
        near = sorted((abs(i - j), -g) for j, g in enumerate(first) if g is not None)
        assert got[i] == (f if f is not None else -near[0][1] if near else 0)


@pytest.mark.parametrize(
    "body, want",
    [
        ("<p title=5\">One two</p><p class=\"b\">Three</p>", "One two\nThree"),
        ("<p title=it's>One</p><p title='>'>Two</p><p title=\"a>b\" x='y'>Three</p>", "One\nTwo\nThree"),
        ("<p title = \"a>b\">One</p><p a=b=\"c>Two</p><p \"x\" y>Three</p><p =\">Four</p>", "One\nTwo\nThree\nFour"),
        ("<p data-class=\"footer\" title=\"a class=sidebar here\">One</p><p data-hidden=1>Two</p><p hidden>Gone</p>", "One\nTwo"),
        ("<p title='whole page", ""),
    ],
)
def test_quotes_in_attributes(body, want):
    assert html_text.main_text(page(f"<article>{body}</article>")) == want


def test_attributes_take_linear_time():
    for text in ("<p " + "a=" * 200_000, "<p " + "a= " * 100_000 + ">", "<p a" + " " * 200_000, "<p " + "'" * 200_001, "<p =" * 100_000, "<p a='" * 50_000):
        html_text.main_text(text)


def _same_words(one, other):
    a, b = Counter(one.split()), Counter(other.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.mark.skipif(not Path("/root/testdata/sf0.01/pages.parquet").exists(), reason="test tables are not here")
def test_pages_without_their_article_element(monkeypatch):
    """With the element's name changed the rules and neighbours find nearly the same text; both passes decide blocks."""
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    inherited, inherit = [0], html_text._inherit

    def counted(first, *rest):
        inherited[0] += sum(f is None for f in first)
        return inherit(first, *rest)

    monkeypatch.setattr(html_text, "_inherit", counted)
    with_element = [html_text.main_text(p) for p in pages]
    assert inherited[0] > 2 * len(pages)
    without = [html_text.main_text(re.sub(r"<(/?)(?:article|main)\b", r"<\1div", p)) for p in pages]
    found = [_same_words(a, b) for a, b in zip(with_element, without)]
    assert sum(found) / len(found) > 0.9


def test_columns(spark):
    rows = [(1, "u", "<article><p>é x</p></article>", "a"), (1, "u", "<article><p>é x</p></article>", "a"), (None, None, None, None), (2, "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, TEXT string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0), (2, "", "", 0)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0
