"""Main text of web pages by block rules in two passes.

First pass: stop-word density, length and link density decide every block that
does not stand in a menu, footer, form or the like. Names in classes and ids are
hints: outside an article a plain one decides, inside it, or beside other words,
it only asks for more of the text; an element with most of the page's text is
never decided by a hint. Second pass: blocks that stayed open take the label of
their nearest decided neighbours; an article element is a border of that search,
and inside it bad neighbours count as farther away. The stop words
are those of a fixed list per language; where a page fits none of them, length
and link density decide alone.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from paddock.llm.common import arrow_map, pick

# Frequent function words of the languages of the corpus.
STOP_WORDS = {
    "en": "the of and a to in is was it for on with as be by at that this from are an or not have which".split(),
    "de": "der die das und in zu den von mit ist im für auf des dem nicht ein eine als auch es an sich".split(),
    "fr": "le la les de des du et en un une est pour que qui dans par sur au plus ne pas ce il".split(),
    "es": "el la los las de del y en que un una es por con para su al se no lo como más".split(),
}
_STOPS: dict[str, list[str]] = {}
for _lang, _list in STOP_WORDS.items():
    for _word in _list:
        _STOPS.setdefault(_word, []).append(_lang)

# Element names by their part in a page.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title select textarea".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
APART = frozenset("nav header footer aside form menu dialog button fieldset".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements that some pages put around all of their text.
WRAPPERS = frozenset("form dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul caption option legend".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}
_HINT = re.compile(
    r"(?:^|\s)(?:(?:site|page|top|main|global)[_-]?)?header(?:$|\s)|"
    r"(?:^|[\s_-])(?<!has[_-])(?<!with[_-])(?<!no[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|widget\w*|footer\w*|"
    r"masthead|comments?|respond|replies|disqus|cookies?|consent|gdpr|notice\w*|popup|modal|newsletter|subscribe|"
    r"signup|share|sharing|social|related|recommended|login|search|pagination|pager|toolbar|copyright|legal)(?:$|[\s_-])",
    re.I,
)
# Words that leave a hint plain when they stand beside it in one name.
_PLAIN = frozenset(
    "site page top main global left right bottom inner outer wrapper wrap container box bar list item items area section "
    "block content link links icon icons button buttons post posts article articles primary secondary text body form "
    "title header head col row group panel module space".split()
)
_COMMENTS = frozenset("comment comments respond replies disqus".split())
_PARTS = re.compile(r"[_-]+|(?<=\D)(?=\d)")
_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

# A quote opens a value only behind an equals sign; elsewhere it is a character like others.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    r"((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?|=)*+)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"(=?[^\s=/>]++)(?:\s*+=\s*+(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?", re.S)
_ATTRIBUTES = frozenset("class id role hidden style".split())
_SAYS = re.compile("class|id|role|hidden|style", re.I)
_WORD = re.compile(r"\w+")
# Characters of scripts that say in one what others say in about three.
_DENSE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")

#: A block of this many characters with few links and enough stop words is text.
LONG = 140
SHORT = 60
STOPS_HIGH = 0.18
STOPS_LOW = 0.10
LINKS_HIGH = 0.34

GOOD, BAD, OPEN = 1, 0, None
#: How much farther a bad neighbour inside an article counts than a good one.
FAR = 4

#: What a mark does: WEAK asks a region for some text, HINT for much of it inside an article and decides outside;
#: COMMENT and PLACE decide, FIRM does so whatever the element holds.
WEAK, HINT, COMMENT, PLACE, FIRM = 1, 2, 3, 4, 5


@dataclass
class Mark:
    """An element that may be boilerplate; `above` is the mark around it, -1 for none."""

    kind: int
    above: int
    main: bool


@dataclass
class Block:
    text: list[str] = field(default_factory=list)
    linked: int = 0
    mark: int = -1  # innermost mark
    main: int = -1  # outermost article, by number
    heading: bool = False


def blocks(page: str) -> tuple[list[Block], list[Mark]]:
    """Blocks in page order, and the marks they stand in; scripts, styles, comments and markup are gone."""
    out: list[Block] = []
    marks: list[Mark] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements that matter: name, whether marked, whether main
    inside = [-1]  # open marks
    mains = 0  # outermost articles so far
    count: Counter[str] = Counter()  # open elements by name, and of the kinds "main", "heading" and "skipped"
    block = Block()
    at, n = 0, len(page)

    def add(text: str) -> None:
        if text and not count["#skipped"]:
            block.text.append(text)
            if count["a"]:
                block.linked += len(text.strip())

    def cut() -> None:
        nonlocal block
        if any(t.strip() for t in block.text):
            out.append(block)
        block = Block(mark=inside[-1], main=mains if count["#main"] else -1, heading=count["#heading"] > 0)

    def change(element: tuple[str, bool, bool], by: int) -> None:
        name, marked, main = element
        if marked and by < 0:
            inside.pop()
        for key in (name, "#main" * main, "#heading" * (name in HEADINGS), "#skipped" * (name in SKIPPED)):
            if key:
                count[key] += by

    def close(name: str) -> None:
        """Close the innermost open element of this name and all it holds."""
        while count[name]:
            element = stack.pop()
            change(element, -1)
            if element[0] == name:
                break

    while at < n:
        match = _TOKEN.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            close(name)
            if name in BLOCKS:
                cut()
            continue
        attributes = match[3]
        if name in VOID:
            if name == "br":
                add(" ")
            elif name == "hr":
                cut()
            continue
        if name in BLOCKS:
            close("p")  # a paragraph, and what it left open, ends where a block starts
            if name == "li" and stack and stack[-1][0] == "li":
                close("li")
        main = name in MAIN
        kind = _kind(name, attributes) if attributes and name not in ("html", "body") else 0
        # the head of an article belongs to it
        if name in APART and not (name == "header" and count["#main"]):
            kind = max(kind, PLACE if name in WRAPPERS else FIRM)
        element = (name, kind > 0, main)
        if not attributes.endswith("/") and (kind or name in BLOCKS or name in SKIPPED or name in RAW or name == "a"):
            stack.append(element)
            if kind:
                marks.append(Mark(kind, inside[-1], count["#main"] > 0))
                inside.append(len(marks) - 1)
            mains += main and not count["#main"]
            change(element, 1)
        if name in BLOCKS or kind:
            cut()
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            close(name)
            at = end.end() if end else n
    cut()
    return out, marks


def _kind(name: str, attributes: str) -> int:
    """What the attributes of an element say; 0 for nothing."""
    kind = 0
    if not _SAYS.search(attributes):
        return 0
    for match in _ATTRIBUTE.finditer(attributes):
        key = (match[1] or "").lower()
        if key not in _ATTRIBUTES:
            continue
        value = match[2] or match[3] or match[4] or ""
        # ids of headings and sections are made from their titles
        if key == "class" or key == "id" and name not in HEADINGS and name != "section":
            kind = max([kind, *map(_hint, value.split())]) if _HINT.search(value) else kind
        elif key == "role" and value.strip().lower() in _ROLE:
            return PLACE
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return PLACE
        elif key == "hidden":
            return PLACE
    # a title is text unless it heads comments; beside other words a hint says nothing against an article
    return 0 if name in HEADINGS and kind != COMMENT or name in MAIN and kind == WEAK else kind


def _hint(token: str) -> int:
    """The kind of one class or id: hints among plain words or outnumbering others, or beside those."""
    if not _HINT.search(token):
        return 0
    parts = [p for p in _PARTS.split(token.lower()) if p]
    hints = sum(bool(_HINT.search(p)) for p in parts)
    others = sum(not (p in _PLAIN or p.isdigit() or _HINT.search(p)) for p in parts)
    if others and hints <= others:
        return WEAK
    return COMMENT if _COMMENTS.intersection(parts) else HINT


def clean(text: str) -> str:
    """Character references decoded, white space runs as one space, trimmed."""
    return " ".join((html.unescape(text) if "&" in text else text).split())


def label(found: list[Block], marks: list[Mark], texts: list[str]) -> list[int]:
    """Labels of blocks: first by rules, then open ones by their article or their neighbours."""
    counted = [_count(t) for t in texts]
    total: Counter[str] = Counter()
    for _, stops in counted:
        total.update(stops)
    known = max(total.values(), default=0) >= STOPS_LOW * sum(n for n, _ in counted)
    scores = [_by_rules(b, t, n, max(s.values(), default=0), known) for b, t, (n, s) in zip(found, texts, counted)]
    apart, lowered = _weigh(found, marks, texts, scores)

    first: list[int | None] = [BAD if apart[b.mark] else OPEN if s is OPEN else min(s, GOOD) for b, s in zip(found, scores)]
    # a region under a hint needs a block of its own that is text; beside other words, the neighbours in the article decide
    held, loose = set(), set()
    for i, block in enumerate(found):
        level, region = lowered[block.mark]
        if level and first[i] is GOOD:
            if scores[i] > level - 1:
                held.add(region)
            else:
                first[i] = OPEN
    for i, block in enumerate(found):
        level, region = lowered[block.mark]
        if level and first[i] is OPEN and region not in held:
            if level == WEAK and block.main >= 0:
                loose.add(i)
            else:
                first[i] = BAD

    return _inherit(first, [b.main for b in found], [apart[b.mark] for b in found], [len(t) for t in texts], loose)


def _count(text: str) -> tuple[int, Counter[str]]:
    """Number of words, and of stop words by language."""
    words = _WORD.findall(text.lower())
    stops: Counter[str] = Counter()
    for word, n in Counter(w for w in words if w in _STOPS).items():
        for lang in _STOPS[word]:
            stops[lang] += n
    return len(words), stops


def _by_rules(block: Block, text: str, words: int, stops: int, known: bool) -> int | None:
    """BAD, OPEN, GOOD, or 2 for much text; `known`: whether the page fits a list of stop words."""
    if not words:
        return BAD if block.main < 0 else OPEN
    linked = block.linked / max(1, len(text))
    if linked > LINKS_HIGH:
        return OPEN if block.main >= 0 and block.heading else BAD
    size = len(text) if text.isascii() else len(text) + 2 * len(_DENSE.findall(text))
    if "©" in text and size < LONG and block.main < 0:
        return BAD
    dense = stops / words
    if size >= LONG:
        if dense >= STOPS_HIGH or not known and linked <= LINKS_HIGH / 2:
            return 2
        return GOOD if dense >= STOPS_LOW or not known else OPEN
    if size >= SHORT and dense >= STOPS_HIGH:
        return GOOD
    return OPEN


def _weigh(
    found: list[Block], marks: list[Mark], texts: list[str], scores: list[int | None]
) -> tuple[list[bool], list[tuple[int, int]]]:
    """Per mark, whether its blocks are boilerplate, and how much text its region needs (0, 1, 2) and which that is.

    A last entry stands for blocks without marks. Sizes are unlinked text.
    """
    n = len(marks)
    held = [[0, 0, 0, 0] for _ in range(n + 1)]  # size, good blocks, long good ones, blocks of articles
    for block, text, score in zip(found, texts, scores):
        own = held[block.mark]
        own[0] += max(0, len(text) - block.linked)
        own[1] += (score or 0) > 0
        own[2] += (score or 0) > 0 and len(text) >= LONG
        own[3] += block.main >= 0
    direct = [list(h) for h in held]
    for i in range(n - 1, -1, -1):
        if marks[i].above >= 0:
            held[marks[i].above] = [a + b for a, b in zip(held[marks[i].above], held[i])]
    size = held[n][0] + sum(h[0] for h, m in zip(held, marks) if m.above < 0)
    apart = [False] * (n + 1)
    lowered = [(0, -1)] * (n + 1)
    outside = [(0, 0)] * n + [(direct[n][1], direct[n][3])]  # free good blocks and blocks of articles, up to a mark
    for i, mark in enumerate(marks):
        apart[i], lowered[i], outside[i] = apart[mark.above], lowered[mark.above], outside[mark.above]
        if apart[i]:
            continue
        good, of_articles = outside[i]
        most = mark.kind != FIRM and 2 * held[i][0] > size
        if most and mark.kind != WEAK:
            most = not (good and mark.kind == COMMENT) and (not of_articles or held[i][2] > 0 and not good)
        if most:
            outside[i] = (good + direct[i][1], of_articles + direct[i][3])
        elif mark.kind > HINT or mark.kind == HINT and not mark.main:
            apart[i] = True
        else:
            if mark.kind > lowered[i][0]:
                lowered[i] = (mark.kind, i)
            outside[i] = (good + direct[i][1], of_articles + direct[i][3])
    return apart, lowered


def _inherit(
    first: list[int | None], mains: list[int], apart: list[bool], sizes: list[int], loose: set[int] = frozenset()
) -> list[int]:
    """Open blocks take the label of the nearest decided neighbours.

    An article element is a border and a weight: a block inside looks at blocks of
    the same element, where a bad one counts as FAR times as far away as a good
    one and blocks of menus and forms do not count; where most text stands in
    articles, a block outside looks at others outside. Without a decided
    neighbour there, the nearest of the page decides for blocks of an article on
    a page with text elsewhere; an article on a page without text is good, and all
    else is bad. ``loose`` blocks look at the whole page.
    """
    good = [i for i, f in enumerate(first) if f is GOOD]
    within = sum(sizes[i] for i in good if mains[i] >= 0)
    mainly = (within or any(m >= 0 and f is OPEN for m, f in zip(mains, first))) and 2 * within >= sum(sizes[i] for i in good)
    every: tuple[list[int], list[int]] = ([], good)  # places of bad and of good blocks
    regions: dict[int, tuple[list[int], list[int]]] = {}
    for i, f in enumerate(first):
        if f is BAD:
            every[0].append(i)
        if f is not OPEN and (mains[i] < 0 or not apart[i]):
            regions.setdefault(mains[i], ([], []))[f].append(i)
    out = []
    for i, decided in enumerate(first):
        if decided is not OPEN:
            out.append(decided)
        elif mains[i] >= 0 and i not in loose:
            near = _nearest(i, *regions.get(mains[i], ([], [])), FAR)
            out.append(near if near is not None else _nearest(i, *every) if good else GOOD)
        else:
            near = _nearest(i, *(regions.get(-1, ([], [])) if mainly and i not in loose else every))
            out.append(BAD if near is None else near)
    return out


def _nearest(i: int, bad: list[int], good: list[int], far: int = 1) -> int | None:
    """Label of the nearest decided neighbour, the good one at equal distance; a bad one is ``far`` times as far away."""

    def distance(places: list[int]) -> float:
        at = bisect.bisect_left(places, i)
        return min((abs(places[j] - i) for j in (at - 1, at) if 0 <= j < len(places)), default=float("inf"))

    if not bad and not good:
        return None
    return GOOD if distance(good) <= far * distance(bad) else BAD


def main_text(page: str | None) -> str:
    """The article of a page, one line per block; empty if there is none."""
    found, marks = blocks(page or "")
    texts = [clean("".join(b.text)) for b in found]
    kept = [i for i, t in enumerate(texts) if t]
    found, texts = [found[i] for i in kept], [texts[i] for i in kept]
    return "\n".join(t for t, good in zip(texts, label(found, marks, texts)) if good)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page.

    Null, empty and text-free pages give the empty text; a page that ends in the
    middle of a tag is read as far as it goes. Pages are worked on where they
    are: repeated rows stay, an empty table gives an empty one, other columns
    are not read.
    """

    def rows(tuples: Iterator[tuple]) -> Iterator[tuple]:
        for page_id, url, page in tuples:
            text = main_text(page)
            yield page_id, url, text, len(text)

    return arrow_map(pick(pages, "page_id", "url", "html"), "page_id long, url string, text string, n_chars long", rows)
