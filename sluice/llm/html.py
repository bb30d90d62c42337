"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one labels each block from
where it stands and from its length, link density and stop-word density:

* ``bad``: inside menus, headers and footers of the page, sidebars, notices,
  adverts, forms, reader comments (by element, role, class or id), outside the
  article when the page marks one, or mostly links;
* ``good``: long enough with many stop words, or any full-length block of a
  marked article that isn't mostly links;
* undecided: short blocks and those between the limits.

A class or id is a hint only: it never counts against the element that is the
page's article, nor against what encloses it, and a form that holds the whole
page is no form to fill in.

Pass two gives an undecided block the label of its nearest decided neighbours:
of both when they agree, else of the nearer one (of the article's side on a
tie). The text of the good blocks, in page order, is the result.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.batches import append_columns

# Limits of pass one: characters, share of characters in links, share of stop words.
SHORT, LINKS = 70, 0.5
STOP_HIGH, STOP_LOW = 0.30, 0.10

# Frequent function words of the languages handled, in any order of use.
STOP_WORDS = frozenset(
    # English
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their "
    "they this to was we were which with you "
    # French
    "au aux avec ce dans de des du elle en est et il je la le les mais ne nous on ou par pas pour qui que sa se sur "
    "un une vous "
    # German
    "auf aus bei das dem den der des die ein eine er es für im in ist mit nicht sich sie so und von war wie zu "
    # Spanish
    "al como con de del el en es esta la las lo los más no o para pero por que se ser su un una y".split()
)

# Elements by their part in a page.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr ul".split()
)
SPACED = frozenset("br td th option img".split())
FURNITURE = frozenset(
    "aside button canvas datalist dialog footer form head menu nav object select svg video audio".split()
)
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
# A class or id holding one of these as a word marks furniture.
_HINT = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisements?|adsense|banners?|bottombar|breadcrumbs?|comments?|comment-?list|"
    r"cookies?|consent|disqus|footer|gdpr|login|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|"
    r"overlay|pagination|popup|promos?|promoted|recommended|related|replies|share|sharing|sidebars?|signup|social|"
    r"sponsor(?:ed|s)?|subscribe|subscription|tags|toolbar|topbar|widgets?|site-?header|page-?header)(?![a-z])"
)
# Of these, what an article element itself may be: a reader's comment, an advert, a teaser.
_NO_ARTICLE = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisements?|comments?|comment-?list|replies|promos?|promoted|recommended|related|"
    r"sponsor(?:ed|s)?)(?![a-z])"
)
_ARTICLE_HINT = re.compile(r"articleBody|(?<![a-z])(?:article|post|entry|story)-?_?(?:body|content|text)(?![a-z])", re.I)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</[^a-zA-Z][^>]*>|</?[a-zA-Z][^>]*\Z|</\Z""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_OPENS_NO_PARAGRAPH = BLOCK - {"body", "html", "head"}


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    furniture: bool
    in_article: bool


@dataclass
class Element:
    tag: str
    parent: int  # its number, -1 for none
    hard: bool  # furniture by what it is: a menu, hidden, ...
    hint: bool  # furniture by a hint that may be wrong
    article: bool  # marks the article


def _marks(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """(furniture for certain, by a hint, marks the article) by attributes."""
    hard = hint = article = no_article = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name in ("class", "id"):
            spread = re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().replace("_", "-")
            hint |= bool(_HINT.search(spread))
            no_article |= bool(_NO_ARTICLE.search(spread))
            article |= bool(_ARTICLE_HINT.search(value))
        elif name == "role":
            hard |= value.lower() in FURNITURE_ROLES
            article |= value.lower() in ("main", "article")
        elif name == "itemprop":
            article |= value == "articleBody"
        elif name == "hidden":
            hard = True
        else:
            hard |= value.lower() == "true"
    if tag == "main" or tag == "article" and not no_article:
        return hard, False, not hard
    return hard, hint, article and not hard and not hint


class _Page:
    """One pass over a page: its elements, and its blocks as (text, characters
    inside links, number of the element they stand in)."""

    def __init__(self, page: str):
        self.elements: list[Element] = []
        self.blocks: list[tuple[str, int, int]] = []
        self._stack: list[int] = []
        # Places in the stack of the open elements of each tag, and of those an end tag can't reach out of.
        self._open: dict[str, list[int]] = {}
        self._scopes: list[int] = []
        self._parts: list[str] = []
        self._linked = 0
        self._read(page)

    def _end_block(self) -> None:
        text = " ".join(html.unescape("".join(self._parts)).split())
        self._parts.clear()
        if text:
            self.blocks.append((text, min(self._linked, len(text)), self._stack[-1] if self._stack else -1))
        self._linked = 0

    def _add(self, text: str) -> None:
        self._parts.append(text)
        if self._open.get("a"):
            self._linked += len(" ".join(html.unescape(text).split())) + 1

    def _close(self, tag: str) -> None:
        places = self._open.get(tag)
        if not places or (tag not in _SCOPES and self._scopes and self._scopes[-1] > places[-1]):
            return  # nothing open, or an end tag would reach out of its table or section
        gone = self._stack[places[-1] :]
        if any(self.elements[e].tag in BLOCK for e in gone):
            self._end_block()
        del self._stack[places[-1] :]
        for e in gone:
            t = self.elements[e].tag
            self._open[t].pop()
            if t in _SCOPES:
                self._scopes.pop()

    def _enter(self, tag: str, attributes: str) -> None:
        hard, hint, article = _marks(tag, attributes) if attributes else (False, False, tag in ("article", "main"))
        hint |= tag == "form"
        hard |= tag in FURNITURE and tag != "form"
        parent = self._stack[-1] if self._stack else -1
        if tag in ("html", "body"):
            hard = hint = False
        self.elements.append(Element(tag, parent, hard, hint, article))
        place = len(self._stack)
        self._stack.append(len(self.elements) - 1)
        self._open.setdefault(tag, []).append(place)
        if tag in _SCOPES:
            self._scopes.append(place)

    def _read(self, page: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            if m is None:
                self._add(page[at:])
                break
            if m.start() > at:
                self._add(page[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            ending, attributes = m[1] or m[4], m[3] or m[6] or ""
            if ending:
                self._close(tag)
                if tag in BLOCK:
                    self._end_block()
                continue
            if tag in RAW:
                if not attributes.endswith("/") or tag in ("script", "style", "textarea", "title"):
                    found = _raw_end(tag).search(page, at)
                    at = found.end() if found else len(page)
                continue
            if tag in SPACED:
                self._parts.append(" ")
            if tag in VOID:
                if tag == "hr":
                    self._end_block()
                continue
            if tag in BLOCK:
                self._end_block()
                if tag in _OPENS_NO_PARAGRAPH and self._open.get("p"):
                    self._close("p")
                if tag == "li" and self._last("li") > max(map(self._last, ("ul", "ol", "menu"))):
                    self._close("li")
            if tag == "a" and self._open.get("a"):
                self._close("a")
            self._enter(tag, attributes)
        self._end_block()

    def _last(self, tag: str) -> int:
        return (self._open.get(tag) or [-1])[-1]


def _inside(elements: list[Element], excused: set[int]) -> tuple[list[bool], list[bool]]:
    """(furniture, article) of each element with all that encloses it. Headers of
    the page are furniture, those of an article aren't."""
    furniture, article = [], []
    for i, e in enumerate(elements):
        f, a = (furniture[e.parent], article[e.parent]) if e.parent >= 0 else (False, False)
        a |= e.article
        article.append(a)
        furniture.append(f or e.hard or (e.hint and i not in excused) or (e.tag == "header" and not a))
    return furniture, article


def _held(elements: list[Element], found: list[tuple[str, int, int]]) -> list[int]:
    """Characters of text in each element."""
    held = [0] * len(elements)
    for text, _, e in found:
        if e >= 0:
            held[e] += len(text)
    for i in range(len(elements) - 1, -1, -1):  # children come after their parents
        if elements[i].parent >= 0:
            held[elements[i].parent] += held[i]
    return held


def blocks(page: str) -> list[Block]:
    """The non-empty blocks of a page in order. Unclosed elements end with the
    element around them; a tag cut off at the end of the page is markup. Time is
    in proportion to the page, however many elements are open.

    Where every article stands inside hinted elements, the hints around the one
    with the most text don't count; where hints leave no text at all on a page
    without a marked article, those don't count that hold most of it."""
    read = _Page(page)
    elements, found = read.elements, read.blocks
    furniture, article = _inside(elements, set())
    marked = [i for i, e in enumerate(elements) if e.article]
    held = _held(elements, found)
    excused: set[int] = set()
    if marked and all(furniture[i] or not held[i] for i in marked):
        free = [i for i in marked if held[i] and not _hard_around(elements, i)]
        i = max(free, key=lambda m: held[m], default=-1)
        while i >= 0:
            excused.add(i)
            i = elements[i].parent
    elif not marked and found and all(e >= 0 and furniture[e] for _, _, e in found):
        whole = sum(len(text) for text, _, _ in found)
        excused = {i for i, e in enumerate(elements) if e.hint and 2 * held[i] > whole}
    if excused:
        furniture, article = _inside(elements, excused)
    return [Block(t, n, e >= 0 and furniture[e], e >= 0 and article[e]) for t, n, e in found]


def _hard_around(elements: list[Element], i: int) -> bool:
    while i >= 0:
        if elements[i].hard:
            return True
        i = elements[i].parent
    return False


_SCOPES = frozenset("article aside body div footer form header html main nav section table td th".split())
#: A sentence that ends and another one, or the end of the block, after it; with a comma or more words before.
_SENTENCES = re.compile(r"\w[\w,;:\s'’-]{20,}[.!?…](?:\s+[^\W\d_]|[\"'»”]?$)")
_raw_ends: dict[str, re.Pattern] = {}


def _raw_end(tag: str) -> re.Pattern:
    if tag not in _raw_ends:
        _raw_ends[tag] = re.compile(rf"</{tag}(?:\s[^>]*)?/?>", re.I)
    return _raw_ends[tag]


def labels(found: list[Block]) -> list[bool]:
    """True for the blocks of the main text."""
    marked = any(b.in_article and not b.furniture for b in found)
    first: list[bool | None] = [_decide(b, marked) for b in found]
    n = len(found)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    last = None
    for i in range(n):
        before[i] = last
        last = i if first[i] is not None else last
    last = None
    for i in range(n - 1, -1, -1):
        after[i] = last
        last = i if first[i] is not None else last
    return [label if label is not None else _inherit(found, first, i, before[i], after[i]) for i, label in enumerate(first)]


def _decide(b: Block, marked: bool) -> bool | None:
    if b.furniture or (marked and not b.in_article):
        return False
    density = b.linked / len(b.text)
    if density > LINKS and not b.in_article:
        return False
    if len(b.text) < SHORT or density > LINKS:
        return None
    if b.in_article:
        return True
    words = b.text.lower().split()
    share = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if share >= STOP_HIGH or (share >= STOP_LOW and len(b.text) >= 2 * SHORT):
        return True
    if share < STOP_LOW and len(b.text) >= 2 * SHORT and density <= STOP_LOW and _SENTENCES.search(b.text):
        return True  # sentences in a language without a list here
    return False if share < STOP_LOW / 2 and len(b.text) >= 2 * SHORT and density > 0 else None


def _inherit(found: list[Block], first: list, i: int, before: int | None, after: int | None) -> bool:
    """An undecided block of a marked article looks at decided blocks of the
    article only; other furniture says nothing about it."""
    if found[i].in_article:
        sides = [first[k] for k in (before, after) if k is not None and found[k].in_article and not found[k].furniture]
        return sides[0] if sides and all(s == sides[0] for s in sides) else True
    sides = [(abs(k - i), not first[k], first[k]) for k in (before, after) if k is not None]
    return min(sides)[2] if sides else False


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, good in zip(found, labels(found)) if good)


def extract(df: DataFrame, *, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its ``keep`` columns) plus text and n_chars (code points) of
    each whole page.

    Null and empty pages, and pages without main text: "" and 0. A page in
    which no block can be decided has no main text. Columns with the result's
    names are replaced. No shuffle.
    """

    def make():
        def work(pages):
            texts = [main_text(p.decode("utf-8", "replace")) if p else "" for p in pages]
            return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

        return work

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return append_columns(df, html_col, fields, make, keep=keep)
