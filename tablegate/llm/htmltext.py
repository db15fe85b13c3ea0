"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to the elements around them,
half as much at each level, discounted by how much of an element is links.
The best element and those of its siblings that read like text are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.llm.words import in_batches, rows_within

# Element names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
RAW = ("script", "style", "noscript", "textarea", "iframe", "title", "noframes")
NEVER = frozenset("svg math template select button object canvas audio video datalist".split())
UNWANTED = frozenset("nav header footer aside form dialog menu fieldset".split())
MAIN = frozenset(("article", "main"))
CLOSES_P = BLOCKS - {"body", "html"}
# Elements without content or end tag.
VOID = frozenset("area base basefont bgsound br col embed frame hr image img input keygen link meta param source track wbr".split())
# Words of class, id and role that mark what is not the article.
UNWANTED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent"
    " contentinfo cookie cookies disqus disclaimer dialog footer form gdpr header hidden masthead menu modal nav navbar"
    " navigation newsletter notice notices pagination pager paywall popup promo promotion promoted recommended related"
    " replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " tags toolbar widget alert complementary".split()
)
# Of these, the ones that wrappers of the article are called too, as in ``content-header`` ...
WRAPPERS = frozenset("alert banner dialog form header hidden masthead modal notice notices popup toolbar widget".split())
# ... next to a word for the article itself.
ARTICLE_NAMES = frozenset("article body content entry main page post story text wrap wrapper".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?=/?[a-zA-Z])[^<>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z]+")
# Parts of a name that say what an element holds or lacks, not what it is.
ABOUT_OTHERS = frozenset("has have no not with without".split())
LINKS = 0.5  # a sibling with more of its characters in links is a list of links
SIBLING_SHARE = 0.1
LOST = 3  # so many times the text found without wrappers' names: they took the article


def _attributes(attributes: str) -> Iterator[tuple[str, str]]:
    for match in _ATTRIBUTE.finditer(attributes):
        yield match[1].lower(), match[2] or match[3] or match[4] or ""


def _hidden(attributes: str) -> bool:
    for name, value in _attributes(attributes):
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True
        if name == "style" and _NOT_SHOWN.search(value):
            return True
    return False


@dataclass(frozen=True)
class Names:
    """What class, id, role and a form say: by all listed words, without those of wrappers, or nothing at all."""

    listed: frozenset[str]
    forms: bool


ALL_NAMES = Names(UNWANTED_NAMES, forms=True)
NO_WRAPPERS = Names(UNWANTED_NAMES - WRAPPERS, forms=False)
NO_NAMES = Names(frozenset(), forms=False)


def _named_unwanted(attributes: str, names: Names) -> bool:
    """Whether a class, id or role is a listed word or has it as a part.

    ``has-sidebar`` or ``no-sidebar`` is none, nor is a wrapper's word next to
    one for the article, as in ``content-header``.
    """
    for name, value in _attributes(attributes):
        if name in ("class", "id", "role"):
            for token in value.lower().split():
                parts = set(_SPLIT.split(token))
                found = parts & names.listed
                if found and not ARTICLE_NAMES.isdisjoint(parts):
                    found -= WRAPPERS
                if found and ABOUT_OTHERS.isdisjoint(parts):
                    return True
    return False


def _unwanted(name: str, attributes: str, names: Names) -> bool:
    if name in UNWANTED and (names.forms or name not in ("form", "fieldset")):
        return True
    if not attributes.strip():
        return False
    if _hidden(attributes):
        return True
    return bool(names.listed) and name not in ("body", "html") and name not in MAIN and _named_unwanted(attributes, names)


class Page:
    """Blocks of text and the elements that hold them, in page order."""

    def __init__(self, listed: Names = ALL_NAMES) -> None:
        self.listed = listed
        self.parents, self.names, self.unwanted = [-1], [""], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack = [0]
        self.open_names: Counter = Counter()
        self.pieces: list[str] = []
        self.linked = 0
        self.in_link = False
        # an inline element whose text is left out: name, open elements of that name, where it began
        self.skipped, self.depth, self.height = "", 0, 0

    def text(self, piece: str) -> None:
        if not self.skipped and not self.unwanted[self.stack[-1]]:
            self.pieces.append(piece)
            if self.in_link:
                self.linked += len(piece)

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join(unescape("".join(self.pieces)).split())
            if text:
                self.blocks.append((self.stack[-1], text, min(self.linked, len(text))))
            self.pieces = []
        self.linked, self.in_link = 0, False

    def inline(self, name: str, attributes: str, closing: bool) -> None:
        """An element inside a block; one that is hidden or no part of the article leaves the block open."""
        if self.skipped:
            if name == self.skipped and not attributes.endswith("/"):
                self.depth += -1 if closing else 1
                if not self.depth:
                    self.skipped = ""
        elif not closing and not attributes.endswith("/") and (name in NEVER or attributes and _unwanted(name, attributes, self.listed)):
            self.skipped, self.depth, self.height = name, 1, len(self.stack)
        elif name == "a":
            self.in_link = not closing

    def _leave(self, depth: int) -> None:
        """Close the elements from this depth of the stack on, and what was left open inside them."""
        for node in self.stack[depth:]:
            self.open_names[self.names[node]] -= 1
        del self.stack[depth:]
        if len(self.stack) < self.height:
            self.skipped = ""

    def open(self, name: str, attributes: str) -> None:
        self.end_block()
        if name in CLOSES_P:
            self._close_inside(("p",), BLOCKS - {"p"})
        if name == "li":
            self._close_inside(("li",), frozenset(("ul", "ol", "menu", "dir")))
        elif name in ("td", "th"):
            self._close_inside(("td", "th"), frozenset(("tr", "table")))
        elif name == "tr":
            self._close_inside(("tr",), frozenset(("table",)))
        elif name in ("dt", "dd"):
            self._close_inside(("dt", "dd"), frozenset(("dl",)))
        if name in VOID or attributes.endswith("/"):
            return
        top = self.stack[-1]
        self.parents.append(top)
        self.names.append(name)
        self.unwanted.append(bool(self.skipped) or self.unwanted[top] or _unwanted(name, attributes, self.listed))
        self.stack.append(len(self.names) - 1)
        self.open_names[name] += 1

    def _close_inside(self, names: tuple[str, ...], stops: frozenset[str]) -> None:
        """Close the nearest element of these names, unless another kind of element lies between."""
        if not any(self.open_names[name] for name in names):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.names[self.stack[depth]]
            if name in names:
                self._leave(depth)
                return
            if name in stops:
                return

    def close(self, name: str) -> None:
        self.end_block()
        # what is passed over on the way down is closed too, so all ends together cost what was opened
        if self.open_names[name]:
            depth = len(self.stack) - 1
            while self.names[self.stack[depth]] != name:
                depth -= 1
            self._leave(depth)


def read_page(html: str, listed: Names = ALL_NAMES) -> Page:
    """Elements and text blocks of a page; broken markup, cut-off tags included, is markup all the same.

    What class, id or role names by a listed word is left out.
    """
    page, at = Page(listed), 0
    for match in _TOKEN.finditer(html):
        if match.start() > at:
            page.text(html[at : match.start()])
        at = match.end()
        name = match[3]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCKS:
            if match[2]:
                page.close(name)
            else:
                page.open(name, match[4])
        elif name == "br":
            page.text(" ")
        elif name not in VOID:
            page.inline(name, match[4], bool(match[2]))
    if at < len(html):
        page.text(html[at:])
    page.end_block()
    return page


def main_blocks(page: Page) -> list[str]:
    """The blocks of the best-scored element and of its siblings that read like text."""
    count = len(page.names)
    points, chars, links = [0.0] * count, [0] * count, [0] * count
    for node, text, linked in page.blocks:
        chars[node] += len(text)
        links[node] += linked
        holder = node if page.names[node] not in ("p", "pre", "td", "li", "h1", "h2", "h3", "h4", "h5", "h6") else page.parents[node]
        commas = text.count(",") + text.count("，") + text.count("、")
        points[max(holder, 0)] += (1.0 + commas + min(len(text) / 100.0, 3.0)) * (1 - linked / len(text))
    for node in range(count - 1, 0, -1):
        parent = page.parents[node]
        points[parent] += points[node] / 2
        chars[parent] += chars[node]
        links[parent] += links[node]
    score = [p * (1 - links[i] / chars[i]) if chars[i] else 0.0 for i, p in enumerate(points)]
    best = max(range(count), key=lambda i: (score[i], -i))
    if not chars[best]:
        return []
    outer = best
    while outer > 0:
        outer = page.parents[outer]
        if outer > 0 and page.names[outer] in MAIN:
            best = outer
    kept = [False] * count
    kept[best] = True
    parent = page.parents[best]
    if best and page.names[best] not in MAIN:
        for node in range(1, count):
            if page.parents[node] == parent and chars[node] and links[node] <= LINKS * chars[node]:
                reads = page.names[node] in ("p", "h1", "h2", "h3", "blockquote", "pre")
                kept[node] = kept[node] or reads or score[node] >= SIBLING_SHARE * score[best]
    for node in range(1, count):
        kept[node] = kept[node] or (page.parents[node] >= 0 and kept[page.parents[node]])
    return [text for node, text, _ in page.blocks if kept[node]]


def main_text(html: str) -> str:
    """The main text.

    Names say what is no part of the article. Where the words that wrappers of
    a page have too, or a form, take away most of the text that is found
    without them, they are not believed; and no name is if nothing is left.
    """
    text = "\n\n".join(main_blocks(read_page(html)))
    wider = "\n\n".join(main_blocks(read_page(html, NO_WRAPPERS))) if _has_wrappers(html) else ""
    if len(wider) > LOST * len(text):
        text = wider
    return text or "\n\n".join(main_blocks(read_page(html, NO_NAMES)))


_WRAPPER = re.compile(r"<form\b|<fieldset\b|(?:class|id|role)\s*=[^>]*(?:" + "|".join(sorted(WRAPPERS)) + ")", re.IGNORECASE)


def _has_wrappers(html: str) -> bool:
    return _WRAPPER.search(html) is not None


def extract_main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every row.

    A null, empty or text-free page has an empty text; repeated rows are
    treated alike; an empty table gives no rows; other columns are not read.
    """
    frame = pages.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).alias("html"),
    )
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, url, text := main_text(html), len(text)) for i, url, html in rows_within(batches))
        yield from in_batches(rows, schema, weigh=lambda row: row[3])

    return frame.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
