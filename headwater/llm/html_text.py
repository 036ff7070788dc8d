"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block alone: its share of
stop words, its length and its share of linked characters, and the elements it stands in. Menus, page
headers and footers, sidebars, forms, adverts, notices and comments, told by element or by the words of
``class``, ``id`` and ``role``, are boilerplate; such words never reject an article or main element itself, and
parts of longer names (``content-sidebar-wrap``) none inside. What an article or main element holds otherwise is
content; elsewhere the three measures decide, and short or middling blocks stay open. In the second pass open
blocks take the label of the nearest neighbour that the measures decided; between two equally near ones
that differ, a heading follows the next block, any other the one before. Without such a neighbour they are
content, but boilerplate on pages with an article.

Scripts, styles, comments of the markup and the head are no blocks. Character references are decoded,
white space in a block becomes one space. Unclosed elements end with the page or the next block of
their kind; a tag cut off by the end of the page is dropped. A quote opens a value only after ``=``, and only if it is closed
further on. Null, empty and tagless pages give their
text, which may be empty. Repeated rows are treated alike; other columns are kept, and columns named
``text`` or ``n_chars`` are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from headwater.llm.tables import append_columns, table

# The elements of each kind.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "object", "textarea", "select", "head", "title")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "label", "legend", "option"))
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert"
    " popup modal overlay sidebar aside menu nav navbar navigation navi breadcrumb breadcrumbs pagination pager footer masthead header toolbar topbar"
    " comment comments commentlist respond reply replies disqus share sharing social related recommended newsletter subscribe signup login search"
    " widget complementary contentinfo search-form toc".split()
)
CONTENT_WORDS = frozenset("article main".split())
# Common words of four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with be by at this from or an have not they you which were but his her has had"
    " der die das und in zu den von mit ist des auf für im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"
    " le la les de et des un une du que en est pour qui dans sur pas au par plus ne se il ce sont avec"
    " el los las y del se por con no para su al lo como más pero sus o este sí porque esta entre".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)",
    re.S,
)
_RAW_END = {t: re.compile(rf"</{t}\s*(?:>|\Z)", re.I) for t in RAW}
_LABELS = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")

GOOD, OPEN, BAD = 1, 0, -1
#: Of an element: boilerplate, but for an article or main element inside.
DOUBTFUL = -2


@dataclass
class Block:
    text: str
    linked: int
    tag: str
    inside: int  # GOOD in an article, BAD in boilerplate, OPEN elsewhere


def _standing(tag: str, attributes: str, outer: int) -> int:
    """How an element makes its content stand, given how it stands itself."""
    if outer == BAD:
        return BAD
    if tag in ("article", "main"):
        return GOOD
    if tag in ("html", "body"):
        return outer
    names = [(m[1] or m[2] or m[3] or "").lower() for m in _LABELS.finditer(attributes)] if attributes else []
    whole, parts = {w for n in names for w in n.split()}, {w for n in names for w in _WORD.findall(n)}
    if tag in BOILERPLATE or whole & BOILERPLATE_WORDS:
        return BAD
    if parts & BOILERPLATE_WORDS:
        return BAD if outer == GOOD else DOUBTFUL
    if whole & CONTENT_WORDS or parts & CONTENT_WORDS and outer != DOUBTFUL:
        return GOOD
    return outer


def blocks(page: str) -> Iterator[Block]:
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    linked = links = at = 0

    def block() -> Iterator[Block]:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            tag, inside = stack[-1] if stack else ("", OPEN)
            yield Block(text, linked, tag, max(inside, BAD))
        parts.clear()
        linked = 0

    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            parts.append(text)
            if links:
                linked += len(text)
        if not found:
            break
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                parts.append(found[0][9:].removesuffix("]]>"))
            continue
        tag, closing = found[2].lower(), bool(found[1])
        whole = found[0].endswith(">")
        if tag in RAW:
            if not closing and whole and not found[3].endswith("/"):
                end = _RAW_END[tag].search(page, at)
                if tag == "head" and not end:
                    end = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if not whole:
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
        if tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        yield from block()
        links = 0
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        elif tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
            stop = {"li": ("ul", "ol"), "option": ("select",)}.get(tag, ("table", "dl"))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stop or tag in ("td", "th") and stack[k][0] == "tr":
                    break
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        stack.append((tag, _standing(tag, found[3], stack[-1][1] if stack else OPEN)))
    yield from block()


def first_pass(block: Block, short: int = 70, long: int = 200, low: float = 0.15, high: float = 0.3, most_linked: float = 0.5) -> int:
    """The label of a block by itself."""
    if block.inside:
        return block.inside
    size = len(block.text)
    if block.linked > most_linked * size:
        return BAD
    if size < short:
        return OPEN
    words = block.text.lower().split()
    density = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if density >= high or size > long and density >= low:
        return GOOD
    if density >= low or size > long:
        return OPEN
    return BAD if block.linked else OPEN


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Open blocks get the label of the nearest neighbour that the measures decided; a page without decided blocks and
    articles is all content."""
    n = len(labels)
    other = BAD if any(b.inside == GOOD for b in found) else GOOD
    before, after = [(n, other)] * n, [(n, other)] * n
    decided = [label if found[i].inside == OPEN else OPEN for i, label in enumerate(labels)]
    last = (None, other)
    for i in range(n):
        last = (i, decided[i]) if decided[i] else last
        before[i] = (i - last[0] if last[0] is not None else n, last[1])
    last = (None, other)
    for i in range(n - 1, -1, -1):
        last = (i, decided[i]) if decided[i] else last
        after[i] = (last[0] - i if last[0] is not None else n, last[1])
    out = []
    for i, label in enumerate(labels):
        (a, x), (b, y) = before[i], after[i]
        out.append(label or (x if a < b or a == b and found[i].tag not in HEADINGS else y))
    return out


def main_text(page: str | None) -> str:
    found = list(blocks(page or ""))
    labels = second_pass(found, [first_pass(b) for b in found])
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label == GOOD)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` in place of ``html``."""

    def compute(column: pa.Array) -> list[pa.Array]:
        texts = [main_text(x.as_py()) for x in column]
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    return append_columns(pages, "html", "text string, n_chars long", compute).drop("html")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
