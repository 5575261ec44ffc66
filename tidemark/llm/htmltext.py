"""HTML main text by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass classifies a block by its place
(inside navigation, footers, asides, forms, adverts, notices, comments: out), its link density, its length
and its density of stop words (its length alone where the page has hardly any stop word of the four languages). Short blocks without links and blocks
of middle length with stop words stay undecided. The second pass gives undecided blocks the label of the nearest decided neighbours: middle ones are
good beside one good block, then short ones if both agree; otherwise in the article that of the good one, elsewhere that of the bad one.
Blocks that are out by their place are no neighbours. On a page without any good block the longest run of undecided ones is
good if it has the length and the stop words of one.

An ``article`` or ``main`` element is a prior: its blocks need no stop words and its short ones are good. It holds only while
these elements have at least as much unlinked text as the good blocks outside of them; otherwise (teaser cards) their blocks are judged
as any others. Blocks outside are judged by the two passes among themselves, so long text with stop words outside stays;
short blocks there need a good one on both sides.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
    der die das und ist nicht ein eine zu den dem mit von für auf im sich des auch als es an er sie wie aus bei nach
    le la les de des un une et est que qui dans pour pas sur au avec ce il elle par plus ne se du en sont nous vous
    el los las del y que en un una con no por su para al lo como más pero sus este sí porque esta entre cuando muy""".split()
)

LINK_DENSITY = 0.33
SHORT_CHARS = 70
LONG_CHARS = 200
LOW_STOP = 0.10
FEW_STOP = 0.02  # a page with a smaller share is taken to be in another language

# Elements by their part in a page.
BLOCK_TAGS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul""".split()
)
OUT_TAGS = frozenset("nav footer aside form menu header button select dialog fieldset head title".split())
HIDDEN_TAGS = "script|style|noscript|template|iframe|object|svg|math|textarea|canvas|audio|video|select"
MAIN_TAGS = frozenset("article main".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form".split())
#: Words in an id or class that mark a part that is not the article.
OUT_NAMES = frozenset(
    """ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar
    side aside footer foot header masthead comment comments disqus reply replies respond cookie cookies consent gdpr notice alert popup modal
    overlay newsletter subscribe signup login share sharing social related recommended widget toolbar pagination pager copyright legal
    disclaimer""".split()
)

HEAD_NAMES = frozenset("header head masthead side".split())

_HIDDEN = re.compile(rf"<!--|<!\[CDATA\[|<({HIDDEN_TAGS})\b", re.I)
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[!?][^>]*>)")
_OUTSIDE_QUOTES = re.compile(r"[^<\"']+|<|\"[^\"]*\"|'[^']*'")
_ATTR = re.compile(r"\b(id|class|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    out: bool  # within a part that is not the article
    main: bool  # within an article or main element
    heading: bool


def _names_out(attributes: str, inside: bool) -> bool:
    """Do the attributes mark a part that is not the article? ``inside``: within the article, whose own head is part of it."""
    for name, value in _ATTR.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("id", "class"):
            for one in value.split():
                words = [w for w in re.split(r"[^a-z]+", one) if w]
                if words and words[0] not in ("has", "no", "with", "without", "article", "post", "entry") and {words[0], words[-1]} & OUT_NAMES - (HEAD_NAMES if inside else set()):
                    return True
        if name == "role" and value in OUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _visible(page: str) -> str:
    """The page with a space for each comment, CDATA section and hidden element; what is left open reaches to the end.

    One forward pass: an end that is missing once is not looked for again, so a page of unclosed parts takes linear time."""
    out, at, sections = [], 0, True
    while m := _HIDDEN.search(page, at):
        start, after = m.start(), m.end()
        if m[1] is None and m[0] == "<!--":
            end = page.find("-->", after)
            end = len(page) if end < 0 else end + 3
        elif m[1] is None:
            end = page.find("]]>", after) if sections else -1
            if end < 0:  # an open section is no section: its text stays
                sections = False
                out.append(page[at:after])
                at = after
                continue
            end += 3
        else:
            close = page.find(">", after)
            if close < 0:
                break
            end = close + 1
            if page[close - 1] != "/":
                last = re.compile(f"</{m[1]}", re.I).search(page, end)
                end = page.find(">", last.end()) + 1 if last else 0
                end = end or len(page)
        out += [page[at:start], " "]
        at = end
    return "".join(out) + page[at:]


def _tags(page: str) -> Iterator[re.Match]:
    """The tags of a page in order.

    A tag that never ends fails after a scan to the end of the page. Every ``<`` that this scan passed outside of
    quotes would fail on the same way, so it is not tried again; there are at most as many such scans as states of quoting."""
    last, at, dead = page.rfind(">"), 0, set()
    while 0 <= (at := page.find("<", at)) < last:
        m = None if at in dead else _TAG.match(page, at)
        if m:
            yield m
            at = m.end()
            continue
        if at not in dead and page[at + 1 : at + 3].lstrip("/")[:1].isalpha():
            q = at
            while piece := _OUTSIDE_QUOTES.match(page, q):
                if piece[0] == "<":
                    dead.add(q)
                q = piece.end()
        at += 1


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; white space is one space, character references are decoded."""
    page = _visible(page)
    found: list[Block] = []
    open_tags: list[tuple[str, bool, bool]] = []  # (name, out, main) of open elements that matter
    out = main = 0
    links = 0
    heading = False
    text: list[str] = []
    linked = 0

    def close() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined:
            found.append(Block(joined, linked, out > 0, main > 0, heading))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        text.append(piece)
        if links:
            linked += len(piece.strip())

    at = 0
    for tag in _tags(page):
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if tag[1] else 1
            continue
        if name in BLOCK_TAGS:
            close()
        if name in VOID_TAGS or tag[3].endswith("/"):
            continue
        if name not in BLOCK_TAGS and name != "span":
            continue
        if tag[1]:
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == name:
                    for _, was_out, was_main in open_tags[i:]:
                        out -= was_out
                        main -= was_main
                    del open_tags[i:]
                    break
                if open_tags[i][0] in ("article", "main", "nav", "footer", "aside", "form", "div", "section") and name in ("p", "span", "li", "b"):
                    break  # a stray end tag does not close the part around it
            if name in BLOCK_TAGS:
                links = 0
                heading = False
            continue
        # A header element inside the article belongs to it; elsewhere it is the site's.
        is_out = name in OUT_TAGS and not (name == "header" and main) or bool(tag[3]) and name not in ("body", "html") and _names_out(tag[3], main > 0)
        is_main = name in MAIN_TAGS
        if name == "p" and open_tags and open_tags[-1][0] == "p":
            open_tags.pop()  # a paragraph ends where the next begins
        heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        if is_out and name == "span":
            close()
        open_tags.append((name, is_out, is_main))
        out += is_out
        main += is_main
    if at < len(page):
        add(page[at:])
    close()
    return found


GOOD, BAD, SHORT, NEAR = 1, 0, -1, -2


def _linked(block: Block) -> bool:
    n = len(block.text)
    return min(block.linked, n) / n > LINK_DENSITY


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def first_pass(block: Block, known: bool = True) -> int:
    """Label by place, links, length and stop words; SHORT or NEAR (middle length) where the block alone does not decide.

    ``known``: the page is in a language of the stop words; without, length and links decide.
    """
    n = len(block.text)
    if block.out or _linked(block):
        return BAD
    if n < SHORT_CHARS:
        return SHORT
    if block.main:
        return GOOD
    if known and _stop_share(block.text) < LOW_STOP:
        return BAD
    return GOOD if n > LONG_CHARS else NEAR


def _sides(found: list[Block], labels: list[int]) -> list[tuple[int | None, int | None]]:
    """Labels of the nearest decided blocks before and after each block; those out by their place or on the other side of a main element's edge are passed over."""
    pairs = []
    for order in (range(len(found)), range(len(found) - 1, -1, -1)):
        last: dict[bool, int] = {}
        one: list[int | None] = [None] * len(found)
        for i in order:
            one[i] = last.get(found[i].main)
            if labels[i] in (GOOD, BAD) and not found[i].out:
                last[found[i].main] = labels[i]
        pairs.append(one)
    return list(zip(*pairs))


def second_pass(found: list[Block], labels: list[int]) -> list[int]:
    """Undecided blocks take the label of their nearest decided neighbours; blocks of other parts of the page are no neighbours.

    A block of middle length that has no decided neighbour at all is good: its stop words and links say so."""
    out = [(GOOD if GOOD in sides or sides == (None, None) else BAD) if label == NEAR else label for label, sides in zip(labels, _sides(found, labels))]
    prior = any(b.main for b in found)
    final = list(out)
    for i, (before, after) in enumerate(_sides(found, out)):
        if out[i] == SHORT:
            sides = {before, after} - (set() if prior else {None})
            final[i] = GOOD if found[i].main or sides == {GOOD} or found[i].heading and after == GOOD else BAD
    return final


def _best_run(found: list[Block], labels: list[int], known: bool) -> list[int]:
    """Labels of a page without a good block: the undecided blocks between two bad ones with the most text are good
    if, taken together, they are long enough and have stop words."""
    runs: list[list[int]] = [[]]
    for i, label in enumerate(labels):
        if label in (SHORT, NEAR):
            runs[-1].append(i)
        elif runs[-1]:
            runs.append([])
    texts = [" ".join(found[i].text for i in run) for run in runs]
    best = max(range(len(runs)), key=lambda r: len(texts[r]))
    if len(texts[best]) < SHORT_CHARS or known and _stop_share(texts[best]) < LOW_STOP:
        return [BAD] * len(labels)
    return [GOOD if i in set(runs[best]) else BAD for i in range(len(labels))]


def main_text(page: str) -> str:
    """Good blocks of the page joined by one space; empty if there is none."""
    found = blocks(page)
    known = _stop_share(" ".join(b.text for b in found if not b.out)) >= FEW_STOP
    labels = [first_pass(b, known) for b in found]
    inside = sum(len(b.text) for b in found if b.main and not b.out and not _linked(b))
    outside = sum(len(b.text) for b, label in zip(found, labels) if not b.main and label == GOOD)
    if inside < outside:  # the main text is elsewhere
        found = [replace(b, main=False) for b in found]
        labels = [first_pass(b, known) for b in found]
    first, labels = labels, second_pass(found, labels)
    if GOOD not in labels:
        labels = _best_run(found, first, known)
    return " ".join(b.text for b, label in zip(found, labels) if label == GOOD)


def extracted(page: Column) -> Column:
    """Main text column; a null page has an empty text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for col in batches:
            yield pa.array([main_text(p.as_py()) if p.is_valid else "" for p in col], pa.string())

    return run(page.cast("string"))


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole html in ``out_col``; the html itself and a clashing column are left out.

    Null and empty pages and pages without text give an empty text; repeated rows return equal rows; an empty table
    returns no rows. Nothing of a long page is cut.
    """
    keep = [c for c in pages.columns if c != html_col and c.lower() != out_col.lower()]
    return pages.select(*map(quoted, keep), extracted(quoted(html_col)).alias(out_col))
