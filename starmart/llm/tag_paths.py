"""Main text of HTML pages by tag-path ratios.

A page is read as text nodes under root-to-leaf tag paths.  Every path gets its number of
letters, of punctuation marks and of nodes; a node's ratio is letters and punctuation per
node of its path.  The ratios are smoothed over the page's node order (a node between
content nodes is likely content), fused with the text's own share of links and with what
tags and class names say, and nodes above a threshold taken from the page are content.

Where a page marks articles (``article``, ``main`` or an equal role), that is one more signal
to fuse: a node outside them counts nothing.  An article with a node above the threshold is
content with all its nodes that no exclusion covers, so one of nothing but links goes beside
one of text; if none has such a node, the marks alone tell.  A name or a form around an
article does not exclude it, unless the page has one outside such.

Blocks are cut at block-level tags, white space inside one becomes a space, and blocks are
joined by a space in page order.  Character references are decoded.

Defined results: null and empty pages give an empty text of length zero, so do pages with
no content.  Unclosed and misnested tags are closed by their parents' end.  Repeated rows
give a row each; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.common import each_batch, only

SMOOTHING = np.exp(-np.arange(-2, 3) ** 2 / 2.0)  # Gaussian of width one over two neighbours each way
THRESHOLD = 0.5  # of the page's spread of fused ratios
#: Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body br canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = set("script style textarea title noscript iframe noframes noembed xmp template svg math".split())
#: Tags, roles and class and id names whose text is never the article's.
NOT_CONTENT = set(
    "head nav footer header aside form button select option script style noscript iframe object template svg math "
    "textarea menu dialog noframes noembed".split()
)
NOT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOT_NAMES = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments consent cookie "
    "cookies copyright disclaimer disqus footer form header masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promoted promotion related replies reply respond share sharing shoutbox "
    "sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget".split()
)
ARTICLE_TAGS, ARTICLE_ROLES = {"article", "main"}, {"article", "main"}
KEPT, BY_NAME, ALWAYS = 0, 1, 2  # exclusion of a part; an article ends that by name
#: An open tag of the first kind ends where one of the second begins.
CLOSED_BY = {"p": BLOCKS - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
             "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
_MARK = re.compile(r"[.,;:!?…。，、！？；]")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(raw)} if raw.strip(" /\n\t\r") else {}


def _excluded(tag: str, own: dict[str, str]) -> int:
    if tag == "form":
        return BY_NAME
    if tag in NOT_CONTENT or own.get("role") in NOT_ROLES or "hidden" in own or own.get("aria-hidden") == "true":
        return ALWAYS
    if tag in ("html", "body") or tag in ARTICLE_TAGS:
        return KEPT
    return BY_NAME if any(w in NOT_NAMES for name in ("class", "id") for w in own.get(name, "").split()) else KEPT


class _Block:
    __slots__ = ("path", "parts", "linked", "article", "number")

    def __init__(self, path: str, article: int, number: int):
        self.path, self.parts, self.linked, self.article, self.number = path, [], 0, article, number


def blocks(page: str) -> list[_Block]:
    """The page's blocks of text outside excluded parts, in page order."""
    found: list[_Block] = []
    # Tag, exclusion, 1 inside an article within names excluded, 2 inside another, and that article's number.
    stack: list[tuple[str, int, int, int]] = []
    links, current, at, articles = 0, None, 0, 0

    def text(raw: str) -> None:
        nonlocal current
        if not raw or (stack and stack[-1][1]):
            return
        if current is None:
            if not raw.strip():
                return
            tags = [part[0] for part in stack]
            current = _Block("/".join(tags), *(stack[-1][2:] if stack else (0, 0)))
            found.append(current)
        current.parts.append(raw)
        if links:
            current.linked += len(raw.strip())

    while True:
        match = _TOKEN.search(page, at)
        if match is None:
            text(page[at:])
            return found
        text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCKS:
                current = None
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        if tag in BLOCKS:
            current, links = None, 0
        if tag in VOID:
            continue
        while stack and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        own = _attributes(match[3])
        above, article, number = stack[-1][1:] if stack else (KEPT, 0, 0)
        outside = max(above, _excluded(tag, own))
        if not article and (tag in ARTICLE_TAGS or own.get("role") in ARTICLE_ROLES):
            article, number, articles = 1 if above == BY_NAME else 2, articles, articles + 1
            if outside == BY_NAME:
                outside = KEPT
        if tag == "a":
            links += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag in BLOCKS or outside != above:
            stack.append((tag, outside, article, number))


def scores(found: list[_Block], bodies: list[str]) -> np.ndarray:
    """The fused ratio of every block; on a page with marked articles nothing for the blocks outside them."""
    letters, marks, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for block, body in zip(found, bodies):
        letters[block.path] += len(body) - block.linked
        marks[block.path] += len(_MARK.findall(body))
        nodes[block.path] += 1
    # Text and punctuation per node of the path; menus have many short nodes without marks.
    ratio = np.array([max(0, letters[b.path]) / nodes[b.path] * (1 + marks[b.path] / nodes[b.path]) for b in found])
    ratio = np.log1p(ratio)
    padded = np.pad(ratio, 2, mode="edge")
    smooth = np.convolve(padded, SMOOTHING / SMOOTHING.sum(), mode="valid")
    linked = np.array([min(1.0, b.linked / max(1, len(body))) for b, body in zip(found, bodies)])
    best = max(b.article for b in found)
    return np.sqrt(ratio * smooth) * (1 - linked) * np.array([b.article == best for b in found])


def select(found: list[_Block], bodies: list[str]) -> list[int]:
    """Indices of the content blocks."""
    if not found:
        return []
    fused = scores(found, bodies)
    content = fused > THRESHOLD * fused.std() if len(fused) > 1 else fused >= 0
    best = max(b.article for b in found)
    if not best:
        return np.flatnonzero(content).tolist()
    inside = [i for i, b in enumerate(found) if b.article == best]
    whole = {found[i].number for i in inside if content[i]} or {found[i].number for i in inside}
    return [i for i in inside if found[i].number in whole]


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    bodies = [_SPACE.sub(" ", html.unescape("".join(b.parts))).strip() for b in found]
    return " ".join(bodies[i] for i in select(found, bodies) if bodies[i])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page, from its whole html."""
    source = only(pages, page_id=id_col, url=url_col, html=html_col)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(p) for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    kinds = [source.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return source.mapInArrow(each_batch(make), f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
