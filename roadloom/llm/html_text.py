"""Main text of web pages by tag-path ratios.

A page is cut into text blocks, each with the path of block elements from the root to it: tag names, and for containers
their class words, without numbers, so that equal paths come together. For every path the length of its blocks' text
(without link text) and their punctuation marks are summed and divided by the number of blocks. Both ratios are fused into
one value, which is smoothed along the page by a Gaussian, averaged per path again, and weighed by what element names,
roles, classes and ids tell: nothing for menus, footers, sidebars, dialogs, buttons and hidden elements, little where only a
class or id word tells boilerplate, a form too (unless most of the page's text lies in it, and a title or an article too or
hardly any text elsewhere). Paths whose value reaches a share of the page's best are content paths.

All blocks of content paths are text. So are the other blocks (headings, link lists, short lines) of the article element
that holds some of them or, where there is no such element, of the containers that hold them or lie round these, unless
they are marked as boilerplate by themselves. Blocks between the first and the last of content paths that stand right in
the body belong to it too.

Character references are decoded, white space in a block becomes one blank, blocks are trimmed and joined by one line
feed. Null or empty html, and pages without content, give the empty string. A page that is cut off in the middle is read
as far as it goes. Repeated rows each get a row; an empty table gives an empty table.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Names of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't text of the page; those of the second kind are skipped only if they are closed.
RAW = frozenset("script style textarea title".split())
EMBEDDED = frozenset("noscript template svg math iframe object canvas audio video select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
HEAD_ONLY = RAW | EMBEDDED | VOID
TEXT_LEVEL = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote figure figcaption table caption thead tbody tfoot tr td th details summary address hgroup header".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: An opening tag also ends an open one of these names, up to the nearest of the stops.
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",))}
NEVER = frozenset("nav aside footer button dialog menu head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A class or id word tells boilerplate if all its parts are of these two lists and one is of the first.
MARKS = frozenset("nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer foot sidebar side aside widget widgets cookie cookies consent gdpr notice notices banner popup modal newsletter subscribe signup login share sharing social ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended comment comments disqus respond form search toolbar pagination pager skip copyright legal".split())
NEUTRAL = frozenset("area articles bar block body bottom box buttons col container content inner item items left link links list main outer page panel posts right row secondary section site slot stories text to top unit wrap wrapper".split())
#: Marks that an id of a heading, paragraph or section doesn't tell, as it may be an anchor of that name.
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th pre blockquote section".split())
SECTION_MARKS = frozenset("comments respond disqus sidebar footer header nav menu share related ads".split())
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、¿¡]")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")

SMOOTH, SHARE, SOFT = 1.0, 0.4, 0.08


def marked(word: str, marks: frozenset[str] = MARKS) -> bool:
    parts = [x.lower() for x in _PARTS.split(word) if x]
    return any(x in marks for x in parts) and all(x in marks or x in NEUTRAL for x in parts)


def _weight(tag: str, attributes: dict[str, str], in_article: bool, below_body: bool) -> float:
    """1, SOFT or 0: what the element's own names tell."""
    style = attributes.get("style", "").replace(" ", "").lower()
    if tag in NEVER or (tag == "header" and below_body) or attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        return 0.0
    if tag in ("html", "body", "article", "main"):
        return 1.0
    words, name = attributes.get("class", "").split(), attributes.get("id", "").strip()
    if in_article:  # an article has headers of its own
        words = [w for w in words if not marked(w, frozenset(("header", "masthead", "banner")))]
    if tag in ("form", "fieldset") or any(marked(w) for w in words):
        return SOFT
    return SOFT if name and (name.lower() in SECTION_MARKS if tag == "section" else tag not in ANCHORS and marked(name)) else 1.0


@dataclass
class Block:
    path: int
    text: str
    linked: int  # characters of link text
    weight: float
    soft: tuple[int, ...]  # the numbers of elements round it that only a word or a form marks
    container: int  # the number of the innermost element that isn't of the text level
    article: int  # the number of the outermost article, else main element; 0 without one
    in_header: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    paths: list[tuple[int, str]] = field(default_factory=lambda: [(-1, "")])  # of each path the one above and the last step
    parents: list[int] = field(default_factory=lambda: [0])  # of each element the container round it
    bodies: set[int] = field(default_factory=lambda: {0})  # numbers of html and body elements

    def steps(self, path: int) -> tuple[str, ...]:
        out = []
        while path:
            path, step = self.paths[path]
            out.append(step)
        return tuple(reversed(out))


@dataclass
class _Open:
    tag: str
    path: int
    number: int
    weight: float
    soft: tuple[int, ...]
    container: int
    article: int
    in_header: bool


def read(page: str) -> Page:
    """The blocks of a page, in order."""
    out = Page()
    known: dict[tuple[int, str], int] = {}
    stack: list[_Open] = [_Open("", 0, 0, 1.0, (), 0, 0, False)]
    text: list[str] = []
    linked = in_link = 0
    open_p = 0

    def flush() -> None:
        nonlocal linked
        if text:
            block = _SPACE.sub(" ", "".join(text)).strip()
            if block:
                top = stack[-1]
                out.blocks.append(Block(top.path, block, min(linked, len(block)), top.weight, top.soft, top.container, top.article, top.in_header))
            text.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal open_p
        flush()
        open_p -= sum(x.tag == "p" for x in stack[upto:])
        del stack[upto:]

    def innermost(tag: str) -> int:
        return next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            piece = _html.unescape(page[at:stop])
            text.append(piece)
            linked += len(piece.strip()) if in_link else 0
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag, inside = m[2].lower(), m[3].removesuffix(">")
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag == "br" or tag == "p" and not open_p:
                flush()
            elif tag not in INLINE and (k := innermost(tag)):
                close(k)
            continue
        if tag in RAW or tag in EMBEDDED:
            if not inside.endswith("/"):
                m = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = m.end() if m else at if tag in EMBEDDED else end
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:  # its end tag may be left out
            close(len(stack) - 1)
        if tag in VOID:
            if tag in ("br", "hr"):
                text.append(" ") if tag == "br" else flush()
            continue
        if tag in INLINE:
            in_link += tag == "a"
            continue
        flush()
        in_link = 0
        if tag in CLOSES_P and open_p:
            close(innermost("p"))
        if tag in SIBLINGS:
            ends, stops = SIBLINGS[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in stops:
                    break
        if inside.endswith("/") and tag not in CLOSES_P:
            continue
        attributes = {name.lower(): "".join(values) for name, *values in _ATTRIBUTE.findall(inside)} if inside else {}
        above, number = stack[-1], len(out.parents)
        is_text = tag in TEXT_LEVEL and not (tag == "header" and above.container in out.bodies)
        step = tag if is_text else ".".join([tag, *sorted(re.sub(r"\d+", "", w) for w in attributes.get("class", "").split())])
        path = known.setdefault((above.path, step), len(out.paths))
        if path == len(out.paths):
            out.paths.append((above.path, step))
        if tag in ("html", "body"):
            out.bodies.add(number)
        out.parents.append(above.container)
        own = _weight(tag, attributes, above.article > 0, above.container in out.bodies)
        weight, soft = min(above.weight, own), (*above.soft, number) if own == SOFT else above.soft
        article = above.article if above.article > 0 else number if tag == "article" else above.article or (-number if tag == "main" else 0)
        stack.append(_Open(tag, path, number, weight, soft, above.container if is_text else number, article, above.in_header or tag == "header"))
        open_p += tag == "p"
    flush()
    _free(out)
    return out


def _free(page: Page) -> None:
    """Lifts the marks of softly marked elements that hold most of the text, and a title or article or nearly all of it."""
    held: dict[int, int] = {}
    titled: set[int] = set()
    total = unmarked = 0
    for b in page.blocks:
        if b.weight:
            n = len(b.text) - b.linked
            total += n
            unmarked += n if not b.soft else 0
            for k in b.soft:
                held[k] = held.get(k, 0) + n
            if b.soft and (b.article or page.paths[b.path][1] == "h1"):
                titled.update(b.soft)
    freed = {k for k, n in held.items() if 2 * n > total and (k in titled or 5 * unmarked < total)}
    for b in page.blocks:
        if b.weight == SOFT and freed.issuperset(b.soft):
            b.weight = 1.0


def path_values(page: Page) -> tuple[np.ndarray, np.ndarray]:
    """Paths with blocks that may be text, and the value of each: ratios, fused, smoothed along the page and weighed."""
    blocks = [b for b in page.blocks if b.weight]
    paths, of = np.unique(np.array([b.path for b in blocks], int), return_inverse=True)
    count = np.bincount(of)
    length = np.bincount(of, [len(b.text) - b.linked for b in blocks]) / count
    marks = np.bincount(of, [len(PUNCTUATION.findall(b.text)) for b in blocks]) / count
    fused = np.log1p(length) * (1 + np.log1p(marks)) * (length > 0)
    weight = np.bincount(of, [b.weight for b in blocks]) / count
    reach = np.arange(-3, 4)
    kernel = np.exp(-((reach / SMOOTH) ** 2) / 2)
    line = np.convolve(np.pad((fused * weight)[of], 3, mode="edge"), kernel / kernel.sum(), mode="valid")
    smooth = np.bincount(of, line) / count
    return paths, weight * np.sqrt(fused * np.maximum(smooth, fused * weight))


def main_text(page: str | None) -> str:
    """The article's blocks joined by line feeds."""
    parsed = read(page) if page else Page()
    blocks = [b for b in parsed.blocks if b.weight]
    if not blocks:
        return ""
    paths, value = path_values(parsed)
    if not value.max():
        return ""
    content = set(paths[value >= SHARE * value.max()].tolist())
    hits = [k for k, b in enumerate(blocks) if b.path in content]
    # what the content lies in, and the least weight of content there
    articles: dict[int, float] = {}
    holds: dict[int, float] = {}
    around: set[int] = set()
    for b in (blocks[k] for k in hits):
        if b.article:
            articles[b.article] = min(b.weight, articles.get(b.article, 1.0))
        holds[b.container] = min(b.weight, holds.get(b.container, 1.0))
        at = b.container
        while at not in around and at not in parsed.bodies:
            around.add(at)
            at = parsed.parents[at]
    real = {a for a in articles if a > 0}  # a main element counts only where no article holds content
    out = []
    for k, b in enumerate(blocks):
        if b.path in content:
            out.append(b.text)
        elif b.article in articles and (b.article > 0 or not real):
            if b.weight >= articles[b.article]:
                out.append(b.text)
        elif b.container in parsed.bodies:
            if b.weight == 1 and hits[0] < k < hits[-1]:
                out.append(b.text)
        elif b.container in holds:
            if b.weight >= holds[b.container]:
                out.append(b.text)
        elif b.container in around and b.weight == 1 and not b.in_header and b.linked < len(b.text):
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    slim = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[html].cast("string").alias("html"))
    return slim.mapInArrow(work, "page_id long, url string, text string, n_chars long")
