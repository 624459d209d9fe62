"""Main text of web pages: flat text blocks, shallow features of each and its neighbours, a decision tree.

A page is read as a flat list of text blocks. A block's features are its number of
words and the share of them inside links, the same of the block before and after,
and whether the nearest telling container is one of main text or one of menus,
adverts and the like. The tree is trained on the labelled blocks of
``page_examples``.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.page_examples import PAGES, variants
from lumbung.llm.tables import named, short_batches
from lumbung.llm.trees import Tree, grow, value_of

DEPTH = 8

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)(?:>|\Z)"""
    r"""|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)

# Elements whose content is not text of the page, up to their closing tag.
RAW = {"script", "style", "title", "noscript", "template", "iframe", "textarea", "svg", "object", "select", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
OUTSIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "head"}
INSIDE = {"article", "main"}
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "contentinfo", "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "pagination", "popup", "promo", "related", "reply", "respond", "search", "share", "sharing",
    "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar", "complementary",
}
INSIDE_NAMES = {"article", "content", "entry", "main", "maincontent", "post", "story"}
COMMENT_NAMES = {"comment", "comments", "reply", "disqus"}
WITHOUT_MEANING = {"has", "with", "no"}  # begin names that tell what else is on the page
# In CLOSED, which is OTHER to the tree, names of main text don't count.
NEUTRAL, MAIN, OTHER, CLOSED = 0, 1, 2, 3


def container(name: str, attributes: str, around: int) -> int:
    """What an element says about the text in it; otherwise what its surroundings say."""
    named_as: list[set[str]] = []
    if "=" in attributes or "hidden" in attributes.lower():
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return CLOSED
            if key == "style":
                if "display:none" in value.replace(" ", ""):
                    return CLOSED
            else:
                words = [re.split(r"[^a-z0-9]+", one) for one in value.split()]
                named_as += [set(one) for one in words if one[0] not in WITHOUT_MEANING]
    of_comments = any(one & COMMENT_NAMES for one in named_as)
    if name in INSIDE:
        return CLOSED if of_comments else MAIN
    if name in OUTSIDE or name == "header" and around != MAIN:
        return CLOSED
    if name in ("html", "body"):
        return around
    outside = [
        bool(one & OUTSIDE_NAMES) or name != "header" and "header" in one and around != MAIN for one in named_as
    ]
    inside = any(one & INSIDE_NAMES and not out for one, out in zip(named_as, outside))
    if around == CLOSED:
        return CLOSED
    if any(outside):
        # Names of both kinds leave it to the words and links.
        return NEUTRAL if inside and around != OTHER else CLOSED if of_comments else OTHER
    if inside:
        return NEUTRAL if around == OTHER else MAIN
    return around


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, container) of each block with text, in page order."""
    found: list[tuple[str, int, int, int]] = []
    stack: list[tuple[str, int]] = []  # open elements that matter, with what they say
    open_names: Counter[str] = Counter()  # so that a closing tag without an open element costs nothing
    parts: list[str] = []
    linked: list[str] = []
    links = 0

    def close_block() -> None:
        words = "".join(parts).split()
        if words:
            in_links = len("".join(linked).split())
            found.append((" ".join(words), len(words), min(in_links, len(words)), min(stack[-1][1], OTHER) if stack else NEUTRAL))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        text = html.unescape(text)
        parts.append(text)
        if links:
            linked.append(text)

    at = 0
    while match := MARKUP.search(page, at):
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        name = (match["name"] or match["name2"] or "").lower()
        closing = match["close"] or match["close2"]
        rest = match["rest"] if match["name"] else match["rest2"]
        if not name:
            continue
        if name == "svg" and not closing and rest.endswith("/"):
            continue
        if name in RAW and not closing:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            add(" ")
        elif name == "a":
            links = 0 if closing else 1
            linked.append(" ")
        elif name in BLOCKS:
            close_block()
            links = 0
            if not closing and name not in VOID:
                if name == "p" and stack and stack[-1][0] == "p":
                    open_names[stack.pop()[0]] -= 1
                open_names[name] += 1
                stack.append((name, container(name, rest or "", stack[-1][1] if stack else NEUTRAL)))
            elif closing and open_names[name]:
                closed = ""
                while closed != name:
                    closed = stack.pop()[0]
                    open_names[closed] -= 1
    if at < len(page):
        add(page[at:])
    close_block()
    return found


def features(found: list[tuple[str, int, int, int]]) -> list[tuple[float, ...]]:
    shallow = [(words, linked / words) for _, words, linked, _ in found]
    edge = (0, 0.0)
    around = [edge, *shallow, edge]
    return [
        (*around[i + 1], *around[i], *around[i + 2], float(found[i][3] == MAIN), float(found[i][3] == OTHER))
        for i in range(len(found))
    ]


@functools.cache
def trained() -> Tree:
    rows, labels = [], []
    for page in (variant for examples in PAGES for variant in variants(examples)):
        rows += features(blocks("".join(opening + text + closing for _, opening, text, closing in page)))
        labels += [float(label == "+") for label, *_ in page]
    return grow(np.array(rows), np.array(labels), np.ones(len(labels)), DEPTH)


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return "\n\n".join(block[0] for block, row in zip(found, features(found)) if value_of(tree, row) >= 0.5)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page, or one without main text, has an empty text. Null ids and addresses stay null;
    repeated pages come out repeated.
    """
    short_batches(pages.sparkSession)
    tree = trained()

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, tree) if page else "" for page in batch.column("html").to_pylist()]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                }
            )

    wanted = pages.select(
        named("page_id").cast("long").alias("page_id"),
        named("url").cast("string").alias("url"),
        named("html").cast("string").alias("html"),
    )
    return wanted.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
