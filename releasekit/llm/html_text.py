"""Main-text extraction from flat text blocks.

A page is cut into text blocks at block-level tags; markup is not turned into a tree.  Each
block has its word count and link density, those of its two neighbours, the share of the page's
words that lie in an article, and the kind of area around it.  A decision tree, trained on the
pages of ``LABELLED`` below, classifies each block as text or furniture; where markup says nothing
of a block, its neighbours decide.

Areas: ``article`` and ``main`` (also as a role, or as a whole class name) are article; ``nav``,
``footer``, ``aside``, ``form`` and the like, and elements named so (``class="site-footer"``), are
furniture, also within an article.  A name that states a property (``has-sidebar``,
``comments-open``, ``no-ads``) says nothing, and names never make furniture of an article element.
A form or a named area around the main part of the page (it holds ``main``, or a first heading or
an article and over half of the words) is a wrapper and says nothing either.

Edge cases: null or empty html gives empty text; a page that ends inside a tag, comment or
script ends there, a tag without end ends where the next one begins; unclosed and stray tags and
quotes are tolerated; very long pages are processed whole, in time proportional to their length.
Every input row gives one row, repeated ones too; ids of any type stay.  Columns beyond
``page_id, url, html`` are ignored.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from releasekit.llm.base import byte_slices, query, table

FEATURES = ("region", "article_share", "words", "link_density", "prev_words", "prev_density", "next_words", "next_density")
FURNITURE, PLAIN, ARTICLE = -1, 0, 1
SLICE_BYTES = 8 << 20

#: Labelled pages, block after block: area (``a`` article, ``f`` furniture, ``.`` nothing known), words,
#: per cent of them in links, and 1 for main text.  Fixed values, labelled by hand.
LABELLED = (
    # a marked article between menus, an advert and a footer; headings, one-word paragraphs, linked phrases
    "f 1 100 0, f 1 100 0, f 1 100 0, f 9 0 0, a 8 0 1, a 60 0 1, a 1 0 1, a 45 10 1, a 6 100 1, a 30 0 1, a 2 0 1, f 12 0 0",
    # a marked article that is a list of links, with a menu before and comments marked as such after
    "f 1 100 0, f 2 100 0, a 5 0 1, a 7 100 1, a 6 100 1, a 8 90 1, a 25 20 1, f 3 0 0, f 40 0 0, f 35 5 0, f 28 0 0",
    # marked articles of short lines
    "a 1 0 1, a 2 0 1, a 1 0 1, a 3 0 1, a 90 0 1, a 2 0 1, a 1 0 1", "f 1 100 0, a 6 0 1, a 1 0 1, a 1 0 1, a 2 0 1, f 3 0 0", "a 3 0 1", "a 1 0 1, a 1 100 1, a 2 0 1, a 1 50 1",
    "f 2 100 0, a 4 0 1, a 50 0 1, a 1 0 1, a 2 0 1, a 40 0 1, a 3 0 1, a 1 0 1, f 9 0 0", "a 5 0 1, a 1 0 1, a 70 0 1, a 1 0 1, a 2 100 1",
    # a marked article, then comments and teasers that nothing marks
    "f 1 100 0, a 7 0 1, a 80 0 1, a 95 5 1, a 70 0 1, . 2 0 0, . 30 0 0, . 2 0 0, . 45 0 0, . 38 0 0, . 6 100 0, . 20 80 0",
    "a 9 0 1, a 120 0 1, a 14 0 1, a 88 0 1, . 3 0 0, . 24 0 0, . 26 0 0, . 3 100 0, f 6 30 0",
    # a short teaser marked as an article beside a long text that nothing marks
    "f 1 100 0, . 6 0 1, . 75 0 1, . 90 5 1, . 12 0 1, . 66 0 1, a 4 100 1, a 14 20 1, f 20 10 0",
    # nothing marked: menu, heading, paragraphs long and short, subheadings, footer
    ". 1 100 0, . 1 100 0, . 2 100 0, . 1 100 0, . 8 0 1, . 70 0 1, . 45 8 1, . 4 0 1, . 60 0 1, . 9 0 1, . 52 0 1, . 3 100 0, . 4 50 0",
    ". 3 90 0, . 2 100 0, . 2 100 0, . 12 0 1, . 35 0 1, . 28 15 1, . 6 0 1, . 40 0 1, . 18 0 1, . 33 0 1, . 5 80 0, . 4 100 0, . 7 60 0",
    ". 2 100 0, . 4 100 0, . 2 100 0, . 6 0 1, . 24 0 1, . 19 0 1, . 22 10 1, . 16 0 1, . 27 0 1, . 2 100 0, . 3 100 0, . 2 100 0",
    # a page of one long paragraph, and one of a few, without anything else
    ". 150 0 1", ". 40 0 1, . 65 0 1", ". 5 0 1, . 90 10 1, . 30 0 1", ". 22 0 1, . 18 0 1, . 30 0 1",
    # portals: teasers whose headings are links, lists of links, labels
    ". 1 100 0, . 6 100 0, . 9 70 0, . 5 100 0, . 12 60 0, . 7 100 0, . 3 100 0, . 2 0 0, . 2 100 0",
    ". 2 100 0, . 2 0 0, . 3 0 0, . 1 100 0, . 4 0 0, . 2 100 0, . 5 0 0, . 1 100 0",
    ". 2 100 0, . 5 0 0, . 3 100 0, . 6 0 0, . 2 100 0, . 8 0 0, . 1 100 0, . 9 0 0, . 2 100 0, . 11 0 0, . 3 100 0",
    # headings of a word or two between paragraphs; short captions between links; a last line
    ". 1 100 0, . 2 0 1, . 60 0 1, . 1 0 1, . 48 0 1, . 3 0 1, . 55 5 1, . 2 0 1, . 70 0 1, . 2 100 0",
    ". 6 0 0, . 1 100 0, . 7 0 1, . 40 0 1, . 1 0 1, . 12 0 1, . 3 0 1, . 65 0 1, . 1 0 1, . 9 0 1, . 44 0 1, . 2 100 0",
    ". 1 100 0, . 40 0 1, . 2 0 1, . 40 0 1, . 2 0 1, . 38 0 1, . 1 0 1, . 42 0 1, . 2 100 0", ". 30 0 1, . 1 0 1, . 25 0 1, . 2 0 1, . 90 0 1, . 3 0 1, . 20 0 1",
    # short lines at the end of a page or before its menu, which nothing marks
    ". 2 0 0, . 1 100 0, . 2 100 0, . 9 0 1, . 62 0 1, . 58 4 1, . 4 0 1, . 71 0 1, . 3 0 0, . 2 0 0",
    ". 1 100 0, . 90 0 1, . 85 0 1, . 1 0 0", ". 2 100 0, . 30 0 1, . 42 0 1, . 27 0 1, . 2 0 0, . 4 0 0", ". 3 0 0, . 1 100 0, . 50 0 1, . 44 0 1, . 5 0 0",
    # long paragraphs of links (tag clouds, lists of archives) around text
    ". 40 95 0, . 7 0 1, . 55 0 1, . 48 5 1, . 30 90 0, . 60 100 0",
    ". 25 85 0, . 2 100 0, . 10 0 1, . 85 0 1, . 11 0 1, . 72 20 1, . 35 100 0, . 3 0 0, . 2 100 0",
)

SKIPPED = frozenset("script style title textarea noscript iframe template select button svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TRACKED = frozenset("nav header footer aside form dialog menu article main section div ul ol dl table td body figure fieldset details p".split())
#: Kinds of areas.
BY_TAG, HEADER, FORM, NAMED, COMMENTS, TEXT = range(6)
TAG_KINDS = dict.fromkeys("nav footer aside dialog menu".split(), BY_TAG) | {"header": HEADER, "form": FORM}
ARTICLE_TAGS = frozenset("article main".split())
COMMENT_WORDS = frozenset("comment comments reply replies discussion disqus".split())
FURNITURE_WORDS = COMMENT_WORDS | frozenset(
    "nav navigation navbar menu menubar sidebar footer header masthead banner ad ads adv advert advertisement adverts promo promotion sponsor sponsored "
    "cookie cookies consent gdpr notice notices popup modal overlay share sharing social related recommended "
    "breadcrumb breadcrumbs newsletter subscribe subscription signup login search searchbox widget widgets pagination pager copyright legal contentinfo complementary toolbar".split())
ARTICLE_WORDS = frozenset("article articlebody content main post entry story".split())
#: Words that go with one of ARTICLE_WORDS in a name of an article; words that make a name a property.
ARTICLE_PARTS = ARTICLE_WORDS | frozenset("body text area inner container wrapper page single".split())
STATE_WORDS = frozenset("has no not with without is are show hide open opened closed enabled disabled on off category tag type format status".split())

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|!--|[!?/])")
_STOP = re.compile(r"[<>]|=\s*([\"'])")
_HINT = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in SKIPPED}


def _named(attributes: str) -> tuple[bool, set[str]]:
    """Whether a class, id or role names an article, and the words of names of furniture."""
    article, furniture = False, set()
    for m in _HINT.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = set(re.split(r"[^a-z]+", name)) - {""}
            article |= bool(parts) and parts <= ARTICLE_PARTS and bool(parts & ARTICLE_WORDS)
            if not parts & STATE_WORDS:
                furniture |= parts & FURNITURE_WORDS
    return article, furniture


def _kind(tag: str, attributes: str) -> int | None:
    """The kind of area that an element opens, if any."""
    article, furniture = _named(attributes) if attributes and tag != "body" else (False, set())
    if furniture & COMMENT_WORDS:
        return COMMENTS
    if tag in ARTICLE_TAGS:
        return TEXT
    if tag in TAG_KINDS:
        return TAG_KINDS[tag]
    return TEXT if article else NAMED if furniture else None


def _pieces(page: str) -> Iterator[tuple[str, str, str, str, int]]:
    """``(text, slash, tag, attributes, end)`` for each tag and the text before it; tag ``""`` at
    other markup and at the end.  The caller may send a place to go on from.  Every character is
    looked at a bounded number of times."""
    at, missing = 0, set()
    while at < len(page):
        m = _MARK.search(page, at)
        if not m:
            yield page[at:], "", "", "", len(page)
            return
        text, slash, tag, end = page[at:m.start()], m[1] or "", (m[2] or "").lower(), m.end()
        attributes = ""
        if tag:
            while True:
                stop = _STOP.search(page, end)
                if not stop:
                    attributes, end = page[m.end():], len(page)
                    break
                if stop[1]:  # a quoted value
                    close = -1 if stop[1] in missing else page.find(stop[1], stop.end())
                    if close < 0:
                        missing.add(stop[1])
                    end = max(stop.end(), close + 1)
                    continue
                attributes, end = page[m.end():stop.start()], stop.end() if stop[0] == ">" else stop.start()
                break
        else:
            mark = "-->" if m[0] == "<!--" else ">"
            close = page.find(mark, end)
            end = close + len(mark) if close >= 0 else len(page)
        at = (yield text, slash, tag, attributes, end) or end


def blocks(page: str) -> list[tuple[str, int, float, int]]:
    """``(text, words, link density, region)`` of each block with text, in page order."""
    found: list[tuple[str, int, float, int]] = []
    text: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int]] = [("", 0)]
    opened: Counter[str] = Counter()
    areas: list[list] = [[None, -1, 0, set()]]  # kind, area around it, words, what it holds
    in_link = False

    def flush() -> None:
        if text:
            whole = _SPACE.sub(" ", html_lib.unescape("".join(text))).strip()
            if whole:
                n = whole.count(" ") + 1
                links = len(html_lib.unescape(" ".join(linked)).split()) if linked else 0
                found.append((whole, n, min(1.0, links / n), stack[-1][1]))
                areas[stack[-1][1]][2] += n
            text.clear()
            linked.clear()

    def close(tag: str) -> None:
        while opened[tag]:
            last = stack.pop()[0]
            opened[last] -= 1
            if last == tag:
                return

    pieces = _pieces(page)
    goto = None
    while True:
        try:
            piece, slash, tag, attributes, end = pieces.send(goto)
        except StopIteration:
            break
        goto = None
        if piece:
            text.append(piece)
            if in_link:
                linked.append(piece)
        if not tag:
            continue
        if tag in SKIPPED:
            if not slash and not attributes.endswith("/"):
                m = _END[tag].search(page, end)
                goto = m.end() if m else len(page)
            if tag != "button":
                text.append(" ")
        elif tag in INLINE:
            if tag == "a":
                in_link = not slash
            elif tag == "br":
                text.append(" ")
        else:
            flush()
            in_link = False
            if not slash and (tag == "h1" or tag in ARTICLE_TAGS):
                areas[stack[-1][1]][3].add(tag)
            if tag in VOID or tag not in TRACKED:
                continue
            if slash:
                close(tag)
                continue
            if tag == "p" and stack[-1][0] == "p":  # a paragraph ends where the next one begins
                close("p")
            area, kind = stack[-1][1], _kind(tag, attributes)
            if kind is not None:
                areas.append([kind, area, 0, set()])
                area = len(areas) - 1
            stack.append((tag, area))
            opened[tag] += 1
    flush()
    regions = _regions(areas)
    return [(whole, n, links, regions[area]) for whole, n, links, area in found]


def _regions(areas: list[list]) -> list[int]:
    """What each area says of its blocks; an area stands after the one around it."""
    for _, around, words, holds in reversed(areas):
        if around >= 0:
            areas[around][2] += words
            areas[around][3] |= holds
    total, out = areas[0][2], [PLAIN]
    for kind, around, words, holds in areas[1:]:
        most, outer = 2 * words > total, out[around]
        wrapper = {BY_TAG: False, HEADER: outer == ARTICLE or bool(holds & ARTICLE_TAGS), FORM: most or bool(holds & {"main", "article", "h1"}),
                   NAMED: "main" in holds or (most and bool(holds)), COMMENTS: "main" in holds or (most and "h1" in holds), TEXT: outer == FURNITURE}[kind]
        out.append(outer if wrapper else ARTICLE if kind == TEXT else FURNITURE)
    return out


def features(found: list[tuple]) -> np.ndarray:
    """One row of FEATURES per block ``(..., words, link density, region)``; beyond the page,
    neighbours have no words and no links."""
    words = np.array([0, *(b[-3] for b in found), 0], float)
    density = np.array([0, *(b[-2] for b in found), 0], float)
    region = np.array([b[-1] for b in found], float)
    inner, outer = words[1:-1][region == ARTICLE].sum(), (words * (1 - density))[1:-1][region == PLAIN].sum()
    share = np.full(len(found), inner / max(inner + outer, 1))
    return np.column_stack([region, share, words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]])


def train_tree(rows: np.ndarray, labels: np.ndarray, min_leaf: int = 2) -> tuple:
    """A CART tree by Gini impurity: ``(feature, threshold, low, high)`` or a leaf's label."""
    p = labels.mean()
    best = (p * (1 - p) * len(labels) - 1e-9, -1, 0.0)
    if 0 < p < 1:
        for f in range(rows.shape[1]):
            values = np.unique(rows[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = rows[:, f] <= cut
                if min(low.sum(), (~low).sum()) >= min_leaf:
                    impurity = sum(len(x) * x.mean() * (1 - x.mean()) for x in (labels[low], labels[~low]))
                    if impurity < best[0]:
                        best = (impurity, f, cut)
    if best[1] < 0:
        return (int(p >= 0.5),)
    low = rows[:, best[1]] <= best[2]
    return best[1], float(best[2]), train_tree(rows[low], labels[low], min_leaf), train_tree(rows[~low], labels[~low], min_leaf)


@functools.cache
def default_tree() -> tuple:
    rows, labels = [], []
    for page in LABELLED:
        said = [x.split() for x in page.split(", ")]
        rows.append(features([(int(n), int(links) / 100, {"a": ARTICLE, "f": FURNITURE, ".": PLAIN}[area]) for area, n, links, _ in said]))
        labels += [int(x[3]) for x in said]
    return train_tree(np.concatenate(rows), np.array(labels))


def classify(tree: tuple, rows: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(rows), bool(tree[0]))
    low = rows[:, tree[0]] <= tree[1]
    out = np.empty(len(rows), bool)
    out[low], out[~low] = classify(tree[2], rows[low]), classify(tree[3], rows[~low])
    return out


def main_text(page: str | None, tree: tuple | None = None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = classify(tree or default_tree(), features(found))
    return "\n".join(b[0] for b, k in zip(found, keep, strict=True) if k)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` per page; no shuffle, pages stay where they are read."""
    page_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in byte_slices(batches, "html", SLICE_BYTES):
            text = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.utf8()), pa.array([len(t) for t in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {page_type}, url string, text string, n_chars long")


@query("op7_main_text")
def op7_main_text(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))
