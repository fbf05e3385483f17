"""Main text of web pages by line-block distribution (operator 5).

A page becomes lines: one per block element, with scripts, styles, comments and the
elements that are page furniture by name, role, class or id left out, unless they are or
hold an ``article`` or ``main``.  Class and id count by whole words of a short list; what
they leave in doubt the weights decide.  Each line weighs its text without link text; a heading, and a
paragraph of an article, weighs its linked text too.  The weights of ``WINDOW`` lines in a row are summed; where the
sums rise to the threshold is a surge point, where they fall below it again a dive point,
and the lines between them are the text.  The threshold is the same for all lines of the
page; a line with text of its own inside an ``article`` or ``main`` element, which says
itself where text is, weighs ``SURGE`` more, so that no such line is too short.  On a page where nothing
surges the paragraphs and headings are the text, and without any the heaviest line.

Cases: a null or empty page gives the empty text; unclosed elements, stray ends and
unfinished comments or tags are read as far as they go; furniture that is never closed
hides nothing; whole pages are read, however long; other columns are not needed.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Lines in a window, and the weight that makes a surge and that article and main add to a line.
WINDOW = 3
SURGE = 120

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^<>]*(?:>|\Z)", re.S)
RAW = frozenset("script style noscript template textarea title svg iframe object".split())
FURNITURE = frozenset("nav footer aside form head button select dialog menu".split())
CONTAINER = frozenset(("article", "main"))
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text, whose links belong to it.
PROSE = HEADINGS | frozenset("p blockquote pre figcaption".split())
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Whole class and id words that mark furniture, and roles that do.
MARKS = frozenset(
    "ad ads advert advertisement advertising sponsored navbar navigation breadcrumb breadcrumbs "
    "sidebar toolbar footer site-footer masthead comments comments-area comment-list disqus "
    "disqus_thread newsletter cookie-banner cookie-notice cookie-consent cookie-bar ad-slot ad-box "
    "advert-box related-posts related-articles share-buttons social-share social-links skip-link".split())
#: Class words that mark furniture on block elements only (``comment`` also names a part of code).
BLOCK_MARKS = frozenset("comment commentlist comment-form".split())
#: Ids that mark reader comments wherever they stand.
COMMENT_IDS = frozenset("respond disqus_thread".split())
UNSEEN = re.compile(r"display\s*:\s*none", re.I)
ROLES = frozenset("navigation banner complementary contentinfo search menu menubar toolbar dialog "
                  "alertdialog".split())
#: Elements whose id may mark furniture; ids of others are mostly made from headings.
NAMED = frozenset("div ul ol table".split())


def _is_furniture(name: str, attributes: str, inside: bool) -> bool:
    if name in FURNITURE or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" and value in ("", "hidden", "true") or key == "aria-hidden" and value == "true" \
                or key == "style" and UNSEEN.search(value):
            return True
        if key == "class" and name in BLOCK and not BLOCK_MARKS.isdisjoint(value.split()) \
                or key == "id" and name in NAMED and value in COMMENT_IDS:
            return True
        if key == "role" and not ROLES.isdisjoint(value.split()):
            return True
        if (key == "class" and name not in HEADINGS or key == "id" and name in NAMED and not inside) \
                and not MARKS.isdisjoint(value.split()):
            return True
    return False


def _tags(page: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, name, whether it ends an element, attributes) of every tag; comments, odd
    tags and raw elements with what they hold have no name."""
    tags = []
    at = 0
    while found := TOKEN.search(page, at):
        at = found.end()
        name, end = (found[2] or "").lower(), bool(found[1])
        if not end and name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?![\w-])[^>]*>?", re.I).search(page, at)
            if close:
                at = close.end()
            elif name in ("script", "style"):
                at = len(page)
            name = ""
        tags.append((found.start(), at, name, end, found[3] or ""))
    return tags


def _closings(tags: list) -> tuple[list[int], list[int]]:
    """For every tag the number of the tag that closes it (0: none), nested by name, and how
    many article and main elements begin up to it."""
    closing, begun = [0] * len(tags), []
    opened: dict[str, list[int]] = {}
    n = 0
    for i, (_, _, name, end, attributes) in enumerate(tags):
        if end:
            if opened.get(name):
                closing[opened[name].pop()] = i
        elif name and name not in VOID:
            n += name in CONTAINER
            if not attributes.endswith("/"):
                opened.setdefault(name, []).append(i)
        begun.append(n)
    return closing, begun


def page_lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, weight, whether in article or main, whether running text) of every line that is no furniture."""
    lines: list[tuple[str, int, bool, bool]] = []
    block = ""
    parts: list[str] = []
    linked = 0
    containers = links = 0
    tags = _tags(page)
    closing, begun = _closings(tags)

    def flush(inside: bool) -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            counts = block in HEADINGS or inside and block in PROSE
            lines.append((text, len(text) if counts else max(0, len(text) - linked), inside, block in PROSE))
        parts.clear()
        linked = 0

    def read(start: int, stop: int) -> None:
        nonlocal linked
        if stop > start:
            parts.append(page[start:stop])
            if links:
                linked += stop - start

    at = i = 0
    while i < len(tags):
        start, stop, name, end, attributes = tags[i]
        read(at, start)
        at = stop
        if name in BLOCK:
            flush(containers > 0)
            if name not in VOID:
                block = "" if end else name
        # an element that is article or main or holds one is never furniture
        if not end and closing[i] and name not in CONTAINER and begun[closing[i]] == begun[i] \
                and _is_furniture(name, attributes, containers > 0):
            i = closing[i]
            at = tags[i][1]
        elif name in CONTAINER:
            containers = max(0, containers + (-1 if end else 1))
        elif name == "a":
            links = 0 if end else 1
        i += 1
    read(at, len(page))
    flush(containers > 0)
    return lines


def main_text(page: str | None) -> str:
    """The text's lines, joined by line feeds."""
    lines = page_lines(page) if page else []
    if not lines:
        return ""
    weights = np.array([w for _, w, _, _ in lines], np.int64)
    inside = np.array([x for _, _, x, _ in lines], bool)
    # each side is read with the other side's lines as empty ones: the extra weight lifts
    # no line outside
    keep = between_surges(np.where(inside, 0, weights), SURGE) & ~inside
    keep |= between_surges(np.where(inside & (weights > 0), weights + SURGE, 0), SURGE) & inside
    if not keep.any():  # a page of short lines only: nothing surges
        prose = np.array([x for _, _, _, x in lines], bool) & (weights > 0)
        keep = prose if prose.any() else (np.arange(len(lines)) == weights.argmax()) & (weights > 0)
    return "\n".join(text for (text, *_), kept in zip(lines, keep) if kept)


def between_surges(weights: np.ndarray, threshold: int) -> np.ndarray:
    """Lines from a surge point to the next dive point, for all of them."""
    n = len(weights)
    total = np.concatenate(([0], np.cumsum(weights)))
    first = np.arange(n)
    sums = total[np.minimum(first + WINDOW, n)] - total[first]
    rise = np.diff(np.concatenate(([0], (sums >= threshold).astype(np.int8), [0])))
    keep = np.zeros(n, bool)
    heavy = np.flatnonzero(weights > 0)
    for surge, dive in zip(np.flatnonzero(rise == 1), np.flatnonzero(rise == -1)):
        # the windows of this stretch reach WINDOW - 1 lines past the last of them
        own = heavy[(heavy >= surge) & (heavy < min(n, dive + WINDOW - 1))]
        if len(own):
            keep[own[0]:own[-1] + 1] = True
    return keep


def extract_text(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` (code points) of every page; a narrow map."""
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(p) for p in part.column("__html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], [*keep, "text", "n_chars"])

    return pages.select(*keep, pages[html].alias("__html")).mapInArrow(run, schema)
