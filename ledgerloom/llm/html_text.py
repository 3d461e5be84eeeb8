"""Main text of web pages by line-block distribution.

Markup is stripped into lines: a block element's edges end a line, inline markup vanishes. Text of
regions that are no article by their element, role, class or id (menus, adverts, comments, ...) leaves no
weight, and neither does text inside links; a region's edge is as wide as a window, so that no
window looks over it. Text lengths are summed over sliding windows of ``WINDOW`` lines. A surge is where
the sum rises to the page's threshold, a dive where it falls to nothing again; from the first line
with text before a surge to its dive all lines are kept.

Where a page marks its article (``article``, ``main`` or their roles), sums are taken inside it alone and any
text is a surge. Elsewhere the threshold is ``SURGE`` characters, or a quarter of the page's largest sum
where that is less, so that short pages keep their text.

Defined results: null and empty pages, and pages without text, give an empty text. Markup that a
truncated page leaves open ends with the page. Character references are decoded after markup is
stripped, so decoded angle brackets are text. Rows and ids may repeat; every row is a page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import prepare

WINDOW = 3
SURGE = 80

# Comments, elements whose content is no markup, declarations, then tags. An attribute's value may hold ">".
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|template|iframe|svg|math|select|object|canvas|audio|video)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:(?<=/)>|>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-z][^>]*(?:>|\Z)"  # a quote that is never closed
    r"|</[^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr output progress q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, roles and words of classes and ids whose text belongs to no article.
REGIONS = frozenset("nav aside footer form button fieldset menu dialog datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot adunit sponsor sponsored sponsors promo promos promotion promotions banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead header footer sidebar sidebars aside rail widget widgets "
    "cookie cookies cookiebar consent gdpr notice notices notification notifications alert alerts disclaimer popup modal overlay lightbox paywall "
    "subscribe subscription newsletter signup login share sharing social related recommended recommendations "
    "comment comments commentlist respond replies reply disqus reviews feedback search searchbox form forms hidden copyright skip".split()
)
#: Class names that begin with one of these tell what the element has or lacks, not what it is.
TELLING = frozenset("has have with without no not is show hide open".split())
#: How surely an element is the article.
ARTICLE = {"article": 2, "main": 1}
#: Elements that the next one of their kind ends; a paragraph ends at any block.
UNCLOSED = frozenset("p li dt dd tr td th".split())
COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b)", re.IGNORECASE)
CUT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z0-9])(?=[A-Z])")
OUT = -1


def names_region(value: str, inside: bool) -> bool:
    """Whether a class or id names a region without article text; an article's own header holds its title."""
    for name in value.split():
        words = [w.lower() for w in CUT.split(name) if w]
        if words and words[0] not in TELLING and not WORDS.isdisjoint(words) and not (inside and "header" in words):
            return True
    return False


def region_of(name: str, rest: str, inside: bool) -> int:
    """OUT for regions without article text, how surely it is the article for others, else 0."""
    if name in REGIONS or name == "header" and not inside:
        return OUT
    kind = ARTICLE.get(name, 0)
    if "=" not in rest and "hidden" not in rest.lower():
        return kind
    for word, *values in ATTRIBUTE.findall(rest):
        word, value = word.lower(), next(filter(None, values), "")
        if word == "role":
            if value.lower() in ROLES:
                return OUT
            kind = kind or ARTICLE.get(value.lower(), 0)
        elif word == "hidden" or word == "aria-hidden" and value.lower() == "true":
            return OUT
        elif word == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return OUT
        elif word in ("class", "id") and name not in ("html", "body", "main"):
            # An article may be called a promotion or a notice, but a reader's comment is none.
            if "comment" in value.lower() if name == "article" else names_region(value, inside):
                return OUT
    return kind


class Lines:
    """Lines of a page: text, the length that counts, and how surely they lie in the article (0: outside)."""

    def __init__(self, page: str):
        self.texts, self.weights, self.places = [], [], []
        self.parts, self.linked, self.link = [], 0, False
        self.open: list[list] = []  # [name, kind] of regions, and of plain elements that one of the same name encloses
        self.out, self.inside = 0, []
        at = 0
        for token in TOKEN.finditer(page):
            self.text(page[at:token.start()])
            at = token.end()
            if token["name"]:
                self.tag(token["name"].lower(), token["rest"], bool(token["close"]))
            elif token["raw"]:
                self.end()
        self.text(page[at:])
        self.end()

    def text(self, piece: str) -> None:
        if piece and not self.out:
            self.parts.append(piece)
            if self.link:
                self.linked += len(" ".join(html.unescape(piece).split())) + 1

    def end(self) -> None:
        """End the line that is being gathered."""
        line = " ".join(html.unescape("".join(self.parts)).split())
        if line:
            self.texts.append(line)
            self.weights.append(max(len(line) - self.linked, 0))
            self.places.append(max(self.inside, default=0))
        self.parts, self.linked = [], 0

    def edge(self) -> None:
        """As many empty lines as a window has."""
        self.end()
        self.texts += [""] * WINDOW
        self.weights += [0] * WINDOW
        self.places += [0] * WINDOW

    def close(self, first: int) -> None:
        """End open elements from the one at ``first`` on."""
        for name, kind in reversed(self.open[first:]):
            if kind:
                self.edge()
            elif name not in INLINE:
                self.end()
            if kind == OUT:
                self.out -= 1
            elif kind:
                self.inside.pop()
        del self.open[first:]

    def tag(self, name: str, rest: str, closes: bool) -> None:
        block = name not in INLINE
        if block and self.open and self.open[-1][0] in UNCLOSED and (self.open[-1][0] in ("p", name)) and not closes:
            self.close(len(self.open) - 1)
        if closes:
            self.link = self.link and name != "a"
            at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == name), None)
            if at is not None:
                self.close(at)
            elif block:
                self.end()
            return
        kind = region_of(name, rest, bool(self.inside))
        if name in VOID:
            if block:
                self.end()
            return
        if kind > 0 and self.out and all(n == "form" for n, k in self.open if k == OUT):
            # Some pages are one form as a whole.
            for element in self.open:
                element[1] = 0 if element[1] == OUT else element[1]
            self.out = 0
        if kind:
            self.edge()
        elif block:
            self.end()
        if kind == OUT:
            self.out += 1
        elif kind:
            self.inside.append(kind)
        elif name == "a":
            self.link = "href" in rest.lower()
        if kind or any(n == name for n, _ in self.open):
            self.open.append([name, kind])


def window_sums(weights: np.ndarray) -> np.ndarray:
    """The weight of each line and of those after it in its window."""
    total = np.concatenate([[0], np.cumsum(weights)])
    return total[np.minimum(np.arange(len(weights)) + WINDOW, len(weights))] - total[:-1]


def kept_lines(weights: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each line lies between the rise of the window sums above nothing and their dive back, if they surge in between."""
    keep, heavy = np.zeros(len(weights), bool), np.flatnonzero(weights)
    sums, rises = window_sums(weights), np.flatnonzero(np.diff(heavy, prepend=-WINDOW - 1) > WINDOW)
    for stretch in np.split(heavy, rises[1:]) if len(heavy) else []:
        rise, dive = stretch[0], stretch[-1] + 1
        keep[rise:dive] = sums[rise:dive].max() >= threshold
    return keep


def main_text(page: str | None) -> str:
    """The article of a page as blocks joined by one space."""
    lines = Lines(page or "")
    lengths, places = np.array([len(t) for t in lines.texts], np.int64), np.array(lines.places, np.int64)
    surest = places[lengths > 0].max(initial=0)
    if surest:
        # Inside the article any text is a surge, in links too.
        weights, threshold = np.where(places >= surest, lengths, 0), 1
    else:
        own = [w if not COPYRIGHT.match(t) else 0 for t, w in zip(lines.texts, lines.weights, strict=True)]
        weights = np.array(own, np.int64)
        threshold = max(1, min(SURGE, window_sums(weights).max(initial=0) / 4))
    keep = kept_lines(weights, threshold)
    return " ".join(t for t, k, w in zip(lines.texts, keep.tolist(), weights.tolist(), strict=True) if t and k and (w or not surest))


def extract(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, text and n_chars of every row."""
    prepare(pages.sparkSession)
    rows = pages.select(*keep, F.col(page).cast("string").alias("page_source"))
    schema = ", ".join([f"`{n}` {t}" for n, t in pages.select(*keep).dtypes] + ["text string", "n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(len(keep)).to_pylist()]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), *made], [*keep, "text", "n_chars"])

    return rows.mapInArrow(run, schema)
