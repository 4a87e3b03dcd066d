"""Operator 8: main text of web pages by the distribution of line blocks.

A page is cut into blocks (lines) where a browser would start a new one. Every
line has a weight: its characters, of which those in links count ``LOWERED``,
and all of them in a line that the page marks as something else than article
text (menus, headers, footers, sidebars, forms ... by element name, ARIA role, or
names in class and id). A form, class or id does not count where it is around
more than half of the page's longest article (or of its longest ``main``; or of
all text, in two blocks or more, if the page has neither). What a browser does
not show has no weight.

Over the whole sequence the weights are summed in windows of ``WINDOW`` lines
(``runs``): a rise of the sums that reaches the surge level opens a run at its
first line of a character's weight, and sums that dive below one close it.
Lines of a run whose own weight is below one cut it. The text of the runs is the
main text, and nothing else is added. A page's own mark-up for its article
(``article``, ``main``, ``itemprop=articleBody``) checks the runs: one without any
line of it goes, and one within it needs no surge; links inside it count in full.

Defined results: null and empty html give an empty text; broken and cut-off
mark-up is read as far as it goes (an element never closed lasts to the end of
its parent); a page is read whole, whatever its length, in one pass; repeated
rows each get a row; an empty table gives no rows; only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import table

WINDOW = 3
#: A run opens where a window sums up to so many characters ...
SURGE = 40
#: ... or to this share of the page's largest window, whichever is less.
SURGE_SHARE = 0.2
#: What a character counts in a link, or in a line that is marked as no article text.
LOWERED = 1 / 2048

# Element names.
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no mark-up: it ends at the first closing tag.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
#: Not shown, or no text.
UNSHOWN = frozenset("head script style noscript template title textarea select option button svg math iframe object canvas audio video".split())
#: Mostly no article text in these.
FURNITURE = frozenset("nav header footer aside menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar toolbar alert alertdialog dialog".split())
#: Names in class and id that mark what is not the article, alone or with words of PLACES.
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promos promoted banner banners
nav navbar navigation menu menus breadcrumb breadcrumbs pager pagination sidebar sidebars aside rail widget widgets related recommended
header masthead topbar footer colophon copyright cookie cookies consent gdpr notice notices alert popup modal overlay subscribe newsletter
signup login form search share sharing social comment comments commentlist reply replies disqus responses toc skip hidden""".split())
PLACES = frozenset("""top bottom left right main site page global primary secondary inner outer wrap wrapper container box block area section
list item items bar panel link links button buttons icon icons post entry article story""".split())
#: Of an article's own parts, these are the article's.
OWN_PARTS = frozenset({"post", "entry", "article", "story"})
OWN_MARKS = frozenset({"header", "masthead"})
#: An article may open with its own header: these are kept inside one.
ARTICLE_OWN = frozenset({"header"})
#: Opening one of these closes an open paragraph.
CLOSES_P = BLOCK - {"br", "body", "html", "head", "title", "option", "select", "td", "th", "tr", "tbody", "thead", "tfoot", "summary"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^"'>]|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class _Element:
    """state: (0: shown, 1: in furniture, 2: not shown; number of the innermost
    mark around it, numbers of the outermost article and main around it; 0 is none)."""

    __slots__ = ("name", "state")

    def __init__(self, name: str, state: tuple[int, int, int, int]):
        self.name, self.state = name, state


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): _html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text and not text.isspace() else {}


def _hidden(attributes: dict[str, str]) -> int:
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return 2
    return int(attributes.get("role", "").lower() in ROLES)


def _marks(name: str) -> bool:
    """Whether a whole name of class or id is a mark."""
    words = {w for w in _WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()) if len(w) > 1}
    found = words & MARKS
    return bool(found) and words <= MARKS | PLACES and not (words & OWN_PARTS and found <= OWN_MARKS)


def _marked(name: str, attributes: dict[str, str]) -> bool:
    if name == "form" or attributes.get("role", "").lower() == "form":
        return True
    return any(map(_marks, f"{attributes.get('class', '')} {attributes.get('id', '')}".split()))


class Line(NamedTuple):
    """A block of a page: its text, whether the page marks it as something else
    than article text, whether it is in the article, how many of its characters
    are links, and whether it is shown."""

    text: str
    marked: bool
    main: bool
    linked: int
    shown: bool

    def weight(self) -> float:
        if not self.shown:
            return 0.0
        n = len(self.text)
        return n * LOWERED if self.marked else n if self.main else n - self.linked * (1 - LOWERED)


def blocks(page: str) -> list[Line]:
    """Every block in page order."""
    stack = [_Element("", (0, 0, 0, 0))]
    held: list[str] = []
    links: list[str] = []
    found: list[tuple[str, tuple[int, int, int, int], int]] = []
    around = [0]  # of every mark, the mark around it
    numbered, in_link = 0, False

    def hold(text: str) -> None:
        held.append(text)
        if in_link:
            links.append(text)

    def plain(parts: list[str]) -> str:
        return _SPACE.sub(" ", _html.unescape("".join(parts))).strip()

    def flush() -> None:
        if held:
            text = plain(held)
            held.clear()
            if text:
                found.append((text, stack[-1].state, min(len(text), len(plain(links))) if links else 0))
            links.clear()

    def close(k: int) -> None:
        flush()
        del stack[k:]

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            hold(page[at:])
            break
        if m.start() > at:
            hold(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                hold(_html.escape(m[0][9:].removesuffix("]]>")))
            continue
        if name == "a":
            in_link = not m[1]
        if m[1]:
            if name in BLOCK:  # a link that is never closed ends with its block
                in_link = False
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    if name in BLOCK or any(e.state != stack[k - 1].state for e in stack[k:]):
                        close(k)
                    else:
                        # An inline end tag closes no block around or behind it.
                        if not any(e.name in BLOCK for e in stack[k:]):
                            del stack[k:]
                    break
            else:
                if name in ("p", "br"):
                    flush()
            continue
        attributes = _attributes(m[3])
        if name in BLOCK:
            flush()
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    close(k)
                    break
                if stack[k].name in BLOCK:
                    break
        if name in SELF_CLOSING:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in SELF_CLOSING[name]:
                    close(k)
                    break
                if stack[k].name in BLOCK and stack[k].name != "p":
                    break
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        top = stack[-1].state
        hidden, mark, article, main = top
        role = attributes.get("role", "").lower()
        numbered += 1
        if name == "article" or role == "article" or "articlebody" in attributes.get("itemprop", "").lower():
            article = article or numbered
        if name == "main" or role == "main":
            main = main or numbered
        own = name in ARTICLE_OWN and any(e.name == "article" for e in stack)
        own_state = 2 if name in UNSHOWN else int(name in FURNITURE and not own)
        hidden = max(hidden, own_state, _hidden(attributes) if name not in ("html", "body", "article", "main") else 0)
        if not hidden and name not in ("html", "body", "article", "main") and _marked(name, attributes):
            around.append(mark)
            mark = len(around) - 1
        state = (hidden, mark, article, main)
        if state != top:
            flush()
        if name in BLOCK or name not in ("b", "i", "em", "strong", "span", "a", "u", "small", "font", "code", "sub", "sup", "mark", "cite", "q") or state != top:
            stack.append(_Element(name, state))
    flush()
    # Marks count unless they are around most of the article; of a page without
    # one, around most of its text, in more than one block (one is an ad's).
    article, main = Counter(), Counter()
    for text, state, _ in found:
        if not state[0]:
            article[state[2]] += len(text)
            main[state[3]] += len(text)
    del article[0], main[0]
    which, target = (2, max(article, key=article.get)) if article else (3, max(main, key=main.get)) if main else (0, False)
    inside, n_blocks = [0] * len(around), [0] * len(around)
    for text, state, _ in found:
        if not state[0] and state[which] == target:
            inside[state[1]] += len(text)
            n_blocks[state[1]] += 1
    for k in range(len(around) - 1, 0, -1):
        inside[around[k]] += inside[k]
        n_blocks[around[k]] += n_blocks[k]
    counts = [False] * len(around)
    for k in range(1, len(around)):
        counts[k] = counts[around[k]] or 2 * inside[k] <= inside[0] or not which and n_blocks[k] < 2
    return [Line(text, state[0] > 0 or counts[state[1]], bool(state[2] or state[3]), linked, state[0] < 2) for text, state, linked in found]


def runs(weights: np.ndarray, window: int = WINDOW, surge: float = SURGE, share: float = SURGE_SHARE, article: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Line ranges [a, z) of the main text: what lies between surge and dive
    points, cut where a line weighs less than a character. ``article``: which
    lines the page has in its article."""
    n = len(weights)
    if not n:
        return []
    total = np.concatenate((np.zeros(1), np.cumsum(weights)))
    sums = total[np.minimum(np.arange(n) + window, n)] - total[:n]
    sums[sums < 1 - 1e-6] = 0
    text = weights >= 1
    inside = np.zeros(n, bool) if article is None else article & text
    level = max(min(surge, share * sums.max()), 1)
    out, a = [], None
    for i in range(n + 1):
        if i < n and sums[i] > 0 and (a is not None or text[i]):
            a = i if a is None else a
        elif a is not None:
            if inside[a:i].any() if inside.any() else sums[a:i].max() >= level:
                edges = np.flatnonzero(np.diff(np.concatenate(([0], text[a:i], [0]))))
                out += [(a + int(x), a + int(y)) for x, y in zip(edges[::2], edges[1::2])]
            a = None
    return out


def main_text(page: str | None) -> str:
    """The main text of a page."""
    lines = blocks(page or "")
    weights = np.array([line.weight() for line in lines], np.float64)
    article = np.array([line.main and not line.marked for line in lines], bool)
    return " ".join(line.text for a, z in runs(weights, article=article) for line in lines[a:z])


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
