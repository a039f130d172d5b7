"""Main text of raw pages by the distribution of text over blocks of lines.

Markup is stripped: each block element starts a line, inline markup leaves nothing, and
what stands in elements that never hold the article (scripts, menus, headers, footers,
sidebars, forms, notices, adverts, reader comments, by element, role, class or id) is
left out. Each remaining line has a length, in which the text of links does not count. The sum of
the lengths over a sliding window of lines is the distribution: the text surges where the sum
first exceeds a threshold and dives where it falls to nothing.

Surge and dive points only say where the article is. On pages that mark articles, these are the
candidates: an article whose own distribution surges is kept as a whole, and all are if none does. On other
pages a stretch is extended to the nearest element around its lines other than the body, so
headlines, bylines, short paragraphs and lists of links next to the text stay; without such an
element it is extended over short lines next to it that are not all links, and a page without a
surge is kept as it is. Inside a marked article, parts are left out by whole class or id names
only (``comments``, but not ``comments-on-method``).

Rows: a null or empty page has no text (empty string, 0 characters). Broken markup is read
as far as it goes; text is never cut. Repeated rows give repeated results. Columns are id,
URL, text and n_chars; a clashing ``text`` column of the input is not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from larkspar.llm.words import chunks

#: Lines of a window, and the characters in it that count as a surge.
WINDOW = 3
SURGE = 80

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
    r"<(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|([^\s=\"'/>]+)")
#: Elements whose content is no markup; their text is never shown.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
SKIPPED = RAW | frozenset(
    "nav header footer aside form menu dialog select button option datalist svg math canvas object audio video "
    "head".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: Start tags that close an open element of these names.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
MAIN = frozenset(("article", "main"))
#: Elements that may enclose an article and what belongs to it; the body encloses everything else too.
ENCLOSING = MAIN | frozenset("div section td center blockquote".split())
#: Roles, and words of class and id names, of parts beside the article.
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|nav|navbar|navigation|"
    r"menus?|breadcrumbs?|sidebar|side|footer|header|masthead|cookies?|consent|gdpr|notices?|popup|modal|newsletter|"
    r"subscribe|signup|login|share|sharing|social|related|recommend(?:ed|ations)?|widget|comments?|disqus|replies|"
    r"respond|pagination|pager|toolbar|copyright|legal|alert)(?:$|[\s_-]|\d)", re.I,
)
#: Names of parts inside an article that are not its own, as whole names or with the ending of an advert slot.
APART = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promo(?:tion)?)(?:[_-]\w+)*|nav|navbar|navigation|menus?|"
    r"breadcrumbs?|sidebar|footer|cookies?|consent|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|"
    r"recommend(?:ed|ations)?|widget|comments?|disqus|replies|respond|pagination|pager|toolbar|copyright", re.I,
)


def _beside(name: str, attrs: str, main: int) -> bool:
    if name in MAIN or name in ("body", "html"):
        return False
    for m in ATTRIBUTE.finditer(attrs):
        key = (m[1] or m[5]).lower()
        value = m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key in ("class", "id") and (any(map(APART.fullmatch, value.split())) if main else BESIDE.search(value)):
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class Line(NamedTuple):
    """A text line, its length without links, its marked article (0: none), and the elements around it from the outside."""

    text: str
    plain: int
    article: int
    around: tuple[int, ...]


def lines(page: str) -> list[Line]:
    """Text lines of a page outside skipped elements."""
    out: list[Line] = []
    around: list[int] = []  # numbers of the open elements that may enclose an article
    articles: list[int] = []
    opened = 0
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, skipped, main
    skipped = links = linked = 0

    def end_line() -> None:
        nonlocal linked
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append(Line(line, max(0, len(line) - linked), articles[0] if articles else 0, tuple(around)))
        text.clear()
        linked = 0

    def pop() -> str:
        nonlocal skipped, links
        name, skip, is_main = stack.pop()
        links -= name == "a"
        skipped -= skip
        if is_main:
            articles.pop()
        if name in ENCLOSING:
            around.pop()
        return name

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if not skipped:
            text.append(page[at : m.start() if m else len(page)])
            linked += len(text[-1]) if links else 0
        if not m:
            break
        at = m.end()
        name = m["name"]
        if not name:
            if m[0].startswith("<![CDATA[") and not skipped:
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if name in BLOCKS or name in SKIPPED:
            end_line()
        elif name == "br" and not skipped:
            text.append(" ")
        if m["end"]:
            if any(x[0] == name for x in stack):
                while pop() != name:
                    pass
            continue
        if name in VOID or (m["attrs"] or "").endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        while stack and stack[-1][0] in CLOSES.get(name, ()):
            pop()
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = close.start() if close else len(page)
        main = len(articles)
        skip = name in SKIPPED and not (name == "header" and main) or bool(m["attrs"]) and _beside(name, m["attrs"], main)
        stack.append((name, skip, name in MAIN and not skip))
        skipped += skip
        opened += 1
        if name in ENCLOSING:
            around.append(opened)
        if stack[-1][2]:
            articles.append(opened)
        links += name == "a"
    end_line()
    return out


def stretches(lengths: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """Line ranges between a surge and a dive of the summed lengths."""
    n = len(lengths)
    sums, total = [], sum(lengths[: window - 1])
    for i in range(n):  # sum over the lines from i on
        total += lengths[i + window - 1] if i + window - 1 < n else 0
        sums.append(total)
        total -= lengths[i]
    found, i = [], 0
    while i < n:
        if sums[i] > surge and lengths[i]:
            end = i
            while end < n and sums[end] > 0:
                end += 1
            while not lengths[end - 1]:
                end -= 1
            found.append((i, end))
            i = end
        i += 1
    return found


def _enclosed(rows: list[Line], first: int, end: int) -> range:
    """The lines from ``first`` to ``end`` and those beside them in the same element, or else those that are not all links."""
    shared = rows[first].around
    for row in rows[first:end]:
        while row.around[: len(shared)] != shared:
            shared = shared[:-1]
    beside = lambda r: r.around[: len(shared)] == shared if shared else r.plain > 0
    while first and beside(rows[first - 1]):
        first -= 1
    while end < len(rows) and beside(rows[end]):
        end += 1
    return range(first, end)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    rows = lines(page)
    articles = sorted({r.article for r in rows} - {0})
    if articles:
        parts = [[r for r in rows if r.article == a] for a in articles]
        surging = [part for part in parts if stretches([r.plain for r in part])]
        kept = [r.text for part in surging or parts for r in part]
    else:
        chosen = sorted({i for first, end in stretches([r.plain for r in rows]) for i in _enclosed(rows, first, end)})
        kept = [rows[i].text for i in chosen] if chosen else [r.text for r in rows]
    return "\n\n".join(kept)


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` (code points) of each page."""
    rows = pages.select(pages[key].alias("key"), pages[url].alias("url"), pages[page].alias("page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "page"):
            found = [main_text(x) for x in batch.column("page").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(x) for x in found], pa.int64())], ["key", "url", "text", "n_chars"],
            )

    kind = pages.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, url string, text string, n_chars long").withColumnsRenamed(
        {"key": key, "url": url}
    )
