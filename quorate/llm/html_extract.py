"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped into lines, one for each block element; a removed container
(menu, form, ...) leaves an empty line. The text lengths of `window`
consecutive lines are summed; the text surges where that sum reaches the
threshold and dives where it falls to zero. Lines between a surge and its dive
stay, in every stretch: link lines or removed containers may break an article.

What a page says about itself (an article element, a container whose class
names a sidebar) is a hint that the sums confirm or overrule. Three sets of
lines are tried in turn: those inside an article and in no container so named,
all in no such container, all. The first set that surges is the main text's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorate.llm.common import chunks

_RAW = "script|style|noscript|template|textarea|title|iframe|svg|select|canvas"
_TOKEN = re.compile(
    rf"""<!--(?:.*?-->|>|.*\Z)|<({_RAW})(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>(?:.*?</\1\s*+>|.*\Z)|<[!?][^>]*+>|<(/?)([a-z][a-z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>""",
    re.S | re.I,
)
_ATTR = re.compile(r"""([a-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|\b(hidden)\b""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark math mfrac mi mn mo mroot mrow ms msqrt msub msubsup msup mtext nobr object q rp rt ruby s samp semantics small span strike strong sub sup time tt u var wbr".split())
_GONE = frozenset("nav footer aside form button dialog menu menuitem head".split())
_OUTSIDE = frozenset("header".split())
_KEEP = frozenset("html body article main".split())
#: One of these among the words of a class, id or role names a container that is not main text.
_LABELS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr "
    "popup modal newsletter subscribe comment comments commentlist reply replies disqus login signup searchform toolbar pagination pager".split()
)
#: These only do if all words are of the three lists or numbers.
_WEAK = frozenset("banner notice notices subscription share sharing social related recommended search widget skip".split())
_NEUTRAL = frozenset("area bar block bottom box button buttons center col column container content group header icons inner items left links list main module outer panel posts right row section site slot text title top wrap wrapper".split())
_OUTSIDE_LABELS = frozenset("header masthead topbar".split())
_CLOSES = {"li": ("ul", "ol", "menu"), "p": ("div", "section", "article", "main", "body", "td", "blockquote", "li"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}


_PART = re.compile(r"[^a-z0-9]+")


def _boilerplate(name: str, attrs: str, inside: bool) -> int:
    """0 a container of text, 1 one whose labels say that it is not main text, 2 one to remove."""
    if name in _GONE or name in _OUTSIDE and not inside:
        return 2
    if not attrs.strip() or name in _KEEP:
        return 0
    labelled = 0
    for m in _ATTR.finditer(attrs):
        key, value = (m[1] or m[5]).lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true":
            return 2
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return 2
        if key in ("class", "id", "role"):
            labels = {x for x in _PART.split(value) if x and not x.isdigit()}
            if key == "role" and labels & {"complementary", "contentinfo", "alert", "dialog"}:
                return 2
            if labels & _LABELS or not inside and labels & _OUTSIDE_LABELS or labels & _WEAK and labels <= _WEAK | _NEUTRAL:
                labelled = 1
    return labelled


#: One block: text, characters of link text, whether an article holds it, whether a labelled container does.
Line = tuple[str, int, bool, bool]


def lines_of(html: str) -> list[Line]:
    """The blocks of a page; a removed container gives an empty line."""
    lines: list[Line] = []
    stack: list[tuple[str, int]] = []  # open elements and what _boilerplate says of them
    gone = labelled = inside = links = linked = 0
    parts: list[str] = []

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join("".join(parts).split()):
                lines.append((text, linked, inside > 0, labelled > 0))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal gone, labelled, inside, links
        name, kind = stack[-1]
        if kind or name not in _INLINE:
            flush()
        stack.pop()
        gone -= kind == 2
        labelled -= kind == 1
        inside -= name in ("article", "main")
        links -= name == "a"

    def text_to(end: int) -> None:
        nonlocal linked
        if not gone and end > at:
            parts.append(t := unescape(html[at:end]))
            if links:
                linked += len(t)

    at = 0
    for m in _TOKEN.finditer(html):
        text_to(m.start())
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        if not name:
            if m[1] and not gone:
                parts.append(" ")
            continue
        if m[2] or m[5]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                while len(stack) > depth:
                    pop()
            elif name not in _INLINE and not gone:
                flush()
            continue
        if name in ("article", "main"):  # an unclosed container cannot hold the article
            while gone or labelled:
                pop()
        if name not in _INLINE:
            if not gone:
                flush()
            if name in _CLOSES or name not in ("td", "th"):
                own = name if name in _CLOSES else "p"
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == own:
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][0] in _CLOSES[own] or stack[k][1]:
                        break
        elif name in ("br", "img", "wbr") and not gone:
            parts.append(" " if name == "br" else "")
        if name in _VOID or (m[4] or m[7] or "").endswith("/") and name not in _KEEP:
            continue
        kind = _boilerplate(name, m[4] or m[7] or "", inside > 0)
        if kind and not gone:
            flush()
            if kind == 2:
                lines.append(("", 0, inside > 0, labelled > 0))
        stack.append((name, kind))
        gone += kind == 2
        labelled += kind == 1
        inside += name in ("article", "main")
        links += name == "a"
    text_to(len(html))
    flush()
    return lines


def _blocks(lines: list[Line], marked: bool, labels: bool) -> list[tuple[str, int]]:
    """Text and weight of each line of a set; containers out of the set side by side are one empty line.

    Mostly linked text weighs nothing. marked: only lines inside an article;
    labels: only lines in no labelled container.
    """
    out: list[tuple[str, int]] = []
    for text, linked, inside, labelled in lines:
        if not text or labels and labelled or marked and not inside:
            if not out or out[-1][0]:
                out.append(("", 0))
        else:
            out.append((text, len(text) if 2 * linked <= len(text) else 0))
    return out


def _sums(blocks: list[tuple[str, int]], window: int) -> list[int]:
    total, sums = 0, [0] * len(blocks)
    for k in range(len(blocks) - 1, -1, -1):
        total += blocks[k][1] - (blocks[k + window][1] if k + window < len(blocks) else 0)
        sums[k] = total
    return sums


def main_text(html: str, window: int = 3, surge: int = 80) -> list[str]:
    """The blocks of the main text, in page order.

    A set of lines surges if its greatest sum reaches `surge`, or half of the
    next set's greatest where that is less. Labels are overruled only on pages
    without article text: comments can be longer than what they are about.
    Inside an article that surges every rise starts a stretch; elsewhere a
    stretch starts where the sum reaches the threshold.
    """
    lines = lines_of(html)
    sets = [_blocks(lines, *x) for x in ((True, True), (False, True), (False, False))]
    article, plain, every = (max(_sums(x, window), default=0) for x in sets)
    if article and article >= min(surge, plain // 2):
        blocks, least = sets[0], 1
    elif article or plain and plain >= min(surge, every // 2):
        blocks, least = sets[1], max(1, min(surge, plain // 2))
    else:
        blocks, least = sets[2], max(1, min(surge, every // 2))
    sums = _sums(blocks, window)
    found, k = [], 0
    while k < len(sums):
        if sums[k] < least:
            k += 1
            continue
        end = k
        while end < len(sums) and sums[end] > 0:
            end += 1
        found.append((k, end))
        k = end + 1
    return [text for k, end in found for text, _ in blocks[k:end] if text]


def extract_pages(pages: DataFrame, window: int = 3, surge: int = 80) -> DataFrame:
    """page_id, url and text of every page.

    text: the blocks of the main text joined by two line feeds, empty if there
    is none. Null or empty html: empty text. Character references are decoded
    and white space (as Unicode has it) inside a block becomes one space.
    Unclosed tags and cut pages are read as far as they go. Repeated rows give
    repeated results; further columns are ignored.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                texts = ["\n\n".join(main_text(h or "", window, surge)) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], schema=schema)

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")


def op8(spark, sf_dir) -> DataFrame:
    """The main text of each page."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
