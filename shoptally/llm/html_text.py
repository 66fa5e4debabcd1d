"""Main text of web pages by consensus paths of hosts.

A page is read once into blocks of text, each with the containers that it stands in.  Blocks inside
menus, headers, footers, side bars, notices, adverts, forms, comments, scripts and the like are no
content.  What a tag says holds; what only a name of class, id or role says, and a form, is weighed once the page is
read (``_rescued``), so that a wrapper named after a part of the page does not take the article with it.  Every container is scored by its content, its depth and its kind, and the best one gives
the page's vote: its path of tags and classes, with numbers taken out.  Spark counts the votes of
each host; the pages are then read again with the winning path of their host.  A page on which
that path has no content falls back on its own best container.

Texts: character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined by one line end in page order; empty blocks are left out.  A line break tag is white space.

Defined cases: a null, empty or textless page has the text ''.  A null or odd url has the host '' and
such pages vote together.  Unclosed and crossed tags end with what encloses them.  Equal rows get
equal texts.  Ties between paths go to the one with more content, then to the larger path in code
point order.  An empty table gives an empty table.  Columns other than page_id, url, html are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.storage import saved
from shoptally.llm.words import slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+|[^<>]*)>", re.DOTALL
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

# HTML's element kinds, and names that mark what is not the article.
RAW = frozenset("script style noscript template iframe textarea title svg object annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr math mrow mi mo mn ms mtext mspace mfrac msqrt mroot msub msup "
    "msubsup munder mover munderover mstyle semantics".split()
)
#: Names on these never say that they are no content.
UNNAMED = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figure figcaption table caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_CONTENT = frozenset("head nav footer aside button select dialog menu".split())
NOT_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs footer header masthead cookie cookies consent notice notices popup modal newsletter subscribe share "
    "sharing social related comment comments respond disqus replies login search".split()
)
CONTAINERS = frozenset("body main article section div td center".split())
MAIN = frozenset("article main".split())
CLOSES_ITSELF = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: A broadcast table of paths takes so many bytes at most, and a row of it so many besides its texts.
BROADCAST_BYTES = 8 << 20
ROW_BYTES = 64
#: Where an open item is not closed by the next one.
SCOPES = frozenset("ul ol dl table tbody thead body article section div main".split())


class Element(NamedTuple):
    tag: str
    path: str
    content: bool
    container: bool


class Page(NamedTuple):
    blocks: list[tuple[str, int, tuple[int, ...]]]  # text, characters in links, containers around
    containers: list[Element]


def _names(attributes: str) -> tuple[list[str], list[str], list[str]]:
    """Words of class; words of class, id and role and what those of class begin with; their other parts.

    Of an id only the whole counts: headings' texts make ids (search-algorithms).
    """
    classes, every, others = [], [], []
    if "=" in attributes:
        for kind, *values in NAMED.findall(attributes):
            words = "".join(values).lower().split()
            every += words
            if kind.lower() != "class":
                continue
            classes += words
            for w in words:
                first, *parts = re.split(r"[-_]", w)
                every.append(first)
                others += parts
    return classes, every, others


def _rescued(
    blocks: list[tuple[str, int, tuple[int, ...], tuple[int, ...]]],
    containers: list[Element],
    inside: list[tuple[int, ...]],
    by_part: list[bool],
) -> set[int]:
    """Which elements that a name marks as no content are content all the same.

    Those around the article or main with the most unlinked text are, if they are marked only by a later part of a
    name (with-sidebar) or no other article or main has text; and, marked by a later part, those with most
    of the page's unlinked text.  If nothing else is left, the names do not count.
    """
    own = [0] * len(containers)
    for text, linked, around, marks in blocks:
        for number in around:
            if inside[number] == marks:
                own[number] += max(0, len(text) - linked)
    mains = [n for n, e in enumerate(containers) if e.tag in MAIN and own[n]]
    out: set[int] = set()
    if mains:
        best = max(mains, key=lambda n: (own[n], -n))
        if all(by_part[k] for k in inside[best]) or all(inside[n] for n in mains):
            out |= set(inside[best])
    total, of = 0, dict.fromkeys((k for k, part in enumerate(by_part) if part), 0)
    for text, linked, _, marks in blocks:
        if all(by_part[k] or k in out for k in marks):
            total += max(0, len(text) - linked)
            for k in marks:
                if k in of:
                    of[k] += max(0, len(text) - linked)
    out |= {k for k, worth in of.items() if 2 * worth > total}
    return out if any(out.issuperset(marks) for *_, marks in blocks) else set(range(len(by_part)))


def read(html: str) -> Page:
    """Blocks of content and the containers of a page."""
    blocks: list[tuple[str, int, tuple[int, ...], tuple[int, ...]]] = []  # as in Page, and the marked elements around
    containers: list[Element] = []
    inside: list[tuple[int, ...]] = []  # marked elements around each container
    by_part: list[bool] = []  # of each marked element, whether only a later part of a name marks it
    open_elements: list[tuple[Element, int, bool]] = []  # with the number of the container or -1, and whether marked
    around: tuple[int, ...] = ()
    marks: tuple[int, ...] = ()
    hidden, links = 0, 0
    text: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(unescape("".join(text)).split())
            if words:
                blocks.append((words, linked, around, marks))
            text.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal around, hidden, marks
        while len(open_elements) > to:
            element, number, marked = open_elements.pop()
            hidden -= not element.content
            if marked:
                marks = marks[:-1]
            if number >= 0:
                around = around[:-1]

    at = 0
    while True:
        m = TOKEN.search(html, at)
        run = html[at : m.start() if m else len(html)]
        if run and not hidden:
            text.append(run)
            linked += len(run) if links else 0
        if m is None:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag in RAW:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag == "a":
            links = 0 if m[1] else 1
        if tag == "br" and not hidden:
            text.append(" ")
        if m[1]:
            place = next((i for i in range(len(open_elements) - 1, -1, -1) if open_elements[i][0].tag == tag), -1)
            if tag not in INLINE:
                flush()
            if place >= 0:
                flush()
                close(place)
            continue
        if tag in VOID:
            if tag not in INLINE:
                flush()
            continue
        classes, names, others = _names(m[3])
        bad = tag in NOT_CONTENT
        named = tag != "form" and not NOT_CONTENT_NAMES.isdisjoint(names)
        # A form may be around the whole page, so it is weighed as if a part of its name marked it.
        marked = not bad and (tag == "form" or named or not NOT_CONTENT_NAMES.isdisjoint(others))
        if tag in UNNAMED:
            marked = False
        if tag == "header":
            bad, marked = not any(e.tag in MAIN for e, _, _ in open_elements), False
        if tag in ("html", "body") or tag in MAIN:
            bad = marked = False
        if tag in INLINE:
            if not bad and not marked:
                continue
        flush()
        if tag not in INLINE:
            for i in range(len(open_elements) - 1, -1, -1):
                other = open_elements[i][0].tag
                if other == "p" or other in CLOSES_ITSELF.get(tag, ()):
                    close(i)
                elif other in SCOPES:
                    break
        parent = open_elements[-1][0].path if open_elements else ""
        label = tag + "".join(f".{c}" for c in sorted({re.sub(r"\d+", "", c) for c in classes} - {""}))
        element = Element(tag, f"{parent}>{label}", not bad, tag in CONTAINERS)
        number = -1
        if element.container and not hidden and element.content:
            number = len(containers)
            containers.append(element)
            around = (*around, number)
        if marked:
            marks = (*marks, len(by_part))
            by_part.append(not named)
        if number >= 0:
            inside.append(marks)
        open_elements.append((element, number, marked))
        hidden += not element.content
    flush()
    shown = _rescued(blocks, containers, inside, by_part) if by_part else set()
    return Page([(text, n, c) for text, n, c, marked in blocks if shown.issuperset(marked)], containers)


def best_path(page: Page) -> tuple[str, int] | None:
    """Path and content of the best container; None without containers that hold content."""
    content = [0] * len(page.containers)
    total = 0
    for text, linked, around in page.blocks:
        worth = max(0, len(text) - linked)
        total += worth
        for number in around:
            content[number] += worth
    best = max(
        (
            (2 * c >= total, e.tag in MAIN, 10 * c >= 9 * total, e.path.count(">"), c, e.path)
            for c, e in zip(content, page.containers, strict=True)
            if c
        ),
        default=None,
    )
    return None if best is None else (best[-1], best[-2])


def extract(html: str, path: str | None) -> str:
    """The page's content inside the containers with that path, or else inside its own best one."""
    page = read(html)
    for wanted in (path, (best_path(page) or (None,))[0]):
        if wanted is None:
            continue
        inside = {i for i, e in enumerate(page.containers) if e.path == wanted}
        blocks = [text for text, _, around in page.blocks if not inside.isdisjoint(around)]
        if blocks:
            return "\n".join(blocks)
    return "\n".join(text for text, _, _ in page.blocks)


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^\w+://(?:[^/?#@]*@)?([^/:?#]+)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path with the most votes of each host's pages."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            best = [best_path(read(html or "")) for html in batch.column("html").to_pylist()]
            paths = pa.array([b and b[0] for b in best], pa.string())
            content = pa.array([b and b[1] for b in best], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("host"), paths, content], names=["host", "path", "content"])

    votes = pages.select(_host(F.col("url")).alias("host"), "html").mapInArrow(vote, "host string, path string, content long")
    counted = votes.where("path IS NOT NULL").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("votes"), F.sum("content").alias("content")
    )
    return counted.groupBy("host").agg(F.max(F.struct("votes", "content", "path")).alias("best")).select("host", "best.path")


def main_texts(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Pages stay where they are if the paths of all hosts take ``broadcast_bytes`` at most, which is looked up; else
    both sides are shuffled by host, where Spark splits the partition of a hot host.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            paths = batch.column("path").to_pylist()
            texts = [extract(h or "", p) for h, p in zip(batch.column("html").to_pylist(), paths, strict=True)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    hosted = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host"))
    paths = saved(host_paths(pages))
    size = paths.agg(F.sum(F.octet_length("host") + F.octet_length("path") + ROW_BYTES)).first()[0] or 0
    joined = hosted.join(F.broadcast(paths) if size <= broadcast_bytes else paths, "host", "left").select("page_id", "url", "html", "path")
    return joined.mapInArrow(cut, f"page_id {id_type}, url string, text string, n_chars long")
