"""Main text of HTML pages by consensus of a host's pages.

Each page is read into blocks of text with the generalised path of the containers around them (tags with their classes,
digits left out). Containers score the unlinked text of their blocks. A page that holds a third of it or more in articles
or main elements votes for the path that holds most; others are followed from the outside in, as long as a container has
no unlinked text of its own and one container in it has four fifths or more of what it has. So a title, a lead or a
table that stands beside the longest part of an article stays with it. Spark counts the votes per host, and the pages are
read again: the text is that of the winning path, or of the page's own best container where the page lacks it.

Defined cases: null or empty html gives an empty text; html without tags is one block; a page cut off in the middle
keeps what came before; repeated rows vote and are extracted each; a url without a host votes in the host "".
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .urls import url_parts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Elements that hold no article text.
BARE = "script style noscript template svg iframe object canvas textarea select button title"
DROP = "nav footer aside form head menu dialog fieldset"
#: Words in class or id that say the same: a name counts if it has no words but these and PLAIN ones ('site-footer', not 'no-sidebar').
MARKS = """ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menus header footer sidebar
side cookie cookies consent gdpr notice notices alert popup modal overlay comment comments reply replies disqus share sharing social related
recommended newsletter subscribe subscription signup login breadcrumb breadcrumbs pagination pager widget toolbar masthead"""
PLAIN = "site page main top bottom left right box block wrap wrapper container area section list bar button buttons link links inner outer"
#: What readers and other pages add may hold most of a page's text; any other marked element that does is a wrapper and stays.
ADDED = "comment comments reply replies disqus related recommended"
BLOCKS = """p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table tr td th thead tbody tfoot caption hr address figure figcaption html body article main
section div center header details summary"""
HOLDERS = "html body article main section div td center"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + BARE.replace(" ", "|") + r")(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.S | re.I)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROPPED, MARKED, FILLING = frozenset(DROP.split()), frozenset(MARKS.split()), frozenset(["", *PLAIN.split()])
FOREIGN = frozenset(ADDED.split())
HEADINGS, TITLES = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("header masthead".split())
BLOCK, HOLDER = frozenset(BLOCKS.split()), frozenset(HOLDERS.split())
CLOSES_P = BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot"}
#: What ends an element whose end tag is optional.
NEXT = {"p": CLOSES_P | DROPPED, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
        "th": {"td", "th", "tr", "tbody", "tfoot"}, "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}}


def marks_of(tag: str, named: list[tuple[str, ...]]) -> set[str]:
    """The marks in class, id and role for which an element is dropped."""
    out: set[str] = set()
    for _, *value in named:
        for name in "".join(value).lower().split():
            parts = set(re.split(r"[-_:\d]+", name))
            if tag in HEADINGS:
                out |= {name} & MARKED - TITLES
            elif parts <= MARKED | FILLING:
                out |= parts & MARKED
    return out


def read_blocks(page: str) -> list[tuple[tuple[str, ...], str, int]]:
    """(paths of the containers around it, outermost first; text; characters in links) of each block."""
    blocks, wrappers = read(page, frozenset())
    return read(page, wrappers)[0] if wrappers else blocks


def read(page: str, spared: frozenset[int]) -> tuple[list[tuple[tuple[str, ...], str, int]], frozenset[int]]:
    """The blocks, and where the marked elements begin that hold more than half of the page's text; ``spared`` are not dropped."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, bool]] = []  # open block elements: tag, whether it is a container
    paths: tuple[str, ...] = ("",)
    text: list[str] = []
    dropped: list[tuple[str, int, int]] = []  # the elements of the dropped part that are open: tag, place if it may be a wrapper, characters before
    loose = {"p": 0, "li": 0}  # those of the dropped part that may lack an end
    held: list[tuple[int, int]] = []  # place and characters of what may be a wrapper
    seen = 0  # characters, dropped or not
    linked, in_link = 0, False

    def flush() -> None:
        nonlocal linked
        whole = " ".join("".join(text).split())
        if whole:
            out.append((paths, whole, linked))
        text.clear()
        linked = 0

    def close(tag: str) -> None:
        nonlocal paths
        while stack:
            top, holds = stack.pop()
            if holds:
                paths = paths[:-1]
            if top == tag:
                return

    def undrop(tag: str | None = None) -> None:
        """Ends the dropped elements up to the last ``tag``, or all."""
        while dropped:
            top, place, before = dropped.pop()
            if place >= 0:
                held.append((place, seen - before))
            if top == tag:
                return

    at = 0
    for m in TAG.finditer(page):
        if m.start() > at:
            said = page[at : m.start()] if dropped else entities.unescape(page[at : m.start()])
            seen += len(said.strip())
            if not dropped:
                text.append(said)
                linked += len(said) if in_link else 0
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag, shut, attributes = tag.lower(), m[2], m[4]
        named = NAMED.findall(attributes) if not shut and "=" in attributes else []
        marks = marks_of(tag, named) if named and tag not in ("html", "body", "article", "main") else set()
        place = m.start() if marks and not marks & FOREIGN else -1
        if dropped:
            own = True  # the tag belongs to the dropped part
            if shut:
                if any(t == tag for t, _, _ in dropped):
                    undrop(tag)
                elif loose.get(tag):
                    loose[tag] -= 1
                elif tag in BLOCK and any(t == tag for t, _ in stack):
                    undrop()  # its parent closes
                    own = False
            elif len(dropped) == 1 and tag in NEXT.get(dropped[0][0], ()):
                undrop()
                own = False
            elif tag not in VOID and not attributes.endswith("/"):
                if tag in loose:
                    loose[tag] += 1
                elif tag in BLOCK or tag in DROPPED or tag == dropped[0][0]:
                    dropped.append((tag, place, seen))
            if own:
                continue
        if shut:
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                flush()
                if any(t == tag for t, _ in stack):
                    close(tag)
            continue
        if tag == "a":
            in_link = True
        if tag == "br":
            flush()
        if tag in VOID:
            continue
        inside = any(t in ("article", "main") for t, _ in stack)
        if tag in DROPPED or (tag == "header" and not inside) or (marks and m.start() not in spared):
            if tag in BLOCK or tag in DROPPED:
                flush()
            if not attributes.endswith("/"):
                loose.update(p=0, li=0)
                dropped.append((tag, place, seen))
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and any(t == "p" for t, _ in stack[-3:]):
                close("p")
            holds = tag in HOLDER
            if holds:
                classes = sorted({re.sub(r"\d+", "", w) for kind, *value in named if kind.lower() == "class" for w in "".join(value).lower().split()})
                paths = (*paths, "/".join([paths[-1], ".".join([tag, *classes])]))
            stack.append((tag, holds))
    if at < len(page):
        seen += len(page[at:].strip())
        if not dropped:
            text.append(entities.unescape(page[at:]))
    undrop()
    flush()
    return out, frozenset(p for p, n in held if 2 * n > seen) - spared


def best_path(blocks: list[tuple[tuple[str, ...], str, int]]) -> tuple[str, int]:
    """The path of the container that holds the article, and its unlinked characters; ties to the smaller path."""
    score: dict[str, int] = {"": 0}
    own: dict[str, int] = {}
    inner: dict[str, set[str]] = {}
    for paths, text, linked in blocks:
        worth = max(0, len(text) - 2 * linked)
        own[paths[-1]] = own.get(paths[-1], 0) + worth
        for outer, path in zip((None, *paths), paths):
            score[path] = score.get(path, 0) + worth
            if outer is not None:
                inner.setdefault(outer, set()).add(path)
    kind = {p: p.rpartition("/")[2].partition(".")[0] for p in score}
    longest = lambda some: min(some, key=lambda p: (-score[p], p), default=None)

    at = ""
    marked = longest([p for p in score if kind[p] in ("article", "main")])
    if marked is not None and score[marked] * 3 >= score[""] > 0:
        at = marked
        article = longest([p for p in score if kind[p] == "article" and p.startswith(at + "/")])
        if kind[at] == "main" and article is not None and not own.get(at) and score[article] * 5 >= score[at] * 4:
            at = article
        return at, score[at]
    while not own.get(at):
        to = longest(inner.get(at, ()))
        if to is None or score[to] * 5 < score[at] * 4 or not score[to]:
            break
        at = to
    return at, score[at]


def main_text(page: str | None, winner: str | None) -> str:
    blocks = read_blocks(page or "")
    if not any(winner in paths for paths, _, _ in blocks):
        winner = best_path(blocks)[0]
    return "\n".join(text for paths, text, _ in blocks if winner in paths)


def extract(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, url, text and n_chars of every row of ``pages`` (columns ``url`` and ``html``)."""
    host = url_parts(F.col("url"))[0].alias("host")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [best_path(read_blocks(h or "")) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())], ["host", "path", "score"])

    votes = pages.select(host, "html").mapInArrow(vote, "host string, path string, score long")
    counted = votes.where("score > 0").groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    winners = counted.groupBy("host").agg(F.max_by("path", F.struct("n", "score", "path")).alias("winner"))
    # written first, so that the planner sees its size and joins it without moving the pages where it is small
    winners = settle(winners, "paths")

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h, w) for h, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["key", "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    out = pages.select(key, "url", "html", host).join(winners, "host", "left").select(key, "url", "html", "winner")
    return out.mapInArrow(again, f"key {kind}, url string, text string, n_chars long").withColumnRenamed("key", key)
