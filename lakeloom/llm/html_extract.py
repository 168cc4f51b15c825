"""Main text of web pages: gradient-boosted trees over DOM-node features, decoded over the tree.

A page is parsed into block elements and text runs (text between block boundaries; inline elements and line breaks do not end a
run). Each node gets features: its tag, tokens of its class, id and role and of its ancestors', depth, text, tags, link text and punctuation
of its subtree, and statistics of its siblings. The trees give each node's log-odds of holding main text. Decoding chooses the labels
of greatest total log-odds among those in which nothing below a rejected node is kept, so ancestors and descendants never contradict.

The trees are trained when the operator is built, on invented pages (`html_pages`), always with the same result.

Defined results: null or empty html gives the empty text; a page whose best labels reject everything gives the empty text; markup
that never closes ends with the page, but an element of raw text without an end tag is skipped alone; text of formulas stays, icons
go; repeated pages are each reported; other columns are not read; an empty table gives no rows. Parsing takes time in proportion to the
page, however its tags are nested or unbalanced; a very long page takes some tens of times its bytes in one worker.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.boosting import Trees
from lakeloom.llm.common import ship
from lakeloom.llm.html_pages import Page

TRAIN_PAGES = 600
#: Characters of html whose nodes are scored together.
GROUP_CHARS = 2 << 20

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"  # comments and declarations
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)>"  # tags; a quote that never closes ends at the next >
    r"|<[/a-zA-Z][^>]*+\Z",  # a tag that never closes
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "select", "xmp", "noframes"}
#: Elements of other vocabularies: these can close themselves and nest. Inside some of their own elements html may stand; elsewhere
#: an opening tag of html ends them.
_FOREIGN = {"svg": {"foreignobject", "desc", "title"}, "math": {"mtext", "annotation-xml", "mi", "mo", "mn", "ms"}}
_BREAKS = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var article section main aside nav header footer form a".split())
_NOTE = re.compile(r"<(annotation(?:-xml)?)\b[^>]*+>.*?</\1\s*>", re.S | re.I)
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag of the key closes an open tag of the values first.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
_HOLDS = {"div", "section", "article", "main", "body", "blockquote", "table", "form"}
_BOUNDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}

_TAGS = ["#text", "p", "div", "section", "article", "main", "h1", "h2", "ul", "li", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "body", "other"]
_TAG_NUMBER = {t: i for i, t in enumerate(_TAGS)} | {t: 7 for t in ("h3", "h4", "h5", "h6")} | {"ol": 8, "th": 16, "dl": 8, "dd": 9, "dt": 9}
#: Families of names that page authors give to parts of a page.
_FAMILIES = {
    "main": "article content entry main post story text body blog news copy page",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs crumbs topnav pagination pager skip toc",
    "header": "header masthead topbar branding logo head top banner",
    "footer": "footer foot bottom copyright colophon legal imprint",
    "side": "sidebar side widget related recommended popular tags rail more trending aside complementary recent archive",
    "ad": "ad ads advert advertisement adbox sponsor sponsored promo promotion adsense banner affiliate",
    "notice": "cookie cookies notice consent popup modal alert gdpr newsletter overlay privacy warning toast",
    "comments": "comment comments reply replies respond discussion disqus reader readers feedback review reviews",
    "share": "share social follow twitter facebook sharing buttons",
    "form": "form search signup login subscribe contact register",
}
_FAMILY = {w: i for i, words in reversed(list(enumerate(_FAMILIES.values()))) for w in words.split()}
_JUNK_TAGS = {"nav": 1, "header": 2, "footer": 3, "aside": 4, "form": 9}
N_FAMILIES = len(_FAMILIES)


class Dom:
    """Nodes of a page in page order, by column; node 0 is the page."""

    def __init__(self) -> None:
        self.tag, self.parent, self.names, self.text = ["body"], [-1], [0], [None]
        self.links, self.n_inline, self.own = [0], [0], [0]

    def add(self, tag: str, parent: int, names: int, text: str | None = None, links: int = 0, inline: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.text.append(text)
        self.links.append(links)
        self.n_inline.append(inline)
        return len(self.tag) - 1


def names_of(attributes: str) -> int:
    """Bits of the families that the attributes name; the highest bit if they hide the element."""
    bits = 0
    for key, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        key = key.lower()
        if key in ("class", "id", "role"):
            for w in _NAME.findall(value):
                if w in _FAMILY:
                    bits |= 1 << _FAMILY[w]
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            bits |= 1 << N_FAMILIES
    return bits


def closes_itself(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of an unquoted value."""
    return attributes.endswith("/") and not re.search(r"=\s*[^\s\"']*/\Z", attributes)


def foreign_end(html: str, at: int, tag: str, attributes: str) -> int:
    """Where the svg or math ends whose opening tag ends at `at`: after its own end tag (the last one if some are missing), before an
    opening tag that cannot stand in it, or with the page."""
    if closes_itself(attributes):
        return at
    depth, inside, last = 1, 0, len(html)
    while depth and (m := _TOKEN.search(html, at)):
        at, name = m.end(), (m[2] or "").lower()
        if name == tag:
            if m[1]:
                depth, last = depth - 1, at
            elif not closes_itself(m[3]):
                depth += 1
        elif name in _FOREIGN[tag]:
            inside = max(0, inside - 1) if m[1] else inside + (not closes_itself(m[3]))
        elif not inside and not m[1] and name in _BREAKS:
            return m.start()
    return last


class Open:
    """The open elements of a page, with the places of each tag and of the blocks among them."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, int, bool]] = [("#page", 0, True)]  # tag, node of the nearest block, whether it is a block
        self.places: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, tag: str, node: int, block: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if block:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, node, block))

    def pop(self) -> tuple[str, int, bool]:
        tag, node, block = self.stack.pop()
        self.places[tag].pop()
        if block:
            self.blocks.pop()
        return tag, node, block

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)


def parse(html: str) -> Dom:
    """Block elements and text runs of a page."""
    dom, at, open_ = Dom(), 0, Open()
    run: list[str] = []
    run_links, open_links, inline, skip_head = 0, 0, 0, 0
    endless: set[str] = set()

    def flush() -> None:
        nonlocal run_links, inline
        if run:
            text = "".join(run)
            if "&" in text:
                text = unescape(text)
            text = " ".join(text.split())
            if text and not skip_head:
                dom.add("#text", open_.stack[-1][1], 0, text, min(run_links, len(text)), inline)
            run.clear()
        run_links = inline = 0

    def say(text: str) -> None:
        nonlocal run_links
        if text:
            run.append(text)
            if open_links:
                run_links += len(text)

    def close_to(n: int) -> None:
        nonlocal skip_head, open_links
        while len(open_.stack) > n:
            if open_.stack[-1][2]:
                flush()
            tag, _, _ = open_.pop()
            open_links -= tag == "a"
            skip_head -= tag == "head"

    def raw_end(tag: str, attributes: str) -> int:
        """Where an element of raw text ends whose opening tag ends at `at`."""
        if tag in endless:
            return at
        own = closes_itself(attributes)
        if own and tag not in ("script", "style"):
            return at
        end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
        if not end:
            endless.add(tag)
            return at if own or tag not in ("script", "style") else size
        if own and re.compile(rf"<{tag}[\s/>]", re.I).search(html, at, end.start()):
            return at
        return html.find(">", end.start()) + 1 or size

    size = len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if not m:
            say(html[at:])
            break
        say(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:  # a comment or declaration
            continue
        tag = tag.lower()
        if m[1]:
            i = open_.last((tag,))
            if tag == "br" or tag == "p" and not i:
                run.append(" ")
            elif i and not (tag in _INLINE and i < open_.blocks[-1]):
                close_to(i)
            continue
        if tag in _FOREIGN:
            end = foreign_end(html, at, tag, m[3])
            if tag == "math":
                say(_TOKEN.sub("", _NOTE.sub("", html[at:end])))
            else:
                run.append(" ")
            at = end
            continue
        if tag in _RAW:
            at = raw_end(tag, m[3])
            run.append(" ")
            continue
        if tag in _INLINE:
            inline += 1
            if tag in _VOID:
                run.append(" " if tag == "br" else "")
                continue
            open_links += tag == "a"
            open_.push(tag, open_.stack[-1][1], False)
            continue
        if tag == "html":
            continue
        if tag == "head":
            flush()
            skip_head += 1
            open_.push(tag, open_.stack[-1][1], True)
            continue
        if skip_head and tag not in _VOID:
            close_to(open_.places["head"][0])
        flush()
        if tag in _VOID or tag == "body":
            continue
        ends, bounds = {"p"} | _CLOSES.get(tag, set()), _HOLDS | _BOUNDS.get(tag, set())
        while (i := open_.last(ends)) > open_.last(bounds):  # a block ends an open paragraph, an item the item before it
            close_to(i)
        node = dom.add(tag, open_.stack[-1][1], names_of(m[3]) if m[3] else 0)
        open_.push(tag, node, True)
    close_to(1)
    flush()
    return dom


def features(dom: Dom) -> np.ndarray:
    """One row of features for each node."""
    n = len(dom.tag)
    parent = np.array(dom.parent)
    chars = np.array([len(t) if t else 0 for t in dom.text], float)
    leaf = chars > 0
    stops = np.array([sum(map(t.count, ".,!?;:")) if t else 0 for t in dom.text], float)
    words = np.array([t.count(" ") + 1 if t else 0 for t in dom.text], float)
    links, inline = np.array(dom.links, float), np.array(dom.n_inline, float)
    tags = np.array([_TAG_NUMBER.get(t, 19) for t in dom.tag], float)
    para = (tags == 1).astype(float)
    total = np.stack([chars, stops, words, links, np.ones(n), para, leaf.astype(float), inline, (tags == 6).astype(float)], 1)
    depth, above, nth, kids, after = np.zeros(n), np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n)
    own = np.array([b | (1 << _JUNK_TAGS[t] if t in _JUNK_TAGS else 0) | (1 if t in ("article", "main") else 0) for b, t in zip(dom.names, dom.tag, strict=True)])
    before = np.cumsum(chars) - chars
    for i in range(1, n):  # parents come before children
        p = parent[i]
        depth[i], above[i], nth[i] = depth[p] + 1, above[p] | own[p], kids[p]
        kids[p] += 1
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    up = np.maximum(parent, 0)
    whole = max(total[0, 0], 1)
    c = total[:, 0]
    # The sibling before and after, and the largest sibling.
    largest = np.zeros(n)
    np.maximum.at(largest, up[1:], c[1:])
    same = {}
    for i in range(1, n):
        same[key] = same.get(key := (dom.parent[i], tags[i]), 0) + 1
    alike = np.array([0, *(same[(dom.parent[i], tags[i])] for i in range(1, n))])
    bits = [(own >> k & 1).astype(float) for k in range(N_FAMILIES + 1)] + [(above >> k & 1).astype(float) for k in range(N_FAMILIES + 1)]
    columns = [
        tags, tags[up], depth, np.log1p(c), np.log1p(total[:, 2]), c / total[:, 4], total[:, 3] / np.maximum(c, 1), total[:, 1] / np.maximum(total[:, 2], 1),
        np.log1p(total[:, 4]), total[:, 5], total[:, 6], total[:, 7] / np.maximum(total[:, 6], 1), nth, kids[up], kids, alike, c / np.maximum(c[up], 1), c / np.maximum(largest[up], 1), c / whole, before / whole, (before + c) / whole,
        c[up] / total[up, 4], total[up, 3] / np.maximum(c[up], 1), c[up] / whole, before[up] / whole, total[up, 8], c[up[up]] / whole, before[up[up]] / whole, total[up[up], 8],
        *bits,
    ]
    return np.stack(columns, 1)


def decode(dom: Dom, odds: np.ndarray) -> list[str]:
    """Texts of the kept runs: greatest total log-odds, nothing kept below a rejected node."""
    gain = odds.copy()
    for i in range(len(odds) - 1, 0, -1):  # what keeping a node adds, with the best choice for all below it
        if gain[i] > 0:
            gain[dom.parent[i]] += gain[i]
    kept = np.zeros(len(odds), bool)
    kept[0] = gain[0] > 0
    for i in range(1, len(odds)):
        kept[i] = kept[dom.parent[i]] and gain[i] > 0
    return [t for t, k in zip(dom.text, kept, strict=True) if k and t]


@functools.lru_cache(maxsize=1)
def trained() -> Trees:
    """Trees fitted to the invented pages."""
    rows, labels = [], []
    for seed in range(TRAIN_PAGES):
        page = Page(seed)
        dom = parse(page.html)
        wanted = {" ".join(unescape(b).split()) for b in page.blocks}
        good = np.array([t in wanted if t else False for t in dom.text])
        for i in range(len(good) - 1, 0, -1):
            good[dom.parent[i]] |= good[i]
        rows.append(features(dom))
        labels.append(good)
    return Trees().fit(np.concatenate(rows), np.concatenate(labels).astype(float))


def extract_pages(pages: list[str], model: Trees) -> list[str]:
    """Main text of each page."""
    out, held, size = [], [], 0

    def close() -> None:
        odds = model.predict(np.concatenate([features(d) for d in held]))
        at = np.cumsum([len(d.tag) for d in held])[:-1]
        out.extend("\n\n".join(decode(d, o)) for d, o in zip(held, np.split(odds, at), strict=True))
        held.clear()

    for html in pages:
        held.append(parse(html))
        size += len(html)
        if size >= GROUP_CHARS:
            close()
            size = 0
    if held:
        close()
    return out


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text (its main text) and n_chars."""
    spark = pages.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(trained())
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = extract_pages([x or "" for x in b.column(2).to_pylist()], model.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["_id", "_url", "text", "n_chars"])

    df = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html")).mapInArrow(rows, f"_id {kinds[0]}, _url {kinds[1]}, text string, n_chars long")
    return df.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
