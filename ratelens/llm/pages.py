"""Main text of web pages by differencing each page with its nearest URL.

A page is read into lines: the text of one block element each, with the zone
it stands in (article, chrome such as menus or footers, or neither).  Within
every host pages are sorted by URL path, and each is paired with the neighbour
whose path agrees with its own the longest; the longest common subsequence of
both pages' lines is what the site repeats from page to page, and these lines
are deleted.  Two things bound the deletion: lines inside an element that
marks the article are content even where two pages share a paragraph, and a
page all of whose other lines are shared is a copy of its neighbour and keeps
them.  Lines in chrome zones go in any case; a region that its class name or a
form rules out still gives way to an article that begins in it.

Only hashes of lines travel for pairing and alignment; a host with a third of
all pages is sorted by ranges like any other.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage, in_workers

#: Elements whose content is never text.
SILENT = {"script", "style", "noscript", "template", "head", "svg", "math", "iframe", "object", "canvas",
          "select", "textarea", "button", "title", "audio", "video", "map", "datalist"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
          "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog"}
CONTENT = {"article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog",
         "dialog", "menu", "menubar", "toolbar"}
#: Words of class and id attributes that mark what isn't the article.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored",
         "promo", "promotion", "sidebar", "rail", "widget", "widgets", "menu", "nav", "navbar", "navigation",
         "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "cookie", "cookies", "consent", "gdpr",
         "notice", "notices", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal",
         "overlay", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
         "comments", "disqus", "respond", "replies", "pagination", "pager", "skip", "toolbar", "copyright",
         "disclaimer", "legal", "paywall"}
#: Class tokens that begin with one of these say what a page has, not what an element is.
STATES = {"has", "no", "with", "without", "is", "not"}
#: Words beside a mark in a class token; with others (``share-price``) it names a topic, inside an article.
NEUTRAL = {"area", "bar", "block", "bottom", "box", "btn", "button", "buttons", "container", "content", "form", "icon",
           "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "module", "page", "panel", "right",
           "section", "site", "slot", "text", "title", "top", "unit", "wrap", "wrapper"}
#: Marks of regions whose own articles are not the page's.
OTHERS = {"comment", "comments", "disqus", "replies", "respond", "related", "recommended", "recommendations", "sidebar",
          "rail", "widget", "widgets"}
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=(?:\s*\"[^\"]*\"|\s*'[^']*')?)*)(?:>|\Z)", re.S)
#: a tag with a quote that never ends
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}
#: What can stand in a head; any other start tag, or text, ends an open one.
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "noframes", "noscript", "script", "style", "template", "title",
           "head"}
#: Start tags that end an open element of these names.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Zones of a page.  SOFT is off as well, but an article may begin in it; WRAPPED
#: is the inside of a form, which may be around the whole page.
ARTICLE, PLAIN, OFF, SOFT, WRAPPED = 2, 1, 0, 3, 4
#: Pairs of equal lines up to which two pages are aligned at once.
MATCHES = 200_000
#: Deleted lines are broadcast up to this many (4 bytes each).
BROADCAST_LINES = 2_000_000


def _marks(names: str, in_article: bool) -> set[str]:
    """The words of class and id tokens that mark what isn't the article."""
    out: set[str] = set()
    for token in names.split():
        words = [w.lower() for w in _WORD.findall(token)]
        marks = MARKS.intersection(words)
        if not in_article and "header" in words:
            marks.add("header")
        if words and words[0] not in STATES and (not in_article or all(w in marks or w in NEUTRAL for w in words)):
            out |= marks
    return out


def _zone(name: str, attrs: str, in_article: bool) -> int | None:
    """The zone an element opens, or None to go on in the one above."""
    if name == "form":
        return OFF if in_article else WRAPPED
    if name in CHROME or name == "header" and not in_article:
        return OFF
    role = ""
    if attrs:
        found = {key.lower(): html.unescape(a or b or c) for key, a, b, c in _ATTR.findall(attrs)}
        if ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                or _HIDES.search(found.get("style", ""))):
            return OFF
        role = found.get("role", "").lower()
        if role in ROLES:
            return OFF
        if name not in ("html", "body"):
            marks = _marks(f"{found.get('class', '')} {found.get('id', '')}", in_article)
            if name in CONTENT:
                if marks & OTHERS:
                    return OFF
            elif marks:
                return OFF if in_article or marks & OTHERS else SOFT
    return ARTICLE if name in CONTENT or role in ("main", "article") else None


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """``(text, zone)`` of each block of a page, in page order.

    Character references are decoded, white space inside a block becomes one
    space, blocks without text give nothing; unclosed and stray tags are taken
    as browsers do, roughly: a block's start tag ends an open paragraph, text
    and what cannot stand in a head end an open head, an end tag closes what is
    open inside its element, and is ignored without one.
    """
    page = page or ""
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool]] = []      # element, zone, silent
    opened: dict[str, int] = {}
    zone, silent = PLAIN, False

    def flush():
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if line:
                out.append((line, zone))

    def close(k):
        """Close the element at ``k`` of the stack and all inside it."""
        nonlocal zone, silent
        while len(stack) > k:
            opened[stack.pop()[0]] -= 1
        zone, silent = (stack[-1][1], stack[-1][2]) if stack else (PLAIN, False)

    def end_head():
        while stack and stack[-1][0] == "head":
            close(len(stack) - 1)

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if silent and stack[-1][0] == "head" and page[at:lt].strip():
            end_head()
        if lt > at and not silent:
            text.append(page[at:lt])
        if lt == n:
            break
        m = _TOKEN.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            if not silent:
                text.append("<")
            at = lt + 1
            continue
        at = m.end()
        name, attrs = m[2] and m[2].lower(), m[3]
        if not name:
            continue
        if m[1]:
            if not opened.get(name):
                if name in ("p", "br"):
                    flush()
                continue
            k = max(i for i, e in enumerate(stack) if e[0] == name)
            if name in INLINE and any(e[0] not in INLINE for e in stack[k:]):
                del stack[k]                  # misnested: the blocks inside stay open
                opened[name] -= 1
                continue
            if name not in INLINE or (stack[k - 1][1] if k else PLAIN) != zone:
                flush()
            close(k)
            continue
        if silent and name not in IN_HEAD:
            end_head()
        if name == "br":
            if not silent:
                text.append(" ")
            continue
        block = name not in INLINE
        if block:
            flush()
            ends = CLOSES.get(name, ())
            if name not in ("html", "body", "head") and opened.get("p") and name != "option" and "p" not in ends:
                ends = {"p", *ends}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][0] not in INLINE and stack[k][0] not in ("p", "li", "dt", "dd", "td", "th"):
                    break
        if name in VOID:
            continue
        own = _zone(name, attrs, zone == ARTICLE)
        # in a region that only its class name rules out an article may begin, but nothing else
        if own is None or own == zone or zone == OFF or zone == SOFT and own not in (ARTICLE, OFF):
            inner = zone
        else:
            flush()
            inner = own
        if attrs.endswith("/") and name in ("svg", "path", "use", "g", "circle", "rect"):
            continue
        quiet = silent or name in SILENT
        if name in RAW:
            end = _END[name].search(page, at)
            at = end.end() if end else n
            continue
        stack.append((name, inner, quiet))
        opened[name] = opened.get(name, 0) + 1
        zone, silent = inner, quiet
    flush()
    # a form that holds most of a page without an article is the page
    sizes = {z: sum(len(t) for t, y in out if y == z) for z in (PLAIN, ARTICLE, WRAPPED)}
    rest = PLAIN if not sizes[ARTICLE] and sizes[WRAPPED] > sizes[PLAIN] else OFF
    return [(t, rest if z == WRAPPED else OFF if z == SOFT else z) for t, z in out]


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of a longest common subsequence of ``a`` with every start of ``b``,
    64 lines of ``b`` a machine step."""
    at: dict[int, int] = {}
    for j, y in enumerate(b):
        at[y] = at.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & at.get(x, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(bits == 0)))


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence of both.  Pages with
    many equal lines are halved where the halves' subsequences are longest
    together, so repeated lines cost no more than (lines x lines / 64)."""
    uses = Counter(b)
    if len(a) > 1 and sum(uses[x] for x in a) > MATCHES:
        m = len(a) // 2
        head, tail = _lengths(a[:m], b), _lengths(a[m:][::-1], b[::-1])
        cut = int(np.argmax(head + tail[::-1]))
        return common_lines(a[:m], b[:cut]) | {m + i for i in common_lines(a[m:], b[cut:])}
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < len(a) - lo and hi < len(b) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    out = set(range(lo)) | set(range(len(a) - hi, len(a)))
    places: dict[int, list[int]] = {}
    for j in range(lo, len(b) - hi):
        places.setdefault(b[j], []).append(j)
    # the longest increasing run of matching positions, found by patience
    tails: list[int] = []
    nodes: list[tuple[int, int] | None] = []
    chain: list = []
    for i in range(lo, len(a) - hi):
        for j in reversed(places.get(a[i], ())):
            k = bisect_left(tails, j)
            node = (i, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(node)
            else:
                tails[k] = j
                chain[k] = node
    node = chain[-1] if chain else None
    while node:
        out.add(node[0])
        node = node[1]
    return out


def _line_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, zones = [], []
        for page in batch.column(1):
            found = lines_of(page.as_py())
            hashes.append([int.from_bytes(blake2b(t.encode(), digest_size=8).digest(), "big", signed=True)
                           for t, _ in found])
            zones.append([z for _, z in found])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(hashes, pa.list_(pa.int64())), pa.array(zones, pa.list_(pa.int8()))],
            names=["page", "hashes", "zones"])


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page, hashes, zones, other) -> the lines that a page shares with its
    partner, of those that no zone decides about; pages without any are left out."""
    for batch in batches:
        pages, drops = [], []
        for page, hashes, zones, other in zip(*(batch.column(i).to_pylist() for i in range(4))):
            shared = common_lines(hashes, other or [])
            open_ = [i for i, z in enumerate(zones) if z == PLAIN]
            if open_ and all(i in shared for i in open_) and ARTICLE not in zones:
                shared = set()          # a copy: the difference says nothing
            if found := [i for i in open_ if i in shared]:
                pages.append(page)
                drops.append(found)
        yield pa.RecordBatch.from_arrays([pa.array(pages, batch.schema.field(0).type),
                                          pa.array(drops, pa.list_(pa.int32()))], names=["page", "drops"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, drops in zip(batch.column(2), batch.column(3).to_pylist()):
            gone = set(drops or ())
            texts.append("\n".join(t for i, (t, z) in enumerate(lines_of(page.as_py())) if z != OFF and i not in gone))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                         names=["id", "url", "text"])


def nearest_pages(pages: DataFrame, n: int) -> DataFrame:
    """``(page, partner)``: for ``pages(page, url)`` the neighbour in the order
    of URL paths within the host whose path agrees the longest; none for a host
    with a single page.  Sorted by ranges, so no host is one task."""
    bare = F.regexp_replace(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://", "")
    keys = pages.select("page", F.lower(F.regexp_extract(bare, r"^[^/?#]*", 0)).alias("host"),
                        F.regexp_replace(F.regexp_replace(bare, r"^[^/?#]*", ""), r"[?#].*$", "").alias("path"))
    dealt = cut_lineage(keys.repartitionByRange(n, "host", "path", "page").withColumn("part", F.spark_partition_id()))
    row = F.struct("host", "path", "page")
    order = Window.partitionBy("part").orderBy("host", "path", "page")
    inner = dealt.select("part", "host", "path", "page", F.lag(row).over(order).alias("before"),
                         F.lead(row).over(order).alias("after"))
    # the rows at the ends of ranges have their neighbours in the ranges beside
    ends = dealt.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    line = Window.orderBy("part")                      # one row per range
    ends = ends.select("part", F.lag("last").over(line).alias("left"), F.lead("first").over(line).alias("right"))
    both = inner.join(F.broadcast(ends), "part").select(
        "host", "path", "page", F.coalesce("before", "left").alias("before"), F.coalesce("after", "right").alias("after"))

    def agreement(other):
        segments = F.zip_with(F.split("path", "/"), F.split(F.col(other)["path"], "/"), lambda x, y: F.coalesce(x == y, F.lit(False)))
        first = F.array_position(segments, F.lit(False))
        return F.when(F.col(other)["host"] == F.col("host"),
                      F.when(first == 0, F.size(segments)).otherwise(first - 1).cast("int")).otherwise(-1)
    closer = both.withColumn("b", F.coalesce(agreement("before"), F.lit(-1))).withColumn(
        "a", F.coalesce(agreement("after"), F.lit(-1)))
    return closer.select("page", F.when((F.col("b") >= F.col("a")) & (F.col("b") >= 0), F.col("before")["page"])
                         .when(F.col("a") >= 0, F.col("after")["page"]).alias("partner"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``(id_col, url_col, text_col, length_col)`` per page: blocks of the
    article in page order, joined by line feeds.

    NULL and empty markup gives an empty text; a NULL url belongs to a host
    without name; a page without a neighbour on its host is judged by its
    zones alone, as are rows with a NULL id.  Rows that repeat an id are pages
    of their own unless url and markup are equal too.  An empty table gives an
    empty result; other columns are not read.
    """
    spark = pages.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    # a page is known by its id, url and markup
    rows = rows.withColumn("page", F.when(F.col("id").isNotNull(), F.concat_ws(
        ":", F.lpad(F.col("id").cast("string"), 20, "0"), F.hex(F.xxhash64("url", "html")))))
    kind, id_kind = "string", rows.schema["id"].dataType.simpleString()
    known = rows.where("page IS NOT NULL")
    hashes = cut_lineage(in_workers(known.select("page", "html")).mapInArrow(
        _line_hashes, f"page {kind}, hashes array<bigint>, zones array<tinyint>")).dropDuplicates(["page"])
    pairs = nearest_pages(known.select("page", "url").dropDuplicates(["page"]), n)
    aligned = (hashes.join(pairs, "page", "left")
               .join(hashes.select(F.col("page").alias("partner"), F.col("hashes").alias("other")), "partner", "left")
               .select("page", "hashes", "zones", "other"))
    drops = cut_lineage(in_workers(aligned).mapInArrow(_align, f"page {kind}, drops array<int>"))
    size = drops.agg(F.coalesce(F.sum(F.size("drops") + 4), F.lit(0))).first()[0]
    if size <= BROADCAST_LINES:      # then the markup needn't be moved
        drops = F.broadcast(drops)
    joined = (rows.join(drops.withColumnRenamed("page", "p"), F.col("page") == F.col("p"), "left")
              .select("id", "url", "html", "drops"))
    texts = in_workers(joined).mapInArrow(_texts, f"id {id_kind}, url string, text string")
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("text").alias(text_col),
                        F.length("text").cast("long").alias(length_col))
