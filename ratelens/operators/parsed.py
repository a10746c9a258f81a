"""Selector-rule extraction with a tolerant HTML parser.

Regular expressions cannot read nested markup (``<div class="a NiGhzc">
<b>H&ocirc;tel</b> &amp; Co</div>``) or decode entities; this module does,
with the standard library's ``html.parser``.  It is the only Python on the
row path, so it is shaped for that:

* one ``pandas_udf`` (Arrow batches), one parse per page, every layout's
  rules evaluated in the same pass, one struct out;
* the rules are a small frozen object captured in the function closure;
* no exception escapes: a page that cannot be read gives a NULL struct and
  the request is classified as broken with a reason.

The struct has the fields of ``extract.PAGE_TYPE`` plus the requested-date
tests and the per-seller block fields (``extras``: one map per seller, with
NULL for a missing field so the pairing with sellers survives).
"""

from __future__ import annotations

import dataclasses
import re
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from types import SimpleNamespace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.operators.extract import ParsedLayout

# Python workers may not have this package on their path (it is not
# installed on the executors); the UDF's code is therefore shipped with the
# function itself, and the rules are passed as plain stdlib objects.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: the package must be on the workers' path
    pass

PARSED_TYPE = (
    "struct<layout:int,names:array<string>,prices:array<string>,"
    "not_available:boolean,contact:boolean,is_listing:boolean,"
    "searched_in:string,searched_out:string,"
    "check_in_found:boolean,check_out_found:boolean,"
    "extras:array<map<string,string>>,labels:array<string>>"
)

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
_INVISIBLE = frozenset(("script", "style", "template", "noscript", "head", "title"))
# Inline styles that hide an element (a browser shows no text for it).
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPACES = re.compile(r"[ \t\r\f\v ]+")
# A start tag of one of these closes an open <p> (HTML's implied end tag);
# the search for that <p> stops at these scope boundaries.
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
_P_SCOPE = frozenset("applet button caption html marquee object table td th template".split())


@dataclass(frozen=True)
class Selector:
    """One compound selector: tag, class tokens, id, attribute tests."""

    tag: str | None = None
    classes: frozenset = frozenset()
    id: str | None = None
    attrs: tuple = ()
    nth: int | None = None  # 1-based place among the parent's children of the same tag

    def matches(self, tag: str, attrs: dict, classes: frozenset) -> bool:
        if self.tag is not None and self.tag != tag:
            return False
        if self.classes and not self.classes <= classes:
            return False
        if self.id is not None and attrs.get("id") != self.id:
            return False
        for name, value in self.attrs:
            if name not in attrs or (value is not None and attrs[name] != value):
                return False
        return True


_SEL_TAG = re.compile(r"\s*([A-Za-z][A-Za-z0-9-]*)")
_SEL_NTH = re.compile(r":nth\((\d+)\)")
_SEL_PART = re.compile(
    r"""\s*(?:([.#])([A-Za-z0-9_-]+)|\[\s*([^\]=\s]+)\s*(?:=\s*["']?([^\]"']*)["']?\s*)?\])""")


def selector(text: str) -> Selector:
    """A compound selector: optional tag, then ``.class``, ``#id``,
    ``[attr]`` and ``[attr=value]`` parts, all on one element, and perhaps
    ``:nth(n)``.

    ``div.NiGhzc``, ``.MEVoGd.AdWm1c``, ``#prices``, ``div[aria-label=x]``.
    Whitespace between parts is ignored; :class:`Path` joins compounds."""
    tag, classes, ident, attrs = None, set(), None, []
    nth = _SEL_NTH.search(text)
    text = _SEL_NTH.sub("", text)
    pos = 0
    m = _SEL_TAG.match(text)
    if m:
        tag, pos = m.group(1).lower(), m.end()
    while pos < len(text.rstrip()):
        m = _SEL_PART.match(text, pos)
        if not m:
            raise ValueError(f"bad selector: {text!r}")
        kind, name, aname, avalue = m.groups()
        if aname is not None:
            attrs.append((aname, avalue))
        elif kind == ".":
            classes.add(name)
        else:
            ident = name
        pos = m.end()
    if tag is None and not classes and ident is None and not attrs:
        raise ValueError(f"empty selector: {text!r}")
    return Selector(tag, frozenset(classes), ident, tuple(attrs), int(nth.group(1)) if nth else None)


class Path:
    """Compound selectors joined by ``>`` (child) or ``>>`` (descendant);
    ``:nth(n)`` asks for the n-th child of its tag.  ``#prices >> section >
    div:nth(2)`` is the second ``div`` child of a section anywhere below the
    element ``prices``."""

    def __init__(self, text: str):
        parts = re.split(r"(>>|>)(?=(?:[^\[\]]|\[[^\]]*\])*$)", text)
        self.steps = [selector(p) for p in parts[::2]]
        self.deep = [sign == ">>" for sign in parts[1::2]]
        self.single = len(self.steps) == 1

    def reached(self, tag, attrs, classes, place, parent, above) -> int:
        """Bits of the steps that end at an element; ``parent`` and ``above``
        are the bits of its parent and of all its ancestors."""
        bits = 0
        for i, step in enumerate(self.steps):
            before = 1 if not i else (above if self.deep[i - 1] else parent) >> (i - 1) & 1
            if before and (step.nth is None or step.nth == place) and step.matches(tag, attrs, classes):
                bits |= 1 << i
        return bits


def classes(text: str) -> str:
    """Selector for an element carrying every class of a class attribute
    value: ``classes("MEVoGd AdWm1c")`` → ``".MEVoGd.AdWm1c"``."""
    return "".join("." + c for c in text.split())


def _text(parts: list[str]) -> str:
    """Visible text of an element: spaces collapsed, lines trimmed."""
    raw = "".join(parts)
    lines = [_SPACES.sub(" ", ln).strip() for ln in raw.split("\n")]
    return "\n".join(ln for ln in lines if ln)


class _Rules:
    """Compiled selectors of one layout, made once per task."""

    def __init__(self, layout: ParsedLayout):
        self.layout = layout.layout
        self.paths: list[Path] = []

        def add(text):
            if not text:
                return None
            self.paths.append(Path(text))
            return len(self.paths) - 1
        self.names = add(layout.names)
        self.prices = add(layout.prices)
        self.present = [add(s) for s in layout.present]
        self.scope = add(layout.scope)
        self.not_available = [add(s) for s in layout.not_available]
        self.contact = [add(s) for s in layout.contact]
        self.listing = [add(s) for s in layout.listing]
        self.searched_in = add(layout.searched_in)
        self.searched_out = add(layout.searched_out)
        self.block = add(layout.block)
        self.block_fields = [(k, add(v)) for k, v in layout.block_fields]
        self.same_block = layout.block is not None and layout.block == layout.names


class _State:
    """Per-page results of one layout."""

    def __init__(self) -> None:
        self.names: list = []
        self.prices: list = []
        self.present = False
        self.not_available = False
        self.contact = False
        self.listing = False
        self.searched_in = None
        self.searched_out = None
        self.scope_depth: int | None = None
        self.scope_done = False
        self.blocks: list = []
        self.block_depth: int | None = None
        self.name_buffers: dict = {}  # open captures of seller names
        self.price_blocks: list = []  # which block each price stands in


#: Elements whose start and end break the line.
_BLOCKS = frozenset(("p", "div", "li", "tr", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6",
                     "ul", "ol", "table", "header", "footer", "nav", "main"))


class _Buffer(list):
    """Text of an open capture; compared by identity."""

    __slots__ = ("muted",)

    def __init__(self):
        super().__init__()
        self.muted = 0  # open block fields whose text isn't the seller's name


class _Page(HTMLParser):
    def __init__(self, rules: list[_Rules], check_in: str | None, check_out: str | None,
                 keep_labels: bool = False):
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.states = [_State() for _ in rules]
        self.check_in, self.check_out = check_in, check_out
        self.in_found = self.out_found = False
        self.keep_labels = keep_labels
        self.labels: dict[str, None] = {}  # aria-labels of div elements, page order
        # open elements: (tag, [captures], invisible, child counts, [step bits], [bits of all above])
        self.stack: list[tuple] = []
        self.open: dict[str, int] = {}  # how many elements of a tag are open
        self.captures: dict[int, _Buffer] = {}  # open captures by identity, oldest first
        self.root_counts: dict[str, int] = {}
        self.hidden = 0

    # capture: a buffer plus a function storing the final text
    def _open_capture(self, store, mutes=()) -> tuple:
        for other in mutes:  # the seller's name goes on after this field
            other.muted += 1
        buf = _Buffer()
        self.captures[id(buf)] = buf
        return (buf, store, mutes)

    def _newline(self):
        for buf in self.captures.values():
            if not buf.muted:
                buf.append("\n")

    def handle_starttag(self, tag, attrs):
        amap = {k: (v if v is not None else "") for k, v in attrs}
        classes = frozenset(amap.get("class", "").split())
        label = amap.get("aria-label")
        if label is not None:
            if self.keep_labels and tag == "div":
                self.labels[label] = None
            if self.check_in is not None and label == self.check_in:
                self.in_found = True
            if self.check_out is not None and label == self.check_out:
                self.out_found = True
        if tag in _CLOSES_P:
            self._implied_end("p")
        if tag == "li":
            self._implied_end("li", stop=frozenset(("ul", "ol")) | _P_SCOPE)
        counts = self.stack[-1][3] if self.stack else self.root_counts
        counts[tag] = place = counts.get(tag, 0) + 1
        parents, aboves = (self.stack[-1][4], self.stack[-1][5]) if self.stack else (None, None)
        bits, above = [], []
        for k, r in enumerate(self.rules):
            row = [p.reached(tag, amap, classes, place, parents[k][j] if parents else 0, aboves[k][j] if aboves else 0)
                   for j, p in enumerate(r.paths)]
            bits.append(row)
            above.append([x | (aboves[k][j] if aboves else 0) for j, x in enumerate(row)])
        if tag in _VOID:
            if tag == "br":
                self._newline()
            self._flags(bits, depth=None)
            return
        if tag in _BLOCKS:
            self._newline()
        depth = len(self.stack)
        opened = self._flags(bits, depth)
        invisible = (tag in _INVISIBLE or "hidden" in amap
                     or bool(_HIDDEN_STYLE.search(amap.get("style", ""))))
        if invisible:
            self.hidden += 1
        self.stack.append((tag, opened, invisible, {}, bits, above))
        self.open[tag] = self.open.get(tag, 0) + 1

    def _implied_end(self, tag, stop=_P_SCOPE):
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            t = self.stack[i][0]
            if t == tag:
                self.handle_endtag(tag)
                return
            if t in stop:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def _flags(self, bits, depth):
        opened = []
        for r, st, row in zip(self.rules, self.states, bits):
            def m(j, r=r, row=row):
                return j is not None and bool(row[j] >> (len(r.paths[j].steps) - 1) & 1)
            st.present = st.present or any(map(m, r.present))
            st.not_available = st.not_available or any(map(m, r.not_available))
            st.contact = st.contact or any(map(m, r.contact))
            st.listing = st.listing or any(map(m, r.listing))
            if depth is None:
                continue
            if r.scope is not None and st.scope_depth is None and not st.scope_done and m(r.scope):
                st.scope_depth = depth
            in_scope = r.scope is None or st.scope_depth is not None
            if in_scope and m(r.names):
                st.names.append(None)
                opened.append(self._open_capture(_setter(st.names, len(st.names) - 1)))
                st.name_buffers[id(opened[-1][0])] = opened[-1][0]
            if in_scope and m(r.prices):
                st.prices.append(None)
                st.price_blocks.append(len(st.blocks) - 1 if st.block_depth is not None else None)
                opened.append(self._open_capture(_setter(st.prices, len(st.prices) - 1)))
            if st.searched_in is None and m(r.searched_in):
                opened.append(self._open_capture(_attr_setter(st, "searched_in")))
            if st.searched_out is None and m(r.searched_out):
                opened.append(self._open_capture(_attr_setter(st, "searched_out")))
            if r.block is not None and in_scope and st.block_depth is None and m(r.block):
                st.blocks.append({k: None for k, _ in r.block_fields})
                st.block_depth = depth
            elif st.block_depth is not None and r.block_fields:
                block = st.blocks[-1]
                for key, sel in r.block_fields:
                    if block[key] is None and m(sel):
                        opened.append(self._open_capture(_dict_setter(block, key),
                                                         list(st.name_buffers.values())))
        return opened

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return  # stray end tag: ignore
        while self.stack:
            top = self._pop()
            if top == tag:
                break

    def _pop(self):
        tag, opened, invisible, *_ = self.stack.pop()
        self.open[tag] -= 1
        if tag in _BLOCKS:
            self._newline()
        depth = len(self.stack)
        if invisible:
            self.hidden -= 1
        for buf, store, silenced in reversed(opened):
            store(_text(buf))
            for other in silenced:
                other.muted -= 1
            del self.captures[id(buf)]
            for st in self.states:
                st.name_buffers.pop(id(buf), None)
        for st in self.states:
            if st.scope_depth is not None and depth == st.scope_depth:
                st.scope_depth = None
                st.scope_done = True
            if st.block_depth is not None and depth == st.block_depth:
                st.block_depth = None
        return tag

    def handle_data(self, data):
        if self.hidden:
            return
        for buf in self.captures.values():
            if not buf.muted:
                buf.append(data)

    def finish(self) -> None:
        self.close()
        while self.stack:
            self._pop()


def _setter(lst, i):
    def store(text):
        lst[i] = text
    return store


def _attr_setter(obj, name):
    def store(text):
        setattr(obj, name, text)
    return store


def _dict_setter(d, key):
    def store(text):
        d[key] = text
    return store


def compile_rules(layouts: Sequence[ParsedLayout]) -> list[_Rules]:
    """Rules in priority order; raises ``ValueError`` on a bad selector."""
    return [_Rules(x) for x in sorted(layouts, key=lambda x: x.layout)]


def parse_page(html: str | None, layouts: Sequence[ParsedLayout] | list[_Rules],
               check_in: str | None = None, check_out: str | None = None,
               keep_labels: bool = False) -> dict | None:
    """Extract one page; ``None`` when html is missing or no layout is
    present.  Plain Python, used by the UDF and by tests."""
    if html is None:
        return None
    rules = layouts if layouts and isinstance(layouts[0], _Rules) else compile_rules(layouts)
    page = _Page(rules, check_in, check_out, keep_labels)
    try:
        page.feed(html)
        page.finish()
    except AssertionError:  # html.parser's answer to a declaration it can't read
        return None
    for r, st in zip(rules, page.states):
        if r.present and not st.present:
            continue
        names = [n.replace("\n", " ") for n in st.names if n]
        prices = [p for p in st.prices if p]
        extras = None
        if r.block is not None:
            extras = [dict(b) for b in st.blocks]
            if r.same_block and len(extras) == len(st.names):
                # one block per seller element: drop the blank sellers' blocks too
                extras = [e for n, e in zip(st.names, extras) if n]
        if r.block is not None and not r.same_block and len(st.blocks) == len(st.names) \
                and sorted(x for x in st.price_blocks if x is not None) == list(range(len(st.blocks))):
            # every seller's block holds its price: paired there, blank or not
            by_block = dict(zip(st.price_blocks, st.prices))
            pairs = [(n, by_block[i]) for i, n in enumerate(st.names) if n]
            names, prices = [n.replace("\n", " ") for n, _ in pairs], [p or None for _, p in pairs]
            extras = [dict(b) for n, b in zip(st.names, st.blocks) if n]
        return {
            "layout": r.layout,
            "names": names,
            "prices": prices,
            "not_available": st.not_available,
            "contact": st.contact,
            "is_listing": st.listing,
            "searched_in": st.searched_in,
            "searched_out": st.searched_out,
            "check_in_found": page.in_found if check_in is not None else None,
            "check_out_found": page.out_found if check_out is not None else None,
            "extras": extras,
            "labels": list(page.labels),
        }
    return None


def extract_parsed(df: DataFrame, layouts: Sequence[ParsedLayout], html_col: str = "html",
                   check_in: str | None = None, check_out: str | None = None,
                   out: str = "page", keep_labels: bool = True) -> DataFrame:
    """Add the ``page`` struct computed by the HTML parser; the div
    ``aria-label`` values of a page only with ``keep_labels``.

    ``check_in`` / ``check_out`` name columns whose values are looked up
    as ``aria-label`` attributes on the page (the requested dates)."""
    frozen = tuple(SimpleNamespace(**dataclasses.asdict(lay)) for lay in layouts)
    compile_rules(frozen)  # fail fast on a bad rule, on the driver

    @F.pandas_udf(PARSED_TYPE)
    def _extract(html: pd.Series, cin: pd.Series, cout: pd.Series) -> pd.DataFrame:
        rows, rules = [], compile_rules(frozen)
        for h, a, b in zip(html, cin, cout):
            page = parse_page(h if isinstance(h, str) else None, rules,
                              a if isinstance(a, str) else None,
                              b if isinstance(b, str) else None, keep_labels)
            rows.append(page)
        return _to_frame(rows)

    cin: Column = F.col(check_in) if check_in else F.lit(None).cast("string")
    cout: Column = F.col(check_out) if check_out else F.lit(None).cast("string")
    raw = "_rl_parsed"
    # Arrow cannot carry a NULL struct; a NULL ``layout`` marks "no page".
    return df.withColumn(raw, _extract(F.col(html_col), cin, cout)).withColumn(
        out, F.when(F.col(raw + ".layout").isNotNull(), F.col(raw))).drop(raw)


_FIELDS = ["layout", "names", "prices", "not_available", "contact", "is_listing",
           "searched_in", "searched_out", "check_in_found", "check_out_found", "extras",
           "labels"]


def _to_frame(rows: list) -> pd.DataFrame:
    # A NULL struct is a row of NULL fields; ``page.layout IS NULL`` marks it.
    data = {f: [None if r is None else r[f] for r in rows] for f in _FIELDS}
    return pd.DataFrame(data)
