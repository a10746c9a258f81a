"""Elements of a page as intervals, in DataFrame operations only.

Markup is cut into tokens (a tag with the text behind it) by one regular
expression; everything about nesting is a running sum over a page's tokens:

* start and end tags of one name pair up where that name's running depth says
  so; end tags without a start tag count for nothing, elements without an end
  tag end where HTML ends them (``_ENDED_BY``), or with their parent;
* with these ends the running depth of all elements gives every element its
  level, and within a level start and end alternate: an element is the
  interval of tokens ``[pos, end)``.  Intervals nest or are apart; elements
  that overlap in the markup end in the order opposite to their starts;
* the parent is the last element begun one level up, ``ordinal`` the place
  among its children of the same name: the path of such labels from the root
  is the element's Dewey label, against which ``matched`` tests selectors;
* ``containing`` is the structural join: what lies in which of the intervals
  of some chosen elements, also where these are nested in each other.  A row
  is paired only with the intervals that do contain it.

The rows of a page meet by one shuffle, of the tokens by page; every window and
grouping after it has that partitioning, and nothing is joined back, so the
tokens are made once.  There are so many partitions that each has ``IN_TASK`` of
markup, whatever the size of the table: some 15 windows sort a task's tokens, and
shuffle files, by whose size Spark would deal them, are many times smaller.
The markup is read once more for that, when ``tokens`` is called.  A page is read
by one task whatever its length, as its markup is in one row before.  The page number is not the key: a row of the
input is, so repeated ids never mix.

Defined results: NULL markup has one token without text; void elements contain
nothing; the content of ``script`` and ``style`` and comments is no text.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.html import decode_references

# HTML's void elements, elements that show no text, and elements
# that start a line.
VOID = tuple("area base br col embed hr img input link meta param source track wbr".split())
INVISIBLE = tuple("script style template noscript head title".split())
BLOCKS = tuple("p div li tr section article h1 h2 h3 h4 h5 h6 ul ol table header footer nav main".split())
# Start tags that end an open paragraph.
ENDS_P = tuple("address article aside blockquote details div dl fieldset figcaption figure footer form "
               "h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
# Start tags of siblings that end an element without an end tag.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th", "tr"),
            "th": ("td", "th", "tr"), "tr": ("tr",), "option": ("option", "optgroup"), "p": ENDS_P}
# Inline elements; without an end tag they end where a block begins.
INLINE = tuple("a abbr b bdi bdo big cite code dfn em font i kbd label mark q s samp small span strike strong "
               "sub sup tt u var".split())

_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_RAW = r"<(?:script|style)\b[^>]*+>.*?(?:</(?:script|style)[^>]*+>|\z)"
_TAG = r"""</?[a-z][^>=]*+(?:=(?:\s*+"[^"]*+"|\s*+'[^']*+')?+[^>=]*+)*+>"""
_MARK = f"(?:{_COMMENT}|{_RAW}|<[!?][^>]*+>|</?[^a-z>][^>]*+>|{_TAG})"
_TEXT = r"[^<]*+(?:<(?![a-z/!?])[^<]*+)*+"
_TOKEN = f"(?is){_MARK}{_TEXT}"
_ATTRIBUTE = r"""(?s)\s([^\s=/>"']+)(?:\s*=\s*("[^"]*+"|'[^']*+'|[^\s>]*+))?"""
_HIDDEN_STYLE = r"(?i)display\s*:\s*none|visibility\s*:\s*hidden"
# bytes of markup in a task, a tag counted as so many more
IN_TASK, A_TAG = 12 << 20, 45
# characters that separate the parts of a label never stand inside one
_APART, _HELD = "/#.[]{}", "" * 7


def _attribute(names: Column, values: Column, name: str) -> Column:
    """Value of a start tag's first attribute of that name, else NULL."""
    at = F.array_position(names, name)
    quoted = F.get(values, (at - 1).cast("int"))
    return F.when(at > 0, F.regexp_replace(quoted, r"""(?s)^(["'])(.*)\1$""", "$2"))


def _tasks(df: DataFrame, html_col: str) -> int:
    """How many tasks the markup is dealt to, not fewer than there are cores."""
    size = F.octet_length(html_col).cast("long") + A_TAG * F.regexp_count(html_col, F.lit("<"))
    total = df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return max(-(-total // IN_TASK), df.sparkSession.sparkContext.defaultParallelism)


def tokens(df: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",),
           attrs: Sequence[str] = ()) -> DataFrame:
    """One row per token: ``_row`` (of the input), ``keep`` columns, ``pos``,
    ``kind`` (open, void, close, other), ``tag``, ``ident``, ``classes`` (as
    ``.a.b.``), ``hidden``, ``text`` behind the tag, and a column ``@name`` for
    every one of ``attrs``."""
    html = F.concat(F.lit("<!---->"), F.coalesce(F.col(html_col), F.lit("")))
    cut = (df.select(F.monotonically_increasing_id().alias("_row"), *keep, html.alias("token"))
           .select("_row", *keep, F.posexplode(F.regexp_extract_all("token", F.lit(_TOKEN), F.lit(0))).alias("pos", "token"))
           .withColumn("mark", F.regexp_extract("token", f"(?is)^{_MARK}", 0))
           .withColumn("text", decode_references(F.substr("token", F.length("mark") + 1)))
           .withColumn("tag", F.lower(F.regexp_extract("mark", r"^</?([a-zA-Z][^\s/>]*)", 1)))
           .withColumn("kind", F.when(F.startswith("mark", F.lit("</")), F.when(F.col("tag") == "", "other").otherwise("close"))
                       .when(F.col("tag").isin("", "script", "style"), "other")
                       .when(F.col("tag").isin(*VOID) | F.endswith("mark", F.lit("/>")), "void").otherwise("open")))
    start = F.col("kind").isin("open", "void") & F.col("mark").rlike(r"\s")
    none = F.array().cast("array<string>")
    names = F.when(start, F.transform(F.regexp_extract_all("mark", F.lit(_ATTRIBUTE), F.lit(1)), F.lower)).otherwise(none)
    values = F.when(start, F.transform(F.regexp_extract_all("mark", F.lit(_ATTRIBUTE), F.lit(2)),
                                       decode_references)).otherwise(none)
    listed = F.regexp_replace(F.translate(F.coalesce("@class", F.lit("")), _APART, _HELD), r"\s+", ".")
    return (cut.withColumn("_names", names).withColumn("_values", values)
            .withColumns({f"@{n}": _attribute(F.col("_names"), F.col("_values"), n)
                          for n in dict.fromkeys(("id", "class", "style", *attrs))})
            .select("_row", *keep, "pos", "kind", "tag",
                    F.translate(F.coalesce("@id", F.lit("")), _APART, _HELD).alias("ident"),
                    F.concat(F.lit("."), F.btrim(listed, F.lit(".")), F.lit(".")).alias("classes"),
                    (F.col("tag").isin(*INVISIBLE) | F.array_contains("_names", "hidden")
                     | F.coalesce(F.col("@style").rlike(_HIDDEN_STYLE), F.lit(False))).alias("hidden"),
                    "text", *[f"@{n}" for n in attrs])
            .repartition(_tasks(df, html_col), "_row"))


def _running(*partition: str, order: Sequence[str] = ("pos",)):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def elements(rows: DataFrame) -> DataFrame:
    """``tokens`` with, for start tags, ``depth`` (the root's is 1), ``end``
    (the first token behind the element), ``parent`` (its position), ``ordinal``
    and ``label``; NULL for other tokens.  ``text`` of hidden elements is empty."""
    opened, closed = F.col("kind") == "open", F.col("kind") == "close"
    by_tag = _running("_row", "tag")
    # depth of one name, never below zero; a start and an end tag at one depth are a pair
    sums = F.sum(F.when(opened, 1).when(closed, -1).otherwise(0)).over(by_tag)
    paired = (rows.withColumn("_sum", sums)
              .withColumn("_level", F.col("_sum") - F.least(F.lit(0), F.min("_sum").over(by_tag)))
              .withColumn("_pair", F.when(opened, F.col("_level")).when(
                  closed, F.lag("_level", 1, 0).over(Window.partitionBy("_row", "tag").orderBy("pos"))).otherwise(0)))
    follows = F.lead("kind").over(Window.partitionBy("_row", "tag", "_pair").orderBy("pos"))
    paired = paired.withColumn("_matched", F.col("_pair").cast("boolean") & (
        closed | F.coalesce(follows == "close", F.lit(False))))

    # where elements without an end tag end: among the tokens at their parent's level
    matched = F.col("_matched")
    step = F.when(matched & opened, 1).when(matched & closed, -1).otherwise(0)
    inner = (paired.withColumn("_inside", F.sum(step).over(_running("_row")))
             .withColumn("_at_level", F.when(matched & closed, F.col("_inside") + 1).when(
                 matched & opened, F.col("_inside") - 1).when(
                 F.col("kind").isin("open", "void"), F.col("_inside")).otherwise(-1)))
    behind = (Window.partitionBy("_row", "_at_level").orderBy(F.desc("pos"))
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = F.col("kind").isin("open", "void")

    def nearest(tags: Sequence[str]) -> Column:
        stops = (matched & closed) | (starts & F.col("tag").isin(*tags)) if tags else matched & closed
        return F.last(F.when(stops, F.col("pos")), True).over(behind)

    rules: dict[tuple[str, ...], list[str]] = {}
    for tag, by in ENDED_BY.items():
        rules.setdefault(by, []).append(tag)
    rules[ENDS_P] += INLINE
    ends = None
    for by, tags in rules.items():
        here = F.col("tag").isin(*tags)
        ends = F.when(here, nearest(by)) if ends is None else ends.when(here, nearest(by))
    n = F.count(F.lit(1)).over(Window.partitionBy("_row"))
    left_open = inner.withColumn("_end", F.when(opened & ~matched, F.coalesce(ends.otherwise(nearest(())), n)))

    # all starts and ends in order; ends that no tag marks come before the tag that causes them
    own = F.struct(F.col("pos").alias("at"), F.lit(1).alias("rank"))
    implied = F.struct(F.col("_end").cast("int").alias("at"), F.lit(0).alias("rank"))
    events = (left_open.withColumn("_event", F.explode(F.when(
        F.col("_end").isNotNull(), F.array(own, implied)).otherwise(F.array(own))))
        .withColumn("_at", F.col("_event.at")).withColumn("_rank", F.col("_event.rank")))
    real = F.col("_rank") == 1
    begins, finishes = real & opened, ~real | (closed & matched)
    order = ("_at", "_rank", "pos")
    depth = F.sum(F.when(begins, 1).when(finishes, -1).otherwise(0)).over(_running("_row", order=order))
    # each element once on its own level, once as the parent of the level below
    level = (F.when(begins, F.col("_depth")).when(finishes | (F.col("kind") == "void"), F.col("_depth") + 1)
             .otherwise(F.lit(-1)))
    levels = (events.withColumn("_depth", depth).withColumn("_own", level)
              .withColumn("_lv", F.explode(F.when(begins, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own")))))
    as_parent = F.col("_lv") != F.col("_own")
    on_level = Window.partitionBy("_row", "_lv").orderBy(*order)
    nested = (levels.withColumn("parent", F.when(starts, F.last(F.when(as_parent, F.col("pos")), True).over(
        _running("_row", "_lv", order=order))))
        .withColumn("end", F.when(begins, F.coalesce(F.lead("_at").over(on_level), n)).when(
            F.col("kind") == "void", F.col("pos")))
        .where(real & ~as_parent)
        .withColumn("depth", F.when(starts, F.col("_own"))))
    ordinal = F.row_number().over(Window.partitionBy("_row", "parent", "depth", "tag").orderBy("pos"))
    muted = F.max(F.when(F.col("hidden"), F.col("end"))).over(_running("_row")) > F.col("pos")
    attrs = [c for c in rows.columns if c.startswith("@")]
    label = F.concat(F.lit("/"), F.translate("tag", _APART, _HELD), F.lit("["), F.col("ordinal").cast("string"),
                     F.lit("]#"), F.col("ident"), F.lit("#"), F.col("classes"),
                     *[F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(
                         F.lit("{" + c[1:] + "="), F.hex(F.encode(c, "UTF-8")), F.lit("}"))) for c in attrs])
    return (nested.withColumn("ordinal", F.when(starts, ordinal)).withColumn("label", F.when(starts, label))
            .withColumn("text", F.when(F.coalesce(muted, F.lit(False)), F.lit("")).otherwise(F.col("text")))
            .select(*rows.columns, "depth", "end", "parent", "ordinal", "label"))


def containing(rows: DataFrame, outer: Column, inner: Column, about: Sequence[str] = (),
               rest: bool = False) -> DataFrame:
    """The structural join: every row that ``inner`` marks, once for each of the
    elements marked by ``outer`` that it lies in or that it starts, with that
    element's position ``outer``, its ``level`` among the ones around the row,
    and its columns ``about`` as ``outer_…``.  With ``rest`` all other rows are
    kept as well, once each, these columns NULL."""
    outer, inner = F.coalesce(outer, F.lit(False)), F.coalesce(inner, F.lit(False))
    here = F.struct(F.col("pos").alias("at"), F.lit(1).alias("rank"))
    over = F.struct(F.col("end").cast("int").alias("at"), F.lit(0).alias("rank"))
    holds = F.col("_outer") & (F.col("end") > F.col("pos"))  # void elements hold nothing, not even themselves
    events = (rows.withColumn("_outer", outer).withColumn("_inner", inner).where("_outer OR _inner" if not rest else "true")
              .withColumn("_event", F.explode(F.when(holds, F.array(here, over)).otherwise(F.array(here))))
              .withColumn("_at", F.col("_event.at")).withColumn("_rank", F.col("_event.rank")))
    begins = (F.col("_rank") == 1) & holds
    depth = F.sum(F.when(F.col("_rank") == 0, -1).when(begins, 1).otherwise(0)).over(
        _running("_row", order=("_at", "_rank", "pos")))
    levels = (events.withColumn("_open", depth).where("_rank = 1")
              .withColumn("_found", F.col("_inner") & (F.col("_open") > 0))
              .withColumn("level", F.explode(F.when(F.col("_found"), F.sequence(F.lit(1).cast("bigint"), "_open"))
                                             .otherwise(F.array("_open")))))
    provides = holds & (F.col("level") == F.col("_open"))
    element = F.last(F.when(provides, F.struct("pos", *about)), True).over(_running("_row", "level"))
    return (levels.withColumn("_element", element).withColumn("_element", F.when(F.col("_found"), F.col("_element")))
            .withColumn("level", F.when(F.col("_found"), F.col("level"))).where("_found" if not rest else "true")
            .withColumns({"outer": F.col("_element.pos"), **{f"outer_{c}": F.col("_element")[c] for c in about}})
            .drop("_outer", "_inner", "_event", "_at", "_rank", "_open", "_element", "_found"))


def regrouped(parts: DataFrame, columns: Sequence[str], **aggs: Column) -> DataFrame:
    """Rows that ``containing`` repeated, once again each, with ``aggs`` over
    their repetitions beside their ``columns``."""
    row = F.first(F.struct(*[c for c in columns if c not in ("_row", "pos")])).alias("_same")
    named = [a.alias(name) for name, a in aggs.items()]
    return parts.groupBy("_row", "pos").agg(row, *named).select("_row", "pos", "_same.*", *aggs)


# ---- selectors as patterns of labels ---------------------------------------


def _step_pattern(step) -> str:
    """A compound selector as a pattern of one label, without its slash."""
    name = re.escape(step.tag) if step.tag else r"[^/\[]*+"
    place = str(step.nth) if step.nth else r"\d++"
    ident = re.escape(step.id) if step.id is not None else "[^/#]*+"
    tests = "".join(rf"(?=[^/{{]*\.{re.escape(c)}\.)" for c in sorted(step.classes))
    for key, value in step.attrs:
        stored = "" if value is None else value.encode().hex().upper() + r"\}"
        tests += rf"(?=[^/]*\{{{re.escape(key)}={stored})"
    return rf"{name}\[{place}\]#{ident}#{tests}[^/]*+"


def label_pattern(path) -> tuple[str, str]:
    """Patterns of a ``parsed.Path``: of the element's own label, and of its
    labels from the root on."""
    steps = [_step_pattern(s) for s in path.steps]
    whole = steps[0]
    for deep, step in zip(path.deep, steps[1:]):
        whole += ("/(?:.*/)?" if deep else "/") + step
    return rf"(?s)^/{steps[-1]}$", rf"(?s)^.*/{whole}$"


def selector_attributes(paths) -> list[str]:
    """Attributes that selectors ask for, besides id and class."""
    return sorted({key for p in paths for s in p.steps for key, _ in s.attrs})


def matched(rows: DataFrame, paths: Mapping[str, object]) -> DataFrame:
    """``elements`` with a boolean column for every name of ``paths`` (values
    are ``parsed.Path``): does the selector pick this element?  Dewey labels are
    made only for elements whose own label fits a selector of several steps."""
    patterns = {name: label_pattern(p) for name, p in paths.items()}
    many = [name for name, p in paths.items() if not p.single]
    own = {name: F.coalesce(F.col("label").rlike(patterns[name][0]), F.lit(False)) for name in paths}
    if many:
        fits = own[many[0]]
        for name in many[1:]:
            fits = fits | own[name]
        parts = containing(rows, F.col("label").isNotNull(), fits, about=["label"], rest=True)
        above = F.array_sort(F.collect_list(F.when(F.col("outer").isNotNull(), F.struct("outer", "outer_label"))))
        line = F.array_join(F.transform("_line", lambda x: x["outer_label"]), "")
        rows = (regrouped(parts, rows.columns, _line=above)
                .withColumn("_line", F.when(F.size("_line") > 0, F.when(F.col("end") > F.col("pos"), line)
                                            .otherwise(F.concat(line, F.col("label")))).otherwise(F.col("label"))))
        own |= {name: own[name] & F.coalesce(F.col("_line").rlike(patterns[name][1]), F.lit(False)) for name in many}
    return rows.withColumns(own).drop("_line")


def piece() -> Column:
    """What a token adds to the text around it: a line break for a block's tag
    or ``br``, and the text behind the tag."""
    breaks = (F.col("tag") == "br") | (F.col("tag").isin(*BLOCKS) & F.col("kind").isin("open", "close"))
    return F.concat(F.when(breaks, F.lit("\n")).otherwise(F.lit("")), F.col("text"))


def folded(raw: Column) -> Column:
    """Runs of spaces as one, lines trimmed, empty lines dropped."""
    spaces = F.regexp_replace(raw, "[ \t\r\f\u000b ]+", " ")
    return F.btrim(F.regexp_replace(spaces, " ?\n[ \n]*", "\n"), F.lit(" \n"))


def texts(rows: DataFrame, outer: Column, carry: Sequence[str] = (), skip: Column | None = None) -> DataFrame:
    """Visible text of every element that ``outer`` marks: one row each with
    ``_row``, ``pos``, its ``carry`` columns and ``text``.  Rows that ``skip``
    marks (a condition on the row and the element's ``outer_…``) add nothing."""
    parts = containing(rows, outer, (piece() != "") | outer, about=carry)
    said = piece() if skip is None else F.when(F.coalesce(skip, F.lit(False)), F.lit("")).otherwise(piece())
    return (parts.groupBy("_row", "outer", *[f"outer_{c}" for c in carry])
            .agg(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))).alias("said"))
            .select("_row", F.col("outer").alias("pos"), *[F.col(f"outer_{c}").alias(c) for c in carry],
                    folded(F.array_join(F.transform("said", lambda x: x["said"]), "")).alias("text")))
