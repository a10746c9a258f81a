"""Selector rules run on element intervals: sellers, prices, flags and block
fields of captured pages, without Python on the row path.

``extract_elements`` gives ``ParsedLayout`` rules their ``page`` struct;
``scoped_texts``, ``place_flags``, ``block_fields`` and ``rule_winners`` are its
parts on their own, for other pages and rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.operators.elements import (
    containing,
    elements,
    folded,
    matched,
    piece,
    regrouped,
    selector_attributes,
    texts,
    tokens,
)
from ratelens.operators.extract import ParsedLayout
from ratelens.operators.parsed import Path


def _so_far(last: int = 0):
    """A page's tokens up to the present one, or to the one before (-1)."""
    return Window.partitionBy("_row").orderBy("pos").rowsBetween(Window.unboundedPreceding, last)


def _marked(df: DataFrame, selectors: Mapping[str, str], html_col: str, keep: Sequence[str],
            attrs: Sequence[str] = ()) -> DataFrame:
    """Elements of every page with a boolean column per selector."""
    paths = {name: Path(text) for name, text in selectors.items()}
    wanted = sorted({*selector_attributes(paths.values()), *attrs})
    return matched(elements(tokens(df, html_col, keep, wanted)), paths)


def _inside(mark: Column) -> Column:
    """Does the row lie in an element that ``mark`` picks (or start one)?"""
    return F.coalesce(F.max(F.when(mark, F.col("end"))).over(_so_far()) > F.col("pos"), F.lit(False))


def _inside_first(mark: Column) -> Column:
    """Does the row lie in the page's first element that ``mark`` picks?"""
    first = F.min(F.when(mark, F.struct("pos", "end"))).over(Window.partitionBy("_row"))
    return F.coalesce((F.col("pos") >= first["pos"]) & (F.col("pos") < first["end"]), F.lit(False))


def _outermost(mark: Column) -> Column:
    """Of the elements that ``mark`` picks those in no other one."""
    return mark & F.coalesce(F.max(F.when(mark, F.col("end"))).over(_so_far(-1)) <= F.col("pos"), F.lit(True))


def scoped_texts(df: DataFrame, scope: str, items: str, html_col: str = "html",
                 keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Visible text of the elements ``items`` inside the page's first element
    ``scope``: ``keep``, ``pos`` (from 1) and ``text``, blank ones left out."""
    rows = _marked(df, {"scope": scope, "item": items}, html_col, keep)
    rows = rows.withColumn("item", F.col("item") & _inside_first(F.col("scope")))
    found = texts(rows, F.col("item"), carry=keep).where("text <> ''")
    number = F.row_number().over(Window.partitionBy("_row").orderBy("pos"))
    return found.withColumn("pos", number).select(*keep, "pos", "text")


def place_flags(df: DataFrame, flags: Mapping[str, Sequence[str]], html_col: str = "html",
                keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Per page a boolean for every flag: does any of its selectors pick an
    element?  Selectors may be places (``#prices > div:nth(2) > span``)."""
    named = {f"{i}_{j}": s for i, ss in enumerate(flags.values()) for j, s in enumerate(ss)}
    rows = _marked(df, named, html_col, keep)
    return rows.groupBy("_row", *keep).agg(*[
        F.greatest(F.lit(False), F.lit(False), *[F.max(f"{i}_{j}") for j in range(len(ss))]).alias(name)
        for i, (name, ss) in enumerate(flags.items())]).drop("_row")


def block_fields(df: DataFrame, block: str, fields: Mapping[str, str], html_col: str = "html",
                 keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row per element ``block``: its number on the page (from 1) and a
    column per field, the text of the first element in the block that the
    field's selector picks; NULL where there is none or it is blank.  A field in
    nested blocks belongs to the nearest one."""
    rows = _marked(df, {"_block": block, **{f"_f_{k}": s for k, s in fields.items()}}, html_col, keep)
    names = [f"_f_{k}" for k in fields]
    some = F.greatest(F.lit(False), F.lit(False), *[F.col(n) for n in names])
    # the nearest block around every element; a block stands in its own
    around = containing(rows, F.col("_block"), some | F.col("_block"), rest=True)
    rows = regrouped(around, rows.columns, _home=F.max("outer"))
    parts = containing(rows, some, (piece() != "") | some, about=["_home", *names], rest=True)
    items = (_gathered(parts, [*keep], ["_home", *names], {"_blocks": F.collect_set(F.when(F.col("_block"), F.col("pos")))})
             .withColumn("_blocks", F.array_sort(F.array_distinct(F.flatten("_blocks")))))

    def field(name: str) -> Column:
        mine = F.filter("_items", lambda x: (x["_home"] == F.col("_from")) & x[name])
        return F.nullif(F.get(mine, F.lit(0))["text"], F.lit(""))

    return (items.select(*keep, "_items", F.posexplode("_blocks").alias("_n", "_from"))
            .select(*keep, (F.col("_n") + 1).cast("int").alias("block"), *[field(f"_f_{k}").alias(k) for k in fields]))


def _gathered(parts: DataFrame, keep: Sequence[str], about: Sequence[str], flags: Mapping[str, Column],
              skip: Column | None = None) -> DataFrame:
    """One row per page from ``containing`` with ``rest``: ``_items``, the texts of
    the outer elements in order (pos, text, ``about``), and the ``flags``, each a
    list of its values per element."""
    said = piece() if skip is None else F.when(F.coalesce(skip, F.lit(False)), F.lit("")).otherwise(piece())
    element = [F.col(f"outer_{c}").alias(c) for c in about]
    one = (parts.groupBy("_row", *keep, "outer", *[f"outer_{c}" for c in about])
           .agg(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))).alias("_said"),
                *[c.alias(name) for name, c in flags.items()]))
    text = folded(F.array_join(F.transform("_said", lambda x: x["said"]), ""))
    item = F.when(F.col("outer").isNotNull(), F.struct(F.col("outer").alias("pos"), text.alias("text"), *element))
    return one.groupBy("_row", *keep).agg(F.array_sort(F.collect_list(item)).alias("_items"),
                                          *[F.collect_list(name).alias(name) for name in flags])


def rule_winners(df: DataFrame, rules: DataFrame, html_col: str = "html",
                 keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rules as a table: ``rules(field, kind, key, priority)`` with kind ``tag``,
    ``class`` or ``id``.  Per page and field the rule with the lowest priority
    that picks any element, the number it picks and the first one's text:
    ``keep``, ``field``, ``priority``, ``kind``, ``key``, ``n_elements``,
    ``first_text``.  New rules are new rows; ties go to the smaller (kind, key)."""
    rows = elements(tokens(df, html_col, keep))
    names = F.filter(F.split(F.btrim("classes", F.lit(".")), r"\."), lambda c: c != "")
    facts = F.concat(F.array(F.struct(F.lit("tag").alias("kind"), F.col("tag").alias("key"))),
                     F.when(F.col("ident") != "", F.array(F.struct(F.lit("id").alias("kind"), F.col("ident").alias("key"))))
                     .otherwise(F.array().cast("array<struct<kind:string,key:string>>")),
                     F.transform(F.array_distinct(names), lambda c: F.struct(F.lit("class").alias("kind"), c.alias("key"))))
    wanted = rules.select(F.col("field").alias("_field"), "kind", "key", "priority").where(
        "_field IS NOT NULL AND priority IS NOT NULL").distinct()
    columns = rows.columns
    facts = F.when(F.col("label").isNotNull(), facts)
    ruled = regrouped(rows.withColumn("f", F.explode_outer(facts)).withColumns({"_kind": F.col("f.kind"), "key": F.col("f.key")})
                      .join(wanted.withColumnRenamed("kind", "_kind"), ["_kind", "key"], "left"), columns,
                      _rules=F.collect_set(F.when(F.col("_field").isNotNull(), F.struct(
                          "_field", "priority", F.col("_kind").alias("kind"), "key"))))
    some = F.size("_rules") > 0
    parts = (containing(ruled, some, (piece() != "") | some, about=["_rules"], rest=True)
             # a void element is its own, without text
             .withColumn("_void", F.col("outer").isNull() & some)
             .withColumn("_of", F.when(F.col("_void"), F.col("pos")).otherwise(F.col("outer")))
             .withColumn("outer__rules", F.when(F.col("_void"), F.col("_rules")).otherwise(F.col("outer__rules")))
             .where("_of IS NOT NULL"))
    said = F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("_void"), F.lit("")).otherwise(piece()).alias("said"))))
    found = (parts.groupBy("_row", *keep, "_of", "outer__rules").agg(said.alias("said"))
             .select("_row", *keep, F.col("_of").alias("pos"), F.explode("outer__rules").alias("rule"),
                     folded(F.array_join(F.transform("said", lambda x: x["said"]), "")).alias("text"))
             .select("_row", *keep, "pos", "rule.*", "text"))
    return (found.groupBy("_row", *keep, "_field", "priority", "kind", "key")
            .agg(F.count(F.lit(1)).alias("n_elements"), F.min_by("text", "pos").alias("first_text"))
            .groupBy("_row", *keep, "_field")
            .agg(F.min(F.struct("priority", "kind", "key", "n_elements", "first_text")).alias("w"))
            .select(*keep, F.col("_field").alias("field"), "w.*"))


# ---- whole layouts ----------------------------------------------------------


def _layout_selectors(i: int, lay: ParsedLayout) -> dict[str, str]:
    """Column name -> selector of all rules of a layout."""
    one = {"names": lay.names, "prices": lay.prices, "scope": lay.scope, "in": lay.searched_in,
           "out": lay.searched_out, "block": lay.block}
    many = {"present": lay.present, "na": lay.not_available, "contact": lay.contact, "listing": lay.listing}
    out = {f"_{i}_{k}": s for k, s in one.items() if s}
    out |= {f"_{i}_{k}_{j}": s for k, ss in many.items() for j, s in enumerate(ss)}
    return out | {f"_{i}_field_{j}": s for j, (_, s) in enumerate(lay.block_fields) if lay.block}


def _any_of(names: Sequence[str], prefix: str) -> Column:
    hits = [F.col(n) for n in names if n.startswith(prefix)]
    return F.greatest(F.lit(False), F.lit(False), *hits)


def _first_text(items: Column, mark: str) -> Column:
    return F.get(F.filter(items, lambda x: x[mark]), F.lit(0))["text"]


def _page_struct(i: int, lay: ParsedLayout, items: Column, blocks: Column) -> Column:
    """The ``page`` struct of one layout, from a page's texts in order."""
    pick = lambda mark: F.filter(items, lambda x: x[mark])
    said = lambda a: F.transform(a, lambda x: x["text"])
    fold = lambda x: F.replace(x, F.lit("\n"), F.lit(" "))
    full = lambda a: F.filter(a, lambda x: x["text"] != "")
    all_names, all_prices = pick(f"_{i}_names"), pick(f"_{i}_prices")
    names, prices = F.transform(said(full(all_names)), fold), said(full(all_prices))
    extras = F.lit(None).cast("array<map<string,string>>")
    if lay.block:
        in_block = lambda at: F.filter(items, lambda x: x[f"_{i}_at"] == at)

        def fields(at: Column) -> Column:
            parts = [v for j, (k, _) in enumerate(lay.block_fields)
                     for v in (F.lit(k), _first_text(in_block(at), f"_{i}_field_{j}"))]
            return F.create_map(*parts) if parts else F.create_map().cast("map<string,string>")

        every = F.transform(blocks, fields)
        aligned = F.size(all_names) == F.size(blocks)
        pairs = F.transform(all_names, lambda n, k: F.struct(
            n["text"].alias("text"), F.get(blocks, k).alias("at"), fields(F.get(blocks, k)).alias("fields")))
        pairs = full(pairs)
        if lay.block == lay.names:
            extras = F.when(aligned, F.transform(pairs, lambda p: p["fields"])).otherwise(every)
        else:
            # every seller's block holds its price: paired there, blank or not
            price_at = F.filter(F.transform(all_prices, lambda p: p[f"_{i}_at"]), lambda at: at.isNotNull())
            paired = aligned & (F.size(price_at) == F.size(blocks)) & (F.size(F.array_distinct(price_at)) == F.size(blocks))
            own = F.transform(pairs, lambda p: F.nullif(
                F.get(F.filter(all_prices, lambda x: x[f"_{i}_at"] == p["at"]), F.lit(0))["text"], F.lit("")))
            prices = F.when(paired, own).otherwise(prices)
            extras = F.when(paired, F.transform(pairs, lambda p: p["fields"])).otherwise(every)
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(lay.layout).alias("layout"), names.alias("names"), prices.alias("prices"),
        F.col(f"_{i}_is_na").alias("not_available"), F.col(f"_{i}_is_contact").alias("contact"),
        F.col(f"_{i}_is_listing").alias("is_listing"),
        (_first_text(items, f"_{i}_in") if lay.searched_in else none).alias("searched_in"),
        (_first_text(items, f"_{i}_out") if lay.searched_out else none).alias("searched_out"),
        extras.alias("extras"), F.col("_labels").alias("labels"))


def extract_elements(df: DataFrame, layouts: Sequence[ParsedLayout], keep: Sequence[str],
                     html_col: str = "html", out: str = "page", keep_labels: bool = False) -> DataFrame:
    """``keep`` columns of every row of ``df`` and the ``page`` struct of its
    markup by ``ParsedLayout`` rules: the first layout that is present; NULL if
    none is, or without markup.  ``labels`` holds the ``aria-label`` of every
    ``div`` when asked for."""
    layouts = sorted(layouts, key=lambda x: x.layout)
    selectors = {k: s for i, lay in enumerate(layouts) for k, s in _layout_selectors(i, lay).items()}
    source = df.select(*keep, F.col(html_col), F.col(html_col).isNotNull().alias("_has"))
    rows = _marked(source, selectors, html_col, [*keep, "_has"], ["aria-label"] if keep_labels else [])
    opened = F.col("kind") == "open"
    shown, carry, flags, blocks = F.lit(False), [], {}, {}
    for i, lay in enumerate(layouts):
        mine = [k for k in selectors if k.startswith(f"_{i}_")]
        inside = _inside_first(F.col(f"_{i}_scope") & opened) if lay.scope else F.lit(True)
        marks = {k: F.col(k) & opened & (inside if k[len(f"_{i}_"):] in ("names", "prices", "block") else F.lit(True))
                 for k in mine if k.split("_")[2] in ("names", "prices", "in", "out", "block", "field")}
        rows = rows.withColumns(marks)
        field = F.lit(False)
        if lay.block:
            rows = rows.withColumn(f"_{i}_block", _outermost(F.col(f"_{i}_block")))
            last = F.last(F.when(F.col(f"_{i}_block"), F.struct("pos", "end")), True).over(_so_far())
            rows = rows.withColumn("_last", last).withColumn(
                f"_{i}_at", F.when(F.col("_last.end") > F.col("pos"), F.col("_last.pos"))).drop("_last")
            fields = [k for k in mine if "_field_" in k]
            # the block's own element is no field of it
            rows = rows.withColumns({k: F.col(k) & F.coalesce(F.col(f"_{i}_at") < F.col("pos"), F.lit(False)) for k in fields})
            field = F.greatest(F.lit(False), F.lit(False), *[F.col(k) for k in fields])
        else:
            rows = rows.withColumn(f"_{i}_at", F.lit(None).cast("int"))
        rows = rows.withColumn(f"_{i}_field_around", F.max(F.when(field, F.struct("end", "pos"))).over(_so_far()))
        texted = [k for k in mine if k.split("_")[2] in ("names", "prices", "in", "out", "field")]
        shown = shown | F.greatest(F.lit(False), F.lit(False), *[F.col(k) for k in texted])
        carry += [*texted, f"_{i}_at"]
        flags |= {f"_{i}_is_{kind}": _any_of(mine, f"_{i}_{kind}_") for kind in ("present", "na", "contact", "listing")}
        blocks[f"_{i}_blocks"] = F.collect_set(F.when(F.col(f"_{i}_block"), F.col("pos")) if lay.block
                                               else F.lit(None).cast("int"))
    label = F.when((F.col("tag") == "div") & F.col("kind").isin("open", "void"), F.col("@aria-label")) \
        if keep_labels else F.lit(None).cast("string")
    # a seller's name goes on after the block fields in it
    skip = F.lit(False)
    for i in range(len(layouts)):
        around = F.col(f"_{i}_field_around")
        skip = skip | (F.col(f"outer__{i}_names") & (around["end"] > F.col("pos")) & (around["pos"] > F.col("outer")))
    parts = containing(rows, shown, (piece() != "") | shown, about=carry, rest=True)
    some = {name: F.max(c) for name, c in flags.items()}
    labelled = {"_labels": F.collect_set(F.when(label.isNotNull(), F.struct("pos", label.alias("label"))))}
    joined = _gathered(parts, [*keep, "_has"], carry, {**some, **blocks, **labelled}, skip)
    joined = joined.withColumns({name: F.array_max(name) for name in some} | {
        name: F.array_sort(F.array_distinct(F.flatten(name))) for name in blocks} | {
        "_labels": F.array_distinct(F.transform(F.array_sort(F.array_distinct(F.flatten("_labels"))), lambda x: x["label"]))})
    choice = F.lit(None)
    for i, lay in reversed(list(enumerate(layouts))):
        here = F.col("_has") & (F.col(f"_{i}_is_present") if lay.present else F.lit(True))
        choice = F.when(here, _page_struct(i, lay, F.col("_items"), F.col(f"_{i}_blocks"))).otherwise(choice)
    return joined.select(*keep, choice.alias(out))
