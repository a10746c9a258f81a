"""Default selector rules for the hotel-price result page.

Rules are data: when the site changes, pass new ``ParsedLayout`` values
instead of changing code.  The "not available" element and the second
"contact" element have no class of their own, and sellers of other lists have
the same class as those of the price list; they are found by their place below
the price container (``>`` child, ``:nth(n)`` n-th child of its tag).
"""

from __future__ import annotations

import dataclasses

from ratelens.operators.extract import NativeLayout, ParsedLayout, Test
from ratelens.operators.parsed import classes

# Class names and ids of the result page.
PRICE_CONTAINER = "#prices"
SELLER = ".NiGhzc"
PRICE = ".pNExyb"
LISTING = ".PVOOXe"
CONTACT = classes("MEVoGd AdWm1c")
FEE_BLOCK_AVERAGE = "span.MW1oTb"
FEE_BLOCK_TOTAL = "span.UeIHqb"

# Places of the flag elements below the price container.
_SECTION = (f"{PRICE_CONTAINER} > c-wiz%s > c-wiz > div > div > div > div > div > div > div > section"
            " > div:nth(2) > c-wiz")
NOT_AVAILABLE_PLACES = (_SECTION % "" + " > c-wiz > div:nth(1) > div > div",
                        _SECTION % ":nth(1)" + " > c-wiz > div:nth(1)")
CONTACT_PLACE = _SECTION % ":nth(1)" + " > div:nth(1) > div:nth(1) > div:nth(1)"
# Fixed value: place of the seller list below the price container.
PRICE_LIST_PLACE = _SECTION % "" + " > div > div > div:nth(2)"
SEARCHED_OUT_PLACE = "#dwrFZd0 > div > div:nth(2) > div:nth(1)"
SEARCHED_IN_PLACE = "#dwrFZd0 > div > div:nth(1) > div:nth(1)"
LISTING_BLOCK = "div.ADs2Tc"
LISTING_FEES = "div.Einivf.qOlGCc"

DETAIL_PAGE = ParsedLayout(
    layout=1, names=SELLER, prices=PRICE, scope=PRICE_CONTAINER,
    present=(PRICE_CONTAINER,), not_available=NOT_AVAILABLE_PLACES,
    contact=(CONTACT, CONTACT_PLACE), listing=(LISTING,),
    searched_in=SEARCHED_IN_PLACE, searched_out=SEARCHED_OUT_PLACE, block=SELLER,
    block_fields=(("average_price", FEE_BLOCK_AVERAGE), ("total_price", FEE_BLOCK_TOTAL)),
)

LISTING_PAGE = ParsedLayout(
    layout=2, names=SELLER, prices=PRICE, present=(LISTING,),
    not_available=NOT_AVAILABLE_PLACES, contact=(CONTACT, CONTACT_PLACE),
    searched_in=SEARCHED_IN_PLACE, searched_out=SEARCHED_OUT_PLACE,
    listing=(LISTING,), block=LISTING_BLOCK,
    block_fields=(("average_price", f"{LISTING_FEES} >> {FEE_BLOCK_AVERAGE}"),
                  ("total_price", f"{LISTING_FEES} >> {FEE_BLOCK_TOTAL}")),
)

# Sellers and prices of the list at its known place, on either page; where the
# page has no element there, the rules above read its whole container.
LISTED_PRICES = dataclasses.replace(DETAIL_PAGE, layout=0, scope=PRICE_LIST_PLACE, present=(PRICE_LIST_PLACE,))

DEFAULT_LAYOUTS = (DETAIL_PAGE, LISTING_PAGE, LISTED_PRICES)  # tried in the order of ``layout``


# ---- rules as files -------------------------------------------------------

def dump_layouts(layouts) -> str:
    """JSON text of a rule set (``ParsedLayout`` or ``NativeLayout`` values)."""
    import json

    out = []
    for lay in layouts:
        d = dataclasses.asdict(lay)
        d["engine"] = "native" if isinstance(lay, NativeLayout) else "parsed"
        out.append(d)
    return json.dumps(out, indent=2, ensure_ascii=False)


def load_layouts(source: str):
    """Rule set from JSON text or a JSON file path; the inverse of
    :func:`dump_layouts`.  Missing keys take the defaults."""
    import json
    import os

    text = open(source, encoding="utf-8").read() if os.path.exists(source) else source
    layouts = []
    for d in json.loads(text):
        d = dict(d)
        engine = d.pop("engine", "parsed")
        if engine == "native":
            for k in ("present", "not_available", "contact", "listing"):
                d[k] = tuple(Test(**t) if isinstance(t, dict) else Test(t) for t in d.get(k, ()))
            if d.get("scope") is not None:
                d["scope"] = tuple(d["scope"])
            layouts.append(NativeLayout(**d))
        elif engine == "parsed":
            for k in ("present", "not_available", "contact", "listing"):
                d[k] = tuple(d.get(k, ()))
            d["block_fields"] = tuple(tuple(x) for x in d.get("block_fields", ()))
            layouts.append(ParsedLayout(**d))
        else:
            raise ValueError(f"unknown rule engine: {engine}")
    return tuple(layouts)
