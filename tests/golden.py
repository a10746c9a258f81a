"""Hand-written captured pages, one per case, and their rules."""

from ratelens.operators.extract import ParsedLayout
from ratelens.plans.layouts import DETAIL_PAGE, LISTING_PAGE


def seller(text, cls="NiGhzc"):
    return f'<div class="{cls}">{text}</div>'


def price(text):
    return f'<span class="pNExyb">{text}</span>'


def container(inner, extra=""):
    return (f'<html><body><div class="header NiGhzc">Not a seller</div>{extra}'
            f'<div id="prices"><section>{inner}</section></div></body></html>')


NA1 = '<div class="na-one">Not available</div>'
NA2 = '<div class="na-two">No rooms</div>'
CONTACT1 = '<div class="MEVoGd AdWm1c">Contact this property</div>'
CONTACT2 = '<div class="call-property">Call</div>'

TEST_DETAIL = ParsedLayout(**{**DETAIL_PAGE.__dict__,
                              "not_available": (".na-one", ".na-two"),
                              "contact": DETAIL_PAGE.contact + (".call-property",),
                              "searched_in": "div.ci", "searched_out": "div.co"})
TEST_LISTING = ParsedLayout(**{**LISTING_PAGE.__dict__,
                               "not_available": (".na-one", ".na-two")})
LAYOUTS = (TEST_DETAIL, TEST_LISTING)

PAGES = {
    "offers": container(seller("Booking.com") + price("$120") + seller("Expedia") + price("$1,234")
                        + seller("Hotels.com") + price("$99")),
    "blanks": container(seller("A") + price("$1") + seller("") + price("") + seller("B")
                        + price("$2")),
    "same_price": container(seller("A") + price("$99") + seller("B") + price("$99")),
    "newline": container(seller("Boo\nking") + price("$5")),
    "nested": container('<div class="a NiGhzc"><b>H&ocirc;tel</b> &amp; Co</div>' + price("$7")),
    "too_few_prices": container(seller("A") + price("$1") + seller("B") + price("$2")
                                + seller("C")),
    "extra_prices": container(seller("A") + price("$1") + seller("B") + price("$2")
                              + price("$3")),
    "no_agents": container("<p>No sellers listed</p>"),
    "na_rule1": container(NA1),
    "na_rule2": container(NA2),
    "contact_rule1": container(CONTACT1),
    "contact_rule2": container(CONTACT2),
    "both_flags": container(NA1 + CONTACT1),
    "listing": ('<html><body><div class="PVOOXe"><div class="NiGhzc">L1</div>'
                '<span class="pNExyb">$10</span></div></body></html>'),
    "neither": "<html><body><p>Nothing here</p></body></html>",
    "dates": container(seller("A") + price("$1"),
                       extra='<div aria-label="May 1, 2024">1</div>'
                             '<div class="ci">Wed, May 1</div><div class="co">Fri, May 3</div>'),
    "malformed": '<html><body><div id="prices"><div class="NiGhzc">A<span class="pNExyb">$1',
    "empty": "",
    "null": None,
    "hidden": container(seller("A") + price("$1")
                        + '<div class="NiGhzc" style="display: none">Ghost</div>'
                        + '<span class="pNExyb" hidden>$0</span>' + seller("B") + price("$2")),
    "fees": container(
        '<div class="NiGhzc">A<div class="Einivf qOlGCc"><span class="MW1oTb">$110</span>'
        '<span class="UeIHqb">$220</span></div></div>' + price("$100")
        + seller("B") + price("$50")),
}
