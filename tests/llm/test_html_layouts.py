"""Operator 7 on pages written by hand: what is text is marked by the test,
not by the operator's training rule."""

import re

import pytest
from cabgrid.llm import op7_html
from conftest import SF_SMALL

ONE = "The council agreed on a new bridge over the river after years of debate."
TWO = "Work is to begin in spring, once the ice has gone, and should last two years."
THREE = "Engineers expect that traffic, now slow at noon, will flow freely again."
AD = "Buy our wonderful shoes today, half the price until Sunday."
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
FOOT = "<footer>&copy; 2024 example.org. All rights reserved.</footer>"

PAGES = {
    "advert between paragraphs": (
        f"{NAV}<article><h1>A new bridge</h1><p>{ONE}</p><div class='ad-slot'>{AD}</div><p>{TWO}</p></article>{FOOT}", ["A new bridge", ONE, TWO]),
    "advert in a section of an article": (
        f"<article><p>{ONE}</p><section class='sponsored'><h4>Shoes</h4><p>{AD}</p></section><p>{TWO}</p><p>{THREE}</p></article>{FOOT}", [ONE, TWO, THREE]),
    "list in main": (
        f"{NAV}<main><h1>Rules</h1><p>{ONE}</p><ul><li>Bring two pens and paper.</li><li>Leave bags at the door.</li></ul><p>{TWO}</p></main>{FOOT}",
        ["Rules", ONE, "Bring two pens and paper.", "Leave bags at the door.", TWO]),
    "short list in article": (
        f"<article><p>{ONE}</p><ul><li>flour</li><li>two eggs</li></ul><p>{TWO}</p></article>{FOOT}", [ONE, "flour", "two eggs", TWO]),
    "ordered list in a content div": (
        f"{NAV}<div class='post-content'><h2>Steps</h2><ol><li>Open the lid with care.</li><li>Turn the key to the left.</li></ol><p>{ONE}</p></div>{FOOT}",
        ["Steps", "Open the lid with care.", "Turn the key to the left.", ONE]),
    "comments inside the article": (
        f"<article><h1>A bridge</h1><p>{ONE}</p><p>{TWO}</p><div class='comments'><div class='comment'><p>{THREE}</p></div></div></article>", ["A bridge", ONE, TWO]),
    "share bar in the article": (
        f"<article><div class='share-buttons'><a href=#>Post</a> <a href=#>Mail</a></div><p>{ONE}</p><p>{TWO}</p></article>{FOOT}", [ONE, TWO]),
    "newsletter form in the article": (
        f"<article><p>{ONE}</p><form class='newsletter'><label>Mail</label><input><p>Read us every week.</p><button>Go</button></form><p>{TWO}</p></article>", [ONE, TWO]),
    "aside in main": (
        f"<main><p>{ONE}</p><aside><h3>Related</h3><ul><li><a href=#>Old bridge</a></li></ul></aside><p>{TWO}</p></main>{FOOT}", [ONE, TWO]),
    "sidebar beside the article": (
        f"{NAV}<div class='wrapper'><article><h1>A bridge</h1><p>{ONE}</p><p>{TWO}</p></article><div class='sidebar'><p>{AD}</p></div></div>{FOOT}", ["A bridge", ONE, TWO]),
    "cookie notice": (
        f"<div class='cookie-banner'><p>We use cookies to improve this site.</p><button>Accept</button></div><article><p>{ONE}</p><p>{TWO}</p></article>", [ONE, TWO]),
    "quote and table": (
        f"<article><p>{ONE}</p><blockquote>{TWO}</blockquote><table><tr><td>Length</td><td>900 m</td></tr></table><p>{THREE}</p></article>{FOOT}",
        [ONE, TWO, "Length", "900 m", THREE]),
}


@pytest.fixture(scope="module")
def tagger(spark):
    return op7_html.train(op7_html.training_pages(spark.read.parquet(f"{SF_SMALL}/pages.parquet")))


@pytest.mark.parametrize("name", PAGES)
def test_page(tagger, name):
    html, expected = PAGES[name]
    assert tagger.extract(f"<html><head><title>t</title></head><body>{html}</body></html>") == "\n\n".join(expected)


def test_training_labels_leave_out_what_names_itself():
    page, labels = op7_html.labelled(PAGES["advert in a section of an article"][0])
    assert [b.text for b, y in zip(page, labels) if y == op7_html.MAIN] == [ONE, TWO, THREE]
