"""Only what a page hides is left out of its leaf blocks."""

import pytest

from meterlake.llm import crf_html


@pytest.mark.parametrize("attributes, hidden", [
    ("hidden", True), ("HIDDEN=''", True), ("class=a hidden id=b", True), ("aria-hidden=true", True),
    ("aria-hidden='TRUE'", True), ("style='color:red; Display : none !important'", True), ("style=display:none", True),
    ("style='overflow:hidden'", False), ("style='visibility:hidden;display:block'", False),
    ("style='display:none;display:block'", False), ("class='overflow-hidden'", False), ("class=hidden-print", False),
    ("class='hidden'", False), ("aria-hidden='false'", False), ("id=hidden", False),
    ("data-title='a hidden place'", False), ("data-hidden=1", False), ("title='x display:none y'", False),
    ("title='a\" hidden'", False), ("data-style='display:none'", False)])
def test_hidden_wrapper(attributes, hidden):
    page = f"<body><div {attributes}><p>The council met on Tuesday.</p></div><p>After it.</p></body>"
    texts = [b.text for b in crf_html.leaf_blocks(page)]
    assert texts == (["After it."] if hidden else ["The council met on Tuesday.", "After it."])


def test_article_in_a_clipped_wrapper(spark):
    text = "The council met on Tuesday evening and agreed to rebuild the old bridge before the winter."
    page = f"<body><div style='overflow:hidden' aria-hidden='false'><article><p>{text}</p></article></div></body>"
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    assert crf_html.extracted(df).first()["text"] == text
