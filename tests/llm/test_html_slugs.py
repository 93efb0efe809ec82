"""Ids of headings and sections are places in an article, not page furniture."""

import pytest

from snapcredit.llm.html_text import main_text


@pytest.mark.parametrize("outer", ["article", "main"])
def test_slugs_stay(outer):
    page = (
        f'<body><div class="related">no</div><{outer}><h1>Title</h1><p>First words of the text.</p>'
        '<h2 id="Related_work">Related work</h2><p id="share-1">Others did this.</p><h2 id="social-impact">Social impact</h2>'
        '<h2 id="search">Search</h2><h3 id="advertising">Advertising</h3>'
        '<section id="discussion"><h2>Discussion</h2><p>We discuss it <a href="x">here</a> at length.</p></section>'
        "<p>As <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> <label>holds</label>.</p>"
        '<div class="notice">Mind the step.</div><div class="related"><a href="a">More of it</a> <a href="b">and more</a></div>'
        '<section id="related"><ul><li><a href="c">Other page</a></ul></section><div class="ad">Buy this</div>'
        f"<section id='comments'><p>reader</p></section><div role='search'>find</div></{outer}></body>"
    )
    assert main_text(page).split("\n") == [
        "Title", "First words of the text.", "Related work", "Others did this.", "Social impact", "Search", "Advertising",
        "Discussion", "We discuss it here at length.", "As x=1 holds.", "Mind the step.",
    ]
