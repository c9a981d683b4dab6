import time

import pytest

from corpusloom.functions.markup import page_elements, with_headings, words_in

DOCTYPE = "<!DOCTYPE html>"


def texts(page):
    return [(tag, text) for tag, _, text in page_elements(page)]


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<h1>A</h1><p>b</p>", [("h1", "A"), ("p", "b")]),
        ("<p>one<p>two", [("p", "one"), ("p", "two")]),
        ("<p>one<div>not</div>", [("p", "one")]),
        ("<p>one<br>two <b>bold</b></p>", [("p", "onetwo bold")]),
        ("<p>one<b>two<p>three", [("p", "onetwo"), ("p", "three")]),
        ("<div><p>in</div>out", [("p", "in")]),
        ("<ul><li><p>a<li><p>b</ul>", [("p", "a"), ("p", "b")]),
        ("<dl><dt><p>a<dd><p>b</dl>", [("p", "a"), ("p", "b")]),
        ("<h1>A<h2>B</h2>c", [("h1", "A"), ("h2", "B")]),
        ("<h2>A</h3>b", [("h2", "A")]),
        ("<h1>A<p>b</p>c</h1>", [("h1", "Abc"), ("p", "b")]),
        ("</p>x", [("p", "")]),
        ("<p>a<!-- <p>no --> b</p>", [("p", "a b")]),
        ("<p>a<!-->b", [("p", "ab")]),
        ("<p>a<?php no ?>b", [("p", "ab")]),
        ("<script>var t='</p><p>no';</script><p>a", [("p", "a")]),
        ("<style>p{}</style><p>a", [("p", "a")]),
        ("<p>a<script>x&amp;y</script>b", [("p", "ax&amp;yb")]),
        ("<title><p>no</title><p>a", [("p", "a")]),
        ("<p><textarea>&lt;p></textarea></p>", [("p", "<p>")]),
        ("<noscript><p>no</noscript><p>a", [("p", "a")]),
        ("<p>&amp;&lt;&copy;&#65;&#x42;&nbsp;</p>", [("p", "&<©AB")]),
        ("<p>3 < 4 and 5 > 4</p>", [("p", "3 < 4 and 5 > 4")]),
        ('<p title="a>b">c</p>', [("p", "c")]),
        ("<P>a</P><H1>b</H1>", [("p", "a"), ("h1", "b")]),
        ("<p>a</body></html> b", [("p", "a b")]),
        ("<p>a</p", [("p", "a")]),
        ("<p>a<p", [("p", "a")]),
        ("<button><p>a</button>b<p>c", [("p", "a"), ("p", "c")]),
        ("<p>a<button><p>b</button>c", [("p", "abc"), ("p", "b")]),
        ("<table><tr><td><p>a<td><p>b</table>c", [("p", "a"), ("p", "b")]),
        ("<td><p>a<tr>b", [("p", "ab")]),
        ("<p>a\r\nb\0</p>", [("p", "a\nb")]),
        ("", []),
        ("no tags", []),
    ],
)
def test_elements(page, expected):
    assert texts(page) == expected


def test_nested_paragraph_counts_in_both():
    page = "<p>out<table><tr><td><p>in</td></tr></table>more"
    # without a standard doctype a table does not end the paragraph
    assert texts(page) == [("p", "outinmore"), ("p", "in")]
    assert texts(DOCTYPE + page) == [("p", "out"), ("p", "in")]


@pytest.mark.parametrize(
    "tag, classes",
    [
        ('<p class="a b">', "a b"), ("<p class='a'>", "a"), ("<p class=a>", "a"),
        ("<p CLASS = 'A'>", "A"), ("<p data-class='x'>", ""), ("<p id=x class=y>", "y"),
        ('<p class="a&amp;b">', "a&b"), ("<p>", ""), ("<p class>", ""),
        ("""<p title=" class=no" class='b'>""", "b"), ("<p class=a class=b>", "a"),
        ("<p/class=a>", "a"),
    ],
)
def test_classes(tag, classes):
    assert page_elements(tag + "text")[0][1] == classes


def test_heading_context_is_reset_by_level():
    page = "<h1>A</h1><h3>C</h3><p>x</p><h2>B</h2><p>y</p><h1>D</h1><p>z</p>"
    rows = with_headings(page_elements(page))
    contexts = {text: context[:3] for tag, text, _, *context, _ in rows if tag == "p"}
    assert contexts == {"x": ["A", "", "C"], "y": ["A", "B", ""], "z": ["D", "", ""]}
    # a heading row carries itself
    assert rows[0][3] == "A"


def test_words():
    assert words_in(" a b\x1cc　d ") == 3
    assert words_in("") == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "<p>a", "<p>" * 100_000, "<p class=" * 50_000, "<!--" * 100_000,
        "<" * 200_000, '<a href="' * 50_000, "<ul><li>" * 50_000, "<script>" * 50_000,
        "</div>" * 100_000, "<h1><b>" * 50_000, "<p " + "=" * 100_000,
    ],
)
def test_odd_pages_take_linear_time(page):
    start = time.perf_counter()
    page_elements(page)
    assert time.perf_counter() - start < 5
