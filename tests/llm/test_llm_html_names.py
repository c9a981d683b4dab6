"""Names of elements are evidence beside the ratios, and depth costs no more than size."""

import time

import pytest

from corpusloom.llm.html_content import LineParser, main_text

TEXT = " ".join("A sentence of the article goes on for quite a while, as they do." for _ in range(3))
OTHER = "What was found here is told at some length, with what it means for others in the field of work."


def page(middle="", end=""):
    return (
        f"<body><nav><a href=1>Home</a></nav><article><h1>T</h1><p>{TEXT}</p><p>{TEXT}</p>{middle}"
        f"<p>{TEXT}</p>{end}</article><footer>f</footer></body>"
    )


@pytest.mark.parametrize(
    "part, lines",
    [
        (f"<section id=discussion><h2>Discussion</h2><p>{OTHER}</p><p>{OTHER}</p></section>", ["Discussion", OTHER, OTHER]),
        (f"<section id=related-work><h2>Related work</h2><p>{OTHER}</p></section>", ["Related work", OTHER]),
        (f"<h2 id=search>Search methods</h2><p>{OTHER}</p>", ["Search methods", OTHER]),
        (f"<div class=share-price><p>{OTHER} {OTHER}</p></div>", [f"{OTHER} {OTHER}"]),
        (f"<p>As <span id=related>related</span> work says, {OTHER}</p>", [f"As related work says, {OTHER}"]),
    ],
)
def test_a_topic_is_no_page_part(part, lines):
    assert main_text(page(part)) == "\n".join(["T", TEXT, TEXT, *lines, TEXT])
    assert main_text(page("", part)) == "\n".join(["T", TEXT, TEXT, TEXT, *lines])


@pytest.mark.parametrize(
    "part",
    [
        f"<div class=AdSlot><p>{OTHER}</p></div>",
        f"<div class=relatedPosts><p>{OTHER}</p></div>",
        f"<ol class=commentlist><li><p>{OTHER}</p></li><li>{OTHER}</li></ol>",
        f"<section><h2>Comments (3)</h2><p>{OTHER}</p><p>{OTHER}</p></section>",
        f"<div class=discussion><ul><li>{OTHER}</li><li>{OTHER}</li></ul></div>",
        f"<div class=related><p><a href=x>{OTHER}</a></p></div>",
        "<div class=share><p><b>Share</b> <i>it</i></p></div>",
        f"<div class='comment'><p>{OTHER}</p></div>",
        f"<form><p>{OTHER}</p></form>",
    ],
)
def test_parts_that_are_no_text_go(part):
    for html in (page(part), page("", part)):
        assert main_text(html) == "\n".join(["T", TEXT, TEXT, TEXT])


def test_parts_are_runs_of_lines():
    parser = LineParser()
    parser.feed("<main><div class=ad><p>a</p><div>b</div></div><section>c</section></main>d")
    parser.close()
    assert [(p.name, p.start, p.end) for p in parser.parts] == [
        ("page", 0, 4), ("main", 0, 3), ("div", 0, 2), ("div", 1, 2), ("section", 2, 3),
    ]
    assert [(m.start, m.end) for m in parser.marks] == [(0, 2)]
    assert [(x.text, x.place, x.at, x.main) for x in parser.lines] == [
        ("a", 0, 2, True), ("b", 1, 3, True), ("c", 2, 4, True), ("d", 3, 0, False),
    ]


@pytest.mark.parametrize(
    "html",
    ["<div>" * 200_000 + "x", "<div><p>t</p>" * 40_000, "<div class=ad><p>t</p>" * 40_000, "<p><div>" + "<div>t</p>" * 40_000],
)
def test_depth_costs_no_more_than_size(html):
    start = time.process_time()
    assert main_text(html)
    assert time.process_time() - start < 4
