import pytest

from corpusloom.operators.html import ExtractConfig, chunk_bounds, extract_html

TWO_PARAGRAPHS = """
<html><body>
  <h1>Harbour</h1><p>Boats leave at six each morning when the tide is high.
  <h2>Boats</h2><p>Twelve of them carry nets and two go out for crabs and mussels.</p>
</body></html>"""


def extract(spark, page, config=None, **options):
    df = spark.createDataFrame([(7, page)], "k int, html string")
    frame = extract_html(df, "html", ["k"], config, **options)
    order = "position" if "position" in frame.columns else "chunk_id"
    return frame.orderBy(order).collect()


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


def test_two_paragraphs(spark):
    rows = extract(spark, TWO_PARAGRAPHS, {"mode": "paragraph", "filters": {"min_words": 5}})
    assert [(r.k, r.chunk_id, r.h1, r.h2, r.paragraph_count, r.error) for r in rows] == [
        (7, 0, "Harbour", "", 1, ""), (7, 1, "Harbour", "Boats", 1, ""),
    ]


@pytest.mark.parametrize("url", ["s3://bucket/file.html", "http://x", "https://x"])
@pytest.mark.parametrize("mode", ["raw", "paragraph", "semantic"])
def test_a_url_gives_one_error_row(spark, url, mode):
    (row,) = extract(spark, url, mode)
    assert "expects HTML content" in row.error and row.text == "" and row.word_count == 0


def test_size_guard(spark):
    (row,) = extract(spark, "é" * 30, max_bytes=50)
    assert row.error == "Document too large: 60 bytes (max 50). Split into chapters."
    assert extract(spark, "é" * 25, max_bytes=50) == []


def test_nothing_to_extract(spark):
    assert extract(spark, "") == extract(spark, None) == extract(spark, "<div>no</div>", "raw") == []


def test_filters(spark):
    page = (
        f"<nav><h2>Menu</h2></nav><p class='NavBar-x'>{words(12)}</p><p class='site-footer b'>{words(12)}</p>"
        f"<p class='text'>{words(12)}</p><p>{words(9)}</p><p>{words(10)}</p>"
    )
    kept = [(r.element_type, r.word_count, r.h2) for r in extract(spark, page, "raw")]
    # headings are never filtered and also count inside navigation
    assert kept == [("h2", 1, "Menu"), ("p", 12, "Menu"), ("p", 10, "Menu")]
    everything = extract(spark, page, '{"mode": "raw", "filters": {"enabled": false}}')
    assert len(everything) == 6 and [r.position for r in everything] == list(range(6))
    own = '{"mode": "raw", "filters": {"skip_classes": ["TEXT"], "min_words": 0}}'
    assert [r.word_count for r in extract(spark, page, own)] == [1, 12, 12, 9, 10]


def test_semantic_defaults(spark):
    page = "<h1>T</h1>" + "".join(f"<p>{words(n)}</p>" for n in (60, 60, 390, 200, 450, 90))
    rows = extract(spark, page)
    assert [(r.word_count, r.paragraph_count) for r in rows] == [
        (120, 2), (390, 1), (200, 1), (450, 1), (90, 1),
    ]
    # the tail may be short of the minimum
    assert rows[0].text == words(60) + "\n\n" + words(60)


def naive_pack(paragraphs, low, high):
    chunks, current = [], []
    for count in paragraphs:
        if sum(current) + count > high and sum(current) >= low:
            chunks.append(current)
            current = []
        current = current + [count]
    return chunks + [current] if sum(current) else chunks


@pytest.mark.parametrize(
    "counts, low, high",
    [
        ([700, 5], 100, 500), ([700], 0, 500), ([250, 250, 1], 100, 500), ([50, 480], 100, 500),
        ([10] * 30, 25, 20), ([0, 0], 0, 5), ([], 1, 5), ([3, 0, 4], 0, 3), ([5, 5, 5], 0, 0),
    ],
)
def test_packing(counts, low, high):
    bounds = chunk_bounds(counts, low, high)
    assert [counts[s : s + n] for s, n, _ in bounds] == naive_pack(counts, low, high)
    assert [w for _, _, w in bounds] == [sum(c) for c in naive_pack(counts, low, high)]


def test_an_empty_first_chunk_when_no_minimum(spark):
    page = f"<h1>T</h1><p>{words(8)}</p>"
    rows = extract(spark, page, {"min_words": 0, "max_words": 5, "filters": {"min_words": 1}})
    assert [(r.chunk_id, r.text, r.h1, r.paragraph_count) for r in rows] == [
        (0, "", "", 0), (1, words(8), "T", 1),
    ]


@pytest.mark.parametrize(
    "given, expected",
    [
        (None, ExtractConfig()), ("", ExtractConfig()), ("NULL", ExtractConfig()),
        ("RAG", ExtractConfig()), ("nlp", ExtractConfig(mode="paragraph")),
        ("Elements", ExtractConfig(mode="raw")), ("unknown", ExtractConfig()),
        ("{}", ExtractConfig()), ('{"mode": "nlp"}', ExtractConfig(mode="paragraph")),
        ('{"min_words": 5, "max_words": 9}', ExtractConfig(min_words=5, max_words=9)),
        ('{"min_words": "5", "max_words": -1, "mode": 3}', ExtractConfig()),
        ('{"filters": {"enabled": false}}', ExtractConfig(filter_enabled=False)),
        ('{"filters": {"enabled": "no", "min_words": 1.5, "skip_classes": 3}}', ExtractConfig()),
        ('{"filters": {"skip_classes": ["a", 1]}}', ExtractConfig(skip_classes=("a",))),
    ],
)
def test_config(given, expected):
    assert ExtractConfig.from_any(given) == expected


def test_malformed_config_raises():
    with pytest.raises(ValueError, match="Invalid config JSON"):
        ExtractConfig.from_any("{nope")


def test_no_shuffle_and_only_needed_columns(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = extract_html(pages, "html", ["page_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan
