import pytest

from corpusloom.operators.embedding import fake_client
from corpusloom.operators.html import extract_html
from corpusloom.operators.language import train_language_profiles
from corpusloom.sources.http import Response
from corpusloom.sql import register_functions


def upper(request):
    if "down" in request.body:
        raise ConnectionError("refused")
    return Response(200, request.body.upper())


@pytest.fixture(scope="module")
def sql(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.createOrReplaceTempView("documents")
    spark.read.parquet(f"{sf_dir}/pages.parquet").createOrReplaceTempView("pages")
    profiles = train_language_profiles(docs, "text", "lang")
    from corpusloom.functions.retry import RetryPolicy

    names = register_functions(
        spark, profiles, embedder=fake_client(3), transport=upper, retry=RetryPolicy(3, 0.0)
    )
    assert "is_english" in names and "html_chunks" in names
    return lambda text: [tuple(r) for r in spark.sql(text).collect()]


def test_scalars(sql):
    assert sql("SELECT size(embed_fake('hello world', 768))") == [(768,)]
    assert sql("SELECT embed_fake('a', 2) = slice(embed('a'), 1, 2)") == [(True,)]
    sizes = sql("SELECT size(embed_fake(t, n)) FROM VALUES ('a', 1), ('b', 3) AS v(t, n)")
    assert sizes == [(1,), (3,)]
    assert sql("SELECT embed('a', 'http://e') = embed('a'), chunk_text('a b', 1, 'http://e')") == [
        (True, ["a", "b"])
    ]
    assert sql("SELECT embed(NULL), chunk_text(NULL, 5), token_count(NULL)") == [(None, None, None)]
    assert sql("SELECT token_count('a b c'), chunk_text('One two. Three.', 2)") == [
        (3, ["One two.", "Three."])
    ]


def test_is_english(sql):
    rows = sql("SELECT lang, is_english(text), count(*) FROM documents GROUP BY 1, 2")
    assert all(english == (lang == "en") for lang, english, n in rows if n > 5)
    assert sql("SELECT is_english(CAST(NULL AS STRING))") == [(None,)]


def test_html_over_a_literal(sql):
    page = "<h1>T</h1><p>body of the text</p>"
    assert sql(f"SELECT e.chunk_id, e.text, e.h1 FROM (SELECT html_paragraphs('{page}', 1) AS rows), LATERAL inline(rows) AS e") == [
        (0, "body of the text", "T")
    ]
    assert sql(f"SELECT html_raw('{page}')[0].element_type, html_chunks('{page}')") == [("h1", [])]
    for name in ("html_raw", "html_paragraphs", "html_chunks"):
        assert "expects HTML content" in sql(f"SELECT {name}('s3://b/k')[0].error")[0][0]
        assert sql(f"SELECT {name}(NULL)") == [(None,)]


@pytest.mark.parametrize("function, config", [
    ("html_raw(html)", "raw"), ("html_paragraphs(html)", "paragraph"), ("html_chunks(html, 0, 30)", '{"min_words": 0, "max_words": 30}'),
])
def test_html_over_a_table_agrees_with_the_operator(spark, sql, function, config):
    frame = extract_html(spark.table("pages"), "html", ["page_id"], config)
    text = f"SELECT page_id, e.* FROM (SELECT page_id, {function} AS rows FROM pages), LATERAL inline(rows) AS e"
    assert sorted(sql(text)) == sorted(tuple(r) for r in frame.collect())
    plan = spark.sql(text)._jdf.queryExecution().executedPlan().toString()
    assert "UDTF" not in plan and "Exchange" not in plan and plan.count("ArrowEvalPython") <= 2


def test_a_config_for_each_row(spark, sql):
    page = "<h1>T</h1><p class=\"Side-bar x\">one two</p><p>three</p>"
    rows = sql(f"""
        SELECT k, e.mode, e.position, e.element_type, e.text, e.classes, e.paragraph_count, e.error
        FROM (SELECT k, html_extract(h, c) AS rows FROM VALUES
          (1, '{page}', 'raw'), (2, '{page}', '{{"mode": "elements", "filters": {{"min_words": 1, "skip_classes": ["BAR"]}}}}'),
          (3, '{page}', '{{"filters": {{"min_words": 0, "skip_classes": ["", "x y"]}}, "min_words": 0}}'),
          (4, '{page}', ''), (5, 's3://b/k', 'nlp'), (6, 'http://b', 'raw'), (7, NULL, 'raw'), (8, '{page}', NULL)
          AS v(k, h, c)), LATERAL inline(rows) AS e""")
    message = "extract_html expects HTML content, not URL. Fetch the object first."
    assert sorted(rows, key=lambda r: r[:3]) == [
        (1, "raw", 0, "h1", "T", "", None, ""),
        (2, "raw", 0, "h1", "T", "", None, ""), (2, "raw", 1, "p", "three", "", None, ""),
        (3, "semantic", 0, None, "three", None, 1, ""),
        (5, "paragraph", 0, None, "", None, 0, message),
        (6, "raw", 0, "", "", "", None, message),
    ]
    assert sql(f"SELECT html_extract('{page}') = html_extract('{page}', 'rag'), html_extract(NULL, 'raw')") == [(True, None)]
    with pytest.raises(Exception, match="Invalid config JSON"):
        sql(f"SELECT html_extract('{page}', '{{broken')")


def test_http(sql):
    assert sql("SELECT http_post('http://x', 'abc').body") == [("ABC",)]
    assert sql("SELECT http_post('http://x', 'abc', '{\"a\": \"b\"}').status_code") == [(200,)]
    rows = sql("""SELECT * FROM http_post_batch('http://x', '["a", {"b": 1}, "down"]', '2', '')""")
    assert rows[0] == (0, 2, 200, '["A","{\\"B\\":1}"]')
    assert rows[1][:3] == (1, 1, -1) and "refused" in rows[1][3]
    assert sql("SELECT * FROM http_post_batch('http://x', '[]', '2', '')") == []


def test_payload_files(sql, tmp_path):
    (tmp_path / "p.json").write_text('["a", {"b": 1, "a": 2}, null, 1.0]')
    rows = sql(f"SELECT * FROM http_post_batch_object('http://x', 'file://{tmp_path}/p.json', '10', '')")
    assert rows == [(0, 4, 200, '["A","{\\"A\\":2,\\"B\\":1}","NULL","1.0"]')]
    # a value is never taken for a path
    for path in (f"{tmp_path}/p.json", f"file://{tmp_path}/p.json"):
        with pytest.raises(Exception, match="Invalid payloads JSON"):
            sql(f"SELECT * FROM http_post_batch('http://x', '{path}', '10', '')")


@pytest.mark.parametrize(
    "query, message",
    [
        ("SELECT http_post('http://x', '{}', 'not valid json')", "Invalid headers JSON"),
        ("SELECT * FROM http_post_batch('http://x', 'not valid json', '10', '')", "Invalid payloads JSON"),
        ("SELECT * FROM http_post_batch('http://x', '[\"a\"]', '0', '')", "batch_size must be greater than 0"),
        ("SELECT * FROM http_post_batch('http://x', '[\"a\"]', 'no', '')", "Invalid batch_size"),
        ("SELECT s3_transform('invalid_path')", "must start with s3://"),
        ("SELECT s3_transform_with('invalid_path', 'trim')", "must start with s3://"),
        ("SELECT s3_put('invalid_path', 'content')", "must start with s3://"),
    ],
)
def test_errors(sql, query, message):
    with pytest.raises(Exception, match=message):
        sql(query)


def test_objects(sql, tmp_path):
    path = f"file://{tmp_path}/o.txt"
    assert sql(f"SELECT s3_put('{path}', 'Hey\\nyou')") == [(path,)]
    assert sql(f"SELECT s3_exists('{path}'), s3_exists('{path}.no')") == [(True, False)]
    assert sql(f"SELECT s3_fetch('{path}'), s3_transform('{path}'), s3_transform_with('{path}', 'UPPER')") == [
        ("Hey\nyou", "Hey you", "HEY\nYOU")
    ]
