"""What there is: one row per operator, made from the operators themselves."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusloom.functions import text, tokens, vectors
from corpusloom.operators import batches, embedding, html, language, ordered, scripts
from corpusloom.sources import arrays, http, lanes, ledger, listing, objects, ranges

SERVICE = "-- requires network"
STORE = "-- requires object storage"
CLIENT = "-- requires an embedding client"


@dataclass(frozen=True)
class Entry:
    operator: Callable
    kind: str  # scalar: gives a column; table: gives a DataFrame
    category: str
    example: str

    @property
    def name(self) -> str:
        return self.operator.__name__

    @property
    def module(self) -> str:
        return self.operator.__module__.rsplit(".", 1)[1]

    @property
    def description(self) -> str:
        doc = inspect.getdoc(self.operator)
        if not doc:
            raise ValueError(f"{self.name} has no description")
        return " ".join(doc.split("\n\n")[0].split())

    @property
    def signature(self) -> str:
        return f"{self.name}{inspect.signature(self.operator)}"


def _text(operator: Callable, example: str) -> Entry:
    return Entry(operator, "scalar", "Text", f"df.select({example})")


ENTRIES = (
    _text(text.strip_newlines, "strip_newlines('text')"),
    _text(text.trim_text, "trim_text('text')"),
    _text(text.lowercase, "lowercase('text')"),
    _text(text.uppercase, "uppercase('text')"),
    _text(text.text_mode, "text_mode('text', 'trim')"),
    _text(text.regex_replace, "regex_replace('text', '[0-9]+', 'NUM')"),
    _text(text.regex_match, "regex_match('text', '[0-9]')"),
    _text(text.lines, "lines('text')"),
    _text(text.take_lines, "take_lines('text', 2)"),
    _text(text.skip_lines, "skip_lines('text', 1)"),
    _text(text.truncate, "truncate('text', 80)"),
    _text(text.squeeze_whitespace, "squeeze_whitespace('text')"),
    _text(text.word_count, "word_count('text')"),
    Entry(scripts.transform_text, "table", "Scripting", "transform_text(df, 'text', 'upper(text)')"),
    Entry(
        scripts.transform_text_per_row, "table", "Scripting",
        "transform_text_per_row(df, 'text', 'script', scripts)",
    ),
    Entry(
        language.train_language_profiles, "table", "Language",
        "train_language_profiles(df, 'text', 'lang')",
    ),
    Entry(language.detect_language, "table", "Language", "detect_language(df, 'text', profiles)"),
    Entry(language.is_english, "scalar", "Language", "df.select(is_english('text', profiles))"),
    Entry(html.extract_html, "table", "HTML", "extract_html(pages, 'html', ['page_id'], 'paragraph')"),
    Entry(html.extract_html_per_row, "table", "HTML", "extract_html_per_row(pages, 'html', 'config', ['page_id'])"),
    Entry(vectors.embed_fake, "scalar", "AI", "df.select(embed_fake('text', 768))"),
    Entry(tokens.token_count, "scalar", "AI", "df.select(token_count('text'))"),
    Entry(tokens.chunk_text, "scalar", "AI", "df.select(chunk_text('text', 512))"),
    Entry(tokens.chunk_documents, "table", "AI", "chunk_documents(df, 'text', ['doc_id'], 512)"),
    Entry(embedding.embed, "scalar", "AI", f"df.select(embed('text', client)) {CLIENT}"),
    Entry(embedding.embed_column, "table", "AI", f"embed_column(df, 'text', client) {CLIENT}"),
    Entry(batches.dense_batches, "table", "Batching", "dense_batches(df, ['event_id'], 100)"),
    Entry(ordered.heading_context, "table", "HTML", "heading_context(df, ['page_id'], 'position', df.level, df.text)"),
    Entry(ordered.pack_lines, "table", "HTML", "pack_lines(df, ['doc_id'], 'line_no', 'line')"),
    Entry(http.post_column, "scalar", "HTTP", f"df.select(post_column(url, df.body)) {SERVICE}"),
    Entry(lanes.post_by_host, "table", "HTTP", f"post_by_host(df, F.col('url'), 'body', per_host=4) {SERVICE}"),
    Entry(lanes.host_of, "scalar", "HTTP", "df.select(host_of('url'))"),
    Entry(ledger.post_rows_once, "table", "HTTP", f"post_rows_once(df, url, 'body', 'key', 'ledger') {SERVICE}"),
    Entry(http.post_rows, "table", "HTTP", f"post_rows(df, url, 'body') {SERVICE}"),
    Entry(
        http.post_batches, "table", "HTTP",
        f"post_batches(df, 'payload', ['event_id'], url, 100) {SERVICE}",
    ),
    Entry(http.payloads_from_json, "table", "HTTP", "payloads_from_json(spark, '[\"a\", \"b\"]')"),
    Entry(arrays.payloads_from_file, "table", "HTTP", "payloads_from_file(spark, 'payloads.json')"),
    Entry(http.payloads_from_lines, "table", "HTTP", "payloads_from_lines(spark, 'payloads')"),
    Entry(objects.parse_path, "scalar", "Objects", "df.select(parse_path('path'))"),
    Entry(objects.read_objects, "table", "Objects", f"read_objects(spark, 's3a://bucket/docs') {STORE}"),
    Entry(objects.fetch_objects, "table", "Objects", f"fetch_objects(df, 'path') {STORE}"),
    Entry(objects.write_objects, "table", "Objects", f"write_objects(df, 'path', 'text') {STORE}"),
    Entry(ranges.read_lines, "table", "Objects", f"read_lines(df, 'path') {STORE}"),
    Entry(listing.objects_exist_by_listing, "table", "Objects", f"objects_exist_by_listing(df, 'path') {STORE}"),
    Entry(objects.objects_exist, "table", "Objects", f"objects_exist(df, 'path') {STORE}"),
    Entry(objects.fetch_stripped, "table", "Objects", f"fetch_stripped(df, 'path') {STORE}"),
    Entry(objects.fetch_with_mode, "table", "Objects", f"fetch_with_mode(df, 'path', 'trim') {STORE}"),
    Entry(
        objects.fetch_with_script, "table", "Objects",
        f"fetch_with_script(df, 'path', 'skip_lines(text, 1)') {STORE}",
    ),
)

# The names that SQL text can call, and the operator each stands for.
SQL_NAMES = {
    "s3_fetch": objects.fetch_text,
    "s3_put": objects.put_text,
    "s3_exists": objects.object_exists,
    "s3_transform": objects.fetch_stripped,
    "s3_transform_with": objects.fetch_with_mode,
    "http_post": http.post_column,
    "http_post_batch": http.post_batches,
    "http_post_batch_object": http.post_batches,
    "html_raw": html.extract_html,
    "html_paragraphs": html.extract_html,
    "html_chunks": html.extract_html,
    "html_extract": html.extract_html_per_row,
}
_SQL_EXAMPLES = {
    "s3_fetch": f"SELECT s3_fetch(path) FROM files {STORE}",
    "s3_put": f"SELECT s3_put(path, text) FROM files {STORE}",
    "s3_exists": f"SELECT s3_exists(path) FROM files {STORE}",
    "s3_transform": f"SELECT s3_transform(path) FROM files {STORE}",
    "s3_transform_with": f"SELECT s3_transform_with(path, 'trim') FROM files {STORE}",
    "http_post": f"SELECT http_post(url, body).status_code FROM rows {SERVICE}",
    "http_post_batch": f"SELECT * FROM http_post_batch(url, '[\"a\"]', '100', '') {SERVICE}",
    "http_post_batch_object": f"SELECT * FROM http_post_batch_object(url, 's3://bucket/payloads.json', '100', '') {SERVICE}",
    **{
        name: f"SELECT e.* FROM (SELECT {name}(html) AS rows FROM pages), LATERAL inline(rows) AS e"
        for name in ("html_raw", "html_paragraphs", "html_chunks")
    },
    "html_extract": "SELECT e.* FROM (SELECT html_extract(html, config) AS rows FROM pages), LATERAL inline(rows) AS e",
}

# The columns of the catalog.
COLUMNS = ("name", "kind", "module", "category", "signature", "description", "example")


def functions_catalog(spark: SparkSession, view: str | None = "corpus_functions") -> DataFrame:
    """The operators as a table of seven text columns, also as a temporary view."""
    rows = [tuple(getattr(entry, column) for column in COLUMNS) for entry in ENTRIES]
    tables = ("http_post_batch", "http_post_batch_object")
    for name, operator in SQL_NAMES.items():
        entry = Entry(operator, "table" if name in tables else "scalar", "SQL", _SQL_EXAMPLES[name])
        signature = entry.signature.replace(operator.__name__, name, 1)
        rows.append((name, entry.kind, "sql", "SQL", signature, entry.description, entry.example))
    frame = spark.createDataFrame(rows, ", ".join(f"{column} string" for column in COLUMNS))
    if view:
        frame.createOrReplaceTempView(view)
    return frame
