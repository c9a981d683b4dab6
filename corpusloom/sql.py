"""The operators under SQL names, for sessions that work in SQL text.

Pages give arrays of rows; spread them with ``LATERAL inline``. The DataFrame operators remain the
way for large jobs: they take keys, options and clients.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom.catalog import functions_catalog
from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, RetryPolicy
from corpusloom.functions.text import SQL_FUNCTIONS, register_sql
from corpusloom.functions.tokens import Tokenizer, chunks_udf, counter_udf
from corpusloom.functions.vectors import fake_udf
from corpusloom.operators.embedding import ClientFactory, embed_udf
from corpusloom.operators.html import (
    BOUND,
    CONFIG,
    ELEMENT,
    HEADINGS,
    MAX_CHUNK_WORDS,
    MAX_HTML_BYTES,
    MIN_CHUNK_WORDS,
    ROW,
    SKIP_CLASSES,
    URL_ERROR,
    URL_STARTS,
    config_udf,
    elements_udf,
    error_sql,
    kept_sql,
    pack_udf,
    rows_sql,
    size_error,
    skip_pattern,
)
from corpusloom.operators.language import language_judge
from corpusloom.sources.http import (
    HTTP_RETRY,
    RESPONSE,
    Transport,
    UrlTransport,
    payload_list,
    post_udf,
)
from corpusloom.sources.objects import (
    DefaultResolver,
    Resolver,
    exists_udf,
    fetch_udf,
    put_udf,
)


# pages by default rules, as arrays of rows: a table of pages goes through LATERAL inline(...)
_PAGE_ERROR = (
    f"CASE WHEN octet_length(html) > {MAX_HTML_BYTES} "
    f"THEN printf('{size_error('%d', MAX_HTML_BYTES)}', octet_length(html)) WHEN "
    + " OR ".join(f"startswith(html, '{start}')" for start in URL_STARTS)
    + f" THEN '{URL_ERROR}' END"
)
_PAGE = f"CASE WHEN {_PAGE_ERROR} IS NULL THEN html END"
_KEPT = (
    "e.word_count >= min_paragraph AND NOT (e.classes <> '' "
    f"AND lower(e.classes) RLIKE '{skip_pattern(SKIP_CLASSES)}')"
)
_HEADING_FIELDS = ", ".join(f"{h} STRING" for h in HEADINGS)
_RAW_TYPE = (
    f"ARRAY<STRUCT<position INT, element_type STRING, text STRING, word_count INT, {_HEADING_FIELDS}, "
    "classes STRING, error STRING>>"
)
_CHUNK_TYPE = (
    f"ARRAY<STRUCT<chunk_id INT, text STRING, {_HEADING_FIELDS}, word_count INT, paragraph_count INT, "
    "error STRING>>"
)


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _headings(value: str) -> dict[str, str]:
    return {h: value.format(h) for h in HEADINGS}


def _or_error(rows: str, **blank: str) -> str:
    return f"CASE WHEN {_PAGE_ERROR} IS NULL THEN {rows} ELSE array({_struct(**blank, error=_PAGE_ERROR)}) END"


_BLANK_CHUNK = dict(chunk_id="0", text="''", **_headings("''"), word_count="0", paragraph_count="0")
_CHUNK_TEXT = SQL_FUNCTIONS["trim_text"][2].replace(
    "FROM text", "FROM array_join(transform(slice(x.p, b.start + 1, b.size), e -> e.text), '\\n\\n')"
)
_PARAGRAPHS = f"filter(html_scan({_PAGE}), e -> e.element_type = 'p' AND {_KEPT})"
_PAGE_SQL = {
    "html_raw": (
        "html STRING, min_paragraph INT DEFAULT 10",
        _RAW_TYPE,
        _or_error(
            f"transform(filter(html_scan_once({_PAGE}), e -> e.element_type <> 'p' OR {_KEPT}), (e, i) -> "
            + _struct(
                position="i", element_type="e.element_type", text="e.text", word_count="e.word_count",
                **_headings("e.{0}"), classes="e.classes", error="''",
            )
            + ")",
            position="0", element_type="''", text="''", word_count="0", **_headings("''"), classes="''",
        ),
    ),
    "html_paragraphs": (
        "html STRING, min_paragraph INT DEFAULT 10",
        _CHUNK_TYPE,
        _or_error(
            f"transform({_PARAGRAPHS.replace('html_scan', 'html_scan_once')}, (e, i) -> "
            + _struct(
                chunk_id="i", text="e.text", **_headings("e.{0}"), word_count="e.word_count",
                paragraph_count="1", error="''",
            )
            + ")",
            **_BLANK_CHUNK,
        ),
    ),
    "html_chunks": (
        f"html STRING, min_words INT DEFAULT {MIN_CHUNK_WORDS}, max_words INT DEFAULT {MAX_CHUNK_WORDS}, "
        "min_paragraph INT DEFAULT 10",
        _CHUNK_TYPE,
        _or_error(
            f"transform(array(named_struct('p', {_PARAGRAPHS}, 'b', html_pack(transform({_PARAGRAPHS}, "
            "e -> e.word_count), min_words, max_words))), x -> transform(x.b, (b, i) -> "
            + _struct(
                chunk_id="i", text=_CHUNK_TEXT,
                **_headings("coalesce(CASE WHEN b.size > 0 THEN get(x.p, b.start).{0} END, '')"),
                word_count="b.words", paragraph_count="b.size", error="''",
            )
            + "))[0]",
            **_BLANK_CHUNK,
        ),
    ),
}

# pages by a config for each row. What a function passes to the next is a column there, which lambdas may use
_KEPT_TYPES = f"ARRAY<{ELEMENT.simpleString()}>"
_ROWS = f"ARRAY<{ROW.simpleString()}>"
_PAGE_SQL |= {
    "html_rows_of_bounds": (
        f"kept {_KEPT_TYPES}, bounds ARRAY<{BOUND.simpleString()}>, mode STRING, error STRING",
        _ROWS,
        f"CASE WHEN error IS NULL THEN {rows_sql('kept', 'bounds', 'mode')} ELSE {error_sql('mode', 'error')} END",
    ),
    "html_rows_of_kept": (
        f"kept {_KEPT_TYPES}, chosen {CONFIG.simpleString()}, error STRING",
        _ROWS,
        "html_rows_of_bounds(kept, html_pack(CASE WHEN chosen.mode = 'semantic' THEN transform(kept, e -> e.word_count) END, "
        "chosen.min_words, chosen.max_words), chosen.mode, error)",
    ),
    "html_rows_of_elements": (
        f"elements {_KEPT_TYPES}, chosen {CONFIG.simpleString()}, error STRING",
        _ROWS,
        f"html_rows_of_kept({kept_sql('elements', 'chosen')}, chosen, error)",
    ),
    "html_extract": (
        "html STRING, config STRING DEFAULT NULL",
        _ROWS,
        f"html_rows_of_elements(html_scan_once({_PAGE}), html_config(config), {_PAGE_ERROR})",
    ),
}

# SQL bodies over the registered Arrow functions
_SCALAR_SQL = {
    "s3_transform": ("path STRING", "STRING", "strip_newlines(s3_fetch(path))"),
    "s3_transform_with": (
        "path STRING, mode STRING", "STRING", "text_mode(s3_fetch(path), mode)",
    ),
    "chunk_text": (
        "text STRING, max_tokens INT, endpoint STRING DEFAULT NULL",
        "ARRAY<STRING>",
        "chunks_at_endpoint(text, max_tokens, endpoint)",
    ),
    "http_post": (
        "url STRING, body STRING, headers STRING DEFAULT NULL",
        RESPONSE.simpleString(),
        "http_post_or_fail(url, body, headers, cast(NULL AS STRING))",
    ),
}
_LETTERS_SQL = r"concat(' ', trim(regexp_replace(lower(text), r'[^\p{L}]+', ' ')), ' ')"

_POST_BATCH_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(
    url STRING, {source} STRING, batch_size STRING, headers STRING)
RETURNS TABLE(batch_id INT, row_count INT, status_code INT, response_body STRING)
RETURN
  SELECT batch_id, size(part), answer.status_code, answer.body
  FROM (
    SELECT batch_id, part, http_post_or_row(url, to_json(part), nullif(headers, ''), cast(NULL AS STRING)) AS answer
    FROM (
      SELECT posexplode(transform(
        CASE WHEN size(list) = 0 THEN cast(array() AS ARRAY<INT>)
             ELSE sequence(1, size(list), n) END,
        first -> slice(list, first, n))) AS (batch_id, part)
      FROM (
        SELECT CASE WHEN try_cast(batch_size AS INT) IS NULL OR try_cast(batch_size AS INT) < 0
                      THEN raise_error(concat('Invalid batch_size: ', batch_size))
                    WHEN cast(batch_size AS INT) = 0
                      THEN raise_error('batch_size must be greater than 0')
                    ELSE cast(batch_size AS INT) END AS n,
               {listed} AS list
      )
    )
  )"""


# a JSON array as a value, or the address of an object that holds one; never guessed from the value
_POST_BATCH = {
    "http_post_batch": ("payloads", "payload_list(payloads)"),
    "http_post_batch_object": ("path", "payload_list(s3_fetch(path))"),
}


def payloads_udf():
    """The Arrow function from a JSON array to its payloads."""

    @F.arrow_udf(ArrayType(StringType()))
    def listed(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else payload_list(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return listed.asNondeterministic()


def register_functions(
    spark: SparkSession,
    profiles: DataFrame | None = None,
    english: str = "en",
    embedder: ClientFactory | None = None,
    tokenizer: Tokenizer = "words",
    resolver: Resolver | None = None,
    transport: Transport | None = None,
    retry: RetryPolicy = HTTP_RETRY,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
) -> list[str]:
    """Register all SQL names for this session and return them.

    ``is_english`` needs language profiles and ``embed`` a client; without them these two names
    are left out. ``embed``, ``token_count`` and ``chunk_text`` take an endpoint as last
    argument, which goes to the client's factory; counting words needs none.
    """
    register_sql(spark)
    resolver, transport = resolver or DefaultResolver(), transport or UrlTransport()
    arrow = {
        "embed_fake": fake_udf(),
        "chunks_at_endpoint": chunks_udf(tokenizer),
        "html_scan": elements_udf(),
        "html_scan_once": elements_udf().asNondeterministic(),
        "html_pack": pack_udf(),
        "html_config": config_udf(),
        "s3_fetch": fetch_udf(resolver, max_in_flight, "fail"),
        "s3_put": put_udf(resolver, max_in_flight, "fail"),
        "s3_exists": exists_udf(resolver, max_in_flight, "fail"),
        "payload_list": payloads_udf(),
        "http_post_or_fail": post_udf(transport, retry, max_in_flight, "fail"),
        "http_post_or_row": post_udf(transport, retry, max_in_flight, "row"),
    }
    if embedder is not None:
        arrow["embed_at_endpoint"] = embed_udf(embedder)
    if profiles is not None:
        arrow["language_of_letters"] = language_judge(profiles)
    scalar = _SCALAR_SQL | _PAGE_SQL
    if callable(tokenizer):
        arrow["count_at_endpoint"] = counter_udf(tokenizer)
        counted = "count_at_endpoint(text, endpoint)"
    elif tokenizer == "words":
        counted = "cast(word_count(text) AS BIGINT)"
    else:
        raise ValueError("the tokenizer is 'words' or a factory")
    scalar["token_count"] = ("text STRING, endpoint STRING DEFAULT NULL", "BIGINT", counted)
    if embedder is not None:
        scalar["embed"] = (
            "text STRING, endpoint STRING DEFAULT NULL",
            "ARRAY<DOUBLE>",
            "embed_at_endpoint(text, endpoint)",
        )
    if profiles is not None:
        found = f"language_of_letters({_LETTERS_SQL})"
        literal = english.replace("\\", "\\\\").replace("'", "\\'")
        scalar["is_english"] = (
            "text STRING",
            "BOOLEAN",
            f"CASE WHEN text IS NOT NULL "
            f"THEN coalesce({found}.lang = '{literal}' AND {found}.reliable, false) END",
        )
    for name, function in arrow.items():
        spark.udf.register(name, function)
    for name, (parameters, result, body) in scalar.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
            f"RETURNS {result} RETURN {body}"
        )
    for name, (source, listed) in _POST_BATCH.items():
        spark.sql(_POST_BATCH_SQL.format(name=name, source=source, listed=listed))
    functions_catalog(spark)
    return sorted([*arrow, *scalar, *_POST_BATCH])
