"""The registered queries: every operator over the whole of a given table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions import text as T
from corpusloom.functions.retry import RetryPolicy, TransientError
from corpusloom.functions.tokens import chunk_documents, token_count
from corpusloom.functions.vectors import embed_fake
from corpusloom.operators.embedding import embed_column, fake_client
from corpusloom.operators.html import extract_html, extract_html_per_row
from corpusloom.operators.language import detect_language, is_english, train_language_profiles
from corpusloom.operators.ordered import heading_context, pack_lines
from corpusloom.operators.scripts import transform_text, transform_text_per_row
from corpusloom.session import new_folder, spread
from corpusloom.sources.arrays import payloads_from_file
from corpusloom.sources.lanes import host_of, post_by_host as post_in_lanes
from corpusloom.sources.listing import objects_exist_by_listing
from corpusloom.sources.ranges import read_lines
from corpusloom.sources.http import (
    Request,
    Response,
    batch_bodies,
    payloads_from_lines,
    post_batches,
    post_rows,
    response_headers,
)
from corpusloom.sql import register_functions
from corpusloom.streaming.sinks import post_batches_stream
from corpusloom.sources.objects import (
    fetch_objects,
    fetch_stripped,
    fetch_with_mode,
    fetch_with_script,
    objects_exist,
    parse_path,
    read_objects,
    write_objects,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SERVICE = "http://service.example/post"
NO_WAIT = RetryPolicy(retries=3, first_wait=0.0)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the costly operators."""
    return spread(documents(spark, sf_dir).select("doc_id", "lang", "text"))


def _by_document(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    """A projection of the scan, without any shuffle."""
    named = [column.alias(name) for name, column in columns.items()]
    return documents(spark, sf_dir).select("doc_id", *named)


# --- text ---------------------------------------------------------------------------------


@query
def text_strip_newlines(spark, sf_dir):
    ended = F.replace("text", F.lit("\n"), F.lit("\r\n"))
    return _by_document(spark, sf_dir, out=T.strip_newlines(ended))


@query
def text_trim(spark, sf_dir):
    padded = F.concat(F.lit(" \t \n"), F.col("text"), F.lit("\u3000\u00a0 \r\n"))
    return _by_document(spark, sf_dir, out=T.trim_text(padded))


@query
def text_lower(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.lowercase("text"))


@query
def text_upper(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.uppercase("text"))


@query
def text_mode_per_row(spark, sf_dir):
    names = ["Trim", "lower", "UPPERCASE", "raw", "oneline", "no such mode"]
    mode = F.element_at(F.array(*map(F.lit, names)), (F.col("doc_id") % 6 + 1).cast("int"))
    return _by_document(spark, sf_dir, mode=mode, out=T.text_mode("text", mode))


@query
def text_squeeze(spark, sf_dir):
    spread = F.replace("text", F.lit(" "), F.lit(" \t "))
    return _by_document(spark, sf_dir, out=T.squeeze_whitespace(spread))


@query
def text_regex_replace(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.regex_replace("text", "([0-9])([0-9]*)", "<$2>"))


@query
def text_regex_match(spark, sf_dir):
    return _by_document(
        spark, sf_dir, has_digit=T.regex_match("text", "[0-9]"), ends=T.regex_match("text", r"\.$")
    )


@query
def text_regex_posix(spark, sf_dir):
    return _by_document(
        spark,
        sf_dir,
        digits=T.regex_replace("text", "[[:digit:]]+", "#"),
        upper=T.regex_match("text", "[[:upper:]]{2}"),
        others=F.md5(T.regex_replace("text", "[^[:alnum:][:space:]]", "")),
    )


@query
def text_lines(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return docs.select("doc_id", F.posexplode(T.lines("text")).alias("line_no", "line"))


@query
def text_take_lines(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.take_lines("text", 2), none=T.take_lines("text", -1))


@query
def text_skip_lines(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.skip_lines("text", 2), whole=T.skip_lines("text", 0))


@query
def text_truncate(spark, sf_dir):
    return _by_document(spark, sf_dir, out=T.truncate("text", 100), whole=T.truncate("text", -1))


@query
def text_word_count(spark, sf_dir):
    return _by_document(spark, sf_dir, words=T.word_count("text"))


@query
def script_steps(spark, sf_dir):
    steps = [
        "squeeze_whitespace(text)",
        "regex_replace(text, '[0-9]+', 'NUM')",
        "truncate(lower(text), 300)",
    ]
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return transform_text(docs, "text", steps, "out").select("doc_id", "out")


@query
def script_named_group(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    script = "regex_replace(text, '(?P<word>[[:alpha:]]+)[[:space:]]+([[:digit:]])', '$2<$word$7>')"
    return transform_text(docs, "text", script, "out").select("doc_id", "out")


@query
def script_per_row(spark, sf_dir):
    scripts = ["lower(text)", "skip_lines(text, 1)", "truncate(squeeze_whitespace(text), 50)"]
    # every fourth document has no script
    chosen = F.get(F.array(*map(F.lit, scripts)), (F.col("doc_id") % 4).cast("int"))
    docs = documents(spark, sf_dir).select("doc_id", "text", chosen.alias("script"))
    return transform_text_per_row(docs, "text", "script", scripts, "out").select("doc_id", "out")


@query
def cleaned_words_by_language(spark, sf_dir):
    cleaned = T.regex_replace(T.squeeze_whitespace("text"), "[0-9]+", "#")
    words = documents(spark, sf_dir).select("lang", T.word_count(cleaned).alias("words"))
    return words.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("words").alias("words")
    )


# --- vectors, tokens, chunks --------------------------------------------------------------


def _vector_rows(df: DataFrame, column: str | Column) -> DataFrame:
    rows = df.select("doc_id", F.posexplode(column).alias("place", "value"))
    return rows.withColumn("value", F.round("value", 6))


@query
def embed_fake_vectors(spark, sf_dir):
    return _vector_rows(spread_documents(spark, sf_dir), embed_fake("text", 8))


@query
def embed_dedup_join(spark, sf_dir):
    docs = spread_documents(spark, sf_dir).select("doc_id", "text")
    embedded = embed_column(docs, "text", fake_client(4), "vector", dedupe="global")
    return _vector_rows(embedded, "vector")


@query
def embed_in_place(spark, sf_dir):
    docs = spread_documents(spark, sf_dir).select("doc_id", "text")
    return _vector_rows(embed_column(docs, "text", fake_client(4), "vector"), "vector")


@query
def token_count_words(spark, sf_dir):
    return _by_document(spark, sf_dir, tokens=token_count("text"))


@query
def token_count_regex(spark, sf_dir):
    return _by_document(spark, sf_dir, tokens=token_count("text", "regex:[A-Za-z]+|[0-9]"))


@query
def token_count_service(spark, sf_dir):
    return _by_document(spark, sf_dir, tokens=token_count("text", lambda endpoint: _count_characters))


def _count_characters(texts: list[str]) -> list[int]:
    return [len(text) for text in texts]


def _busy_at_first(endpoint: str):
    """A counter that is unavailable for the first call of each task."""
    calls = []

    def count(texts: list[str]) -> list[int]:
        calls.append(len(texts))
        if len(calls) == 1:
            raise TransientError("busy")
        return _count_characters(texts)

    return count


@query
def token_count_retried(spark, sf_dir):
    counted = token_count("text", _busy_at_first, retry=NO_WAIT, call_size=7, max_in_flight=4)
    return _by_document(spark, sf_dir, tokens=counted)


@query
def chunks_by_regex(spark, sf_dir):
    tokenizer = r"regex:[[:alpha:]]+|[0-9]"
    chunks = chunk_documents(spread_documents(spark, sf_dir), "text", ["doc_id"], 60, tokenizer)
    return chunks.withColumn("counted", token_count("text", tokenizer))


@query
def document_chunks(spark, sf_dir):
    return chunk_documents(spread_documents(spark, sf_dir), "text", ["doc_id"], 100)


@query
def conversation_chunks(spark, sf_dir):
    turns = spread(table(spark, sf_dir, "conversations"))
    return chunk_documents(turns, "text", ["conv_id", "turn"], 20)


# --- HTML ---------------------------------------------------------------------------------


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"))


@query
def html_raw(spark, sf_dir):
    return extract_html(pages(spark, sf_dir), "html", ["page_id"], "raw")


@query
def heading_context_rows(spark, sf_dir):
    """The context that extraction gives, worked out again over its exploded rows."""
    rows = html_raw(spark, sf_dir).drop("h1", "h2", "h3", "h4", "h5", "h6")
    level = F.try_element_at(F.regexp_extract_all("element_type", F.lit("^h([1-6])$")), F.lit(1))
    return heading_context(rows, ["page_id"], "position", level.cast("int"), F.col("text"))


@query
def semantic_pack_lines(spark, sf_dir):
    return pack_lines(text_lines(spark, sf_dir), ["doc_id"], "line_no", "line", 10, 50)


@query
def semantic_pack_elements(spark, sf_dir):
    """Chunks with their headings from a table of elements, as extraction makes them from pages."""
    rows = html_raw(spark, sf_dir).where("element_type = 'p'")
    headings = ["h1", "h2", "h3", "h4", "h5", "h6"]
    return pack_lines(rows, ["page_id"], "position", "text", context=headings).withColumn("error", F.lit(""))


@query
def html_raw_unfiltered(spark, sf_dir):
    config = '{"mode": "elements", "filters": {"enabled": false}}'
    return extract_html(pages(spark, sf_dir), "html", ["page_id"], config)


@query
def html_paragraph(spark, sf_dir):
    return extract_html(pages(spark, sf_dir), "html", ["page_id"], "paragraph")


@query
def html_semantic(spark, sf_dir):
    return extract_html(pages(spark, sf_dir), "html", ["page_id"])


@query
def html_semantic_small(spark, sf_dir):
    config = {"mode": "rag", "min_words": 0, "max_words": 40, "filters": {"min_words": 3}}
    return extract_html(pages(spark, sf_dir), "html", ["page_id"], config)


def _marked() -> Column:
    classes = F.element_at(
        F.array(*map(F.lit, ["body", "text NavBar-left", "site-Footer wide"])),
        (F.col("page_id") % 3 + 1).cast("int"),
    )
    return F.replace("html", F.lit("<p>"), F.concat(F.lit('<p class="'), classes, F.lit('">')))


@query
def html_class_filter(spark, sf_dir):
    config = '{"mode": "raw", "filters": {"skip_classes": ["navbar", "FOOTER"], "min_words": 5}}'
    return extract_html(
        pages(spark, sf_dir).select("page_id", _marked().alias("html")), "html", ["page_id"], config
    )


CONFIGS = [
    None,
    '{"mode": "raw", "filters": {"skip_classes": ["navbar", "FOOTER"], "min_words": 5}}',
    "nlp",
    '{"min_words": 0, "max_words": 40, "filters": {"skip_classes": [], "min_words": 3}}',
    '{"mode": "elements", "filters": {"enabled": false}, "min_words": "many"}',
]


def _configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = F.get(F.array(*map(F.lit, CONFIGS)), (F.col("page_id") % len(CONFIGS)).cast("int"))
    return pages(spark, sf_dir).select("page_id", _marked().alias("html"), config.alias("config"))


@query
def html_config_per_row(spark, sf_dir):
    return extract_html_per_row(_configured(spark, sf_dir), "html", "config", ["page_id"])


@query
def html_guards(spark, sf_dir):
    return extract_html(table(spark, sf_dir, "pages"), "url", ["page_id"], "paragraph")


def _deeper_headings(parts: Column) -> Column:
    """Every third ``<p>`` of a page that has an end becomes a heading of level 2 to 6."""

    def part(text: Column, place: Column) -> Column:
        level = ((F.col("page_id") + place) % 5 + 2).cast("string")
        heading = F.concat(F.lit("<h"), level, F.lit(">"), F.replace(text, F.lit("</p>"), F.concat(F.lit("</h"), level, F.lit(">"))))
        chosen = (place % 3 == 1) & F.contains(text, F.lit("</p>"))
        return F.when(place == 0, text).when(chosen, heading).otherwise(F.concat(F.lit("<p>"), text))

    return F.array_join(F.transform(parts, part), "")


def _leveled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = _deeper_headings(F.split("html", "<p>"))
    return pages(spark, sf_dir).select("page_id", html.alias("html"))


@query
def html_heading_levels(spark, sf_dir):
    return extract_html(_leveled_pages(spark, sf_dir), "html", ["page_id"], "raw")


@query
def html_heading_levels_semantic(spark, sf_dir):
    return extract_html(_leveled_pages(spark, sf_dir), "html", ["page_id"])


@query
def html_size_guard(spark, sf_dir):
    return extract_html(pages(spark, sf_dir), "html", ["page_id"], "paragraph", max_bytes=4000)


# --- language -----------------------------------------------------------------------------


@query
def language_profiles(spark, sf_dir):
    return train_language_profiles(spread_documents(spark, sf_dir), "text", "lang")


@query
def detected_languages(spark, sf_dir):
    docs = spread_documents(spark, sf_dir)
    profiles = train_language_profiles(docs, "text", "lang")
    found = detect_language(docs.select("doc_id", "lang", "text"), "text", profiles)
    return found.select(
        "doc_id", "lang", "detected_lang", F.round("confidence", 6).alias("confidence"), "reliable"
    )


@query
def detected_many_languages(spark, sf_dir):
    label = F.concat("lang", F.lit("-"), F.col("doc_id") % 300)
    docs = spread_documents(spark, sf_dir).withColumn("label", label)
    profiles = train_language_profiles(docs, "text", "label")
    found = detect_language(docs.select("doc_id", "label", "text"), "text", profiles)
    return found.select(
        "doc_id", "label", "detected_lang", F.round("confidence", 6).alias("confidence"), "reliable"
    )


@query
def english_turns(spark, sf_dir):
    profiles = train_language_profiles(spread_documents(spark, sf_dir), "text", "lang")
    turns = spread(table(spark, sf_dir, "conversations"))
    return turns.select("conv_id", "turn", is_english("text", profiles).alias("english"))


# --- HTTP ---------------------------------------------------------------------------------


@query
def batch_payloads(spark, sf_dir):
    bodies = batch_bodies(table(spark, sf_dir, "events"), "props", ["event_id"], 100, unique=True)
    joined = F.array_join(F.from_json("body", "array<string>"), "|")
    return bodies.select("batch_id", "row_count", F.md5(joined).alias("digest"))


def _answer_batch(request: Request) -> Response:
    """Unreachable for some batches, busy at first for all others."""
    joined = "|".join(json.loads(request.body))
    if len(joined) % 7 == 0:
        raise ConnectionError("refused")
    if request.attempt == 0:
        return Response(503, "busy")
    return Response(200, hashlib.md5(joined.encode()).hexdigest())


@query
def batch_outcomes(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return post_batches(
        events, "props", ["ts", "event_id"], SERVICE, "64", '{"X-Run": "1"}',
        transport=_answer_batch, retry=NO_WAIT, unique=True,
    )


def _answer_row(request: Request) -> Response:
    """The last digit of the body decides: answer, busy once, broken, unreachable, not found."""
    kind = int(request.body[-1])
    if kind == 6 and request.attempt == 0:
        return Response(429, "busy")
    if kind == 7:
        return Response(500, f"attempt {request.attempt}")
    if kind == 8:
        raise ConnectionError("refused")
    status = 404 if kind == 9 else 200
    return Response(status, f"attempt {request.attempt}", (("X-Body", request.body), ("X-N", "1")))


@query
def post_outcomes(spark, sf_dir):
    bodies = spread(table(spark, sf_dir, "events")).select(
        "event_id", F.col("event_id").cast("string").alias("body")
    )
    posted = post_rows(
        bodies, SERVICE, "body", transport=_answer_row, retry=NO_WAIT, on_error="row"
    )
    response = F.col("response")
    return posted.select(
        "event_id",
        response.status_code.alias("status_code"),
        response.body.alias("response_body"),
        F.try_element_at(response_headers(response.headers), F.lit("x-body")).alias("echo"),
    )


@query
def post_scripted(spark, sf_dir):
    events = spread(table(spark, sf_dir, "events").select("event_id", "event_type"))
    scripted = transform_text(events, "event_type", "upper(text)", "body")
    headers = F.to_json(F.struct(F.col("event_type").alias("X-Type")))
    posted = post_rows(scripted, SERVICE, "body", headers=headers, transport=_echo)
    return posted.select("event_id", F.col("response.body").alias("response_body"))


def _echo(request: Request) -> Response:
    return Response(200, f"{request.body} {request.headers['X-Type']}")


def _echo_key(request: Request) -> Response:
    cookies = (("Set-Cookie", request.body), ("set-cookie", request.headers["Idempotency-Key"]))
    return Response(200, request.headers["Idempotency-Key"], cookies)


@query
def post_keys(spark, sf_dir):
    events = spread(table(spark, sf_dir, "events").select("event_id", "event_type"))
    posted = post_rows(events, SERVICE, "event_type", transport=_echo_key, key_col="event_id")
    return posted.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("response.body").alias("keys")
    )


@query
def post_repeated_headers(spark, sf_dir):
    events = spread(table(spark, sf_dir, "events").select("event_id", "event_type"))
    posted = post_rows(events, SERVICE, "event_type", transport=_echo_key, key_col="event_id")
    cookies = F.try_element_at(response_headers("response.headers"), F.lit("set-cookie"))
    return posted.select("event_id", cookies.alias("cookies"))


def _echo_url(request: Request) -> Response:
    if request.attempt == 0 and len(request.body) % 3 == 0:
        return Response(503, "busy")
    return Response(200, f"{request.headers['Idempotency-Key']} {request.body} after {request.attempt}")


@query
def post_by_host(spark, sf_dir):
    """Every page's address to its host, which gets at most two requests at once."""
    urls = spread(table(spark, sf_dir, "pages").select("page_id", "url"))
    posted = post_in_lanes(urls, F.col("url"), "url", per_host=2, transport=_echo_url, retry=NO_WAIT, key_col="page_id")
    response = F.col("response")
    return posted.select(
        "page_id", host_of("url").alias("host"), response.status_code.alias("status_code"), response.body.alias("response_body")
    )


@query
def stream_post_batches(spark, sf_dir):
    """Events as a stream, posted in batches with a ledger of answers."""
    path = f"{sf_dir}/events.parquet"
    # a pattern names a single file as well as a folder of files
    events = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path + "*")
    outcomes, checkpoint, ledger = (new_folder(spark, label) for label in ("outcomes", "stream", "ledger"))
    writer = post_batches_stream(
        events, "props", ["ts", "event_id"], SERVICE, 64, outcomes, checkpoint, ledger,
        transport=_answer_batch, retry=NO_WAIT, tasks=int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(outcomes).select("batch_id", "row_count", "status_code", "response_body")


@query
def payload_lines(spark, sf_dir):
    """Events to files of one payload a line, and those to batches."""
    folder = new_folder(spark, "payloads")
    events = table(spark, sf_dir, "events").orderBy("event_id")
    events.select(F.concat_ws("\t", "event_id", "props")).write.text(folder)
    event_id = F.substring_index("payload", "\t", 1).cast("long")
    lines = payloads_from_lines(spark, folder).withColumn("event_id", event_id)
    bodies = batch_bodies(lines, "payload", ["event_id"], 50, unique=True)
    joined = F.array_join(F.from_json("body", "array<string>"), "|")
    return bodies.select("batch_id", "row_count", F.md5(joined).alias("digest"))


def _as_array(batches):
    """The rows of a task as the lines of one JSON array."""
    start = "["
    for batch in batches:
        values = batch.column("value").to_pylist()
        if values:
            yield pa.record_batch([pa.array([start + values[0], *("," + v for v in values[1:])])], names=["value"])
            start = ","
    yield pa.record_batch([pa.array(["[]" if start == "[" else "]"])], names=["value"])


@query
def payload_array_file(spark, sf_dir):
    """Events to files that hold one JSON array each, a file for each sorted part, and those to batches."""
    folder = new_folder(spark, "array")
    events = table(spark, sf_dir, "events").orderBy("event_id")
    lines = events.select(F.to_json(F.struct("props", "event_type", "event_id")).alias("value"))
    lines.mapInArrow(_as_array, "value string").write.text(folder)
    event_id = F.get_json_object("payload", "$.event_id").cast("long")
    payloads = payloads_from_file(spark, folder).withColumn("event_id", event_id)
    bodies = batch_bodies(payloads, "payload", ["event_id"], 100, unique=True)
    joined = F.array_join(F.from_json("body", "array<string>"), "|")
    return bodies.select("batch_id", "row_count", F.md5(joined).alias("digest"))


# --- objects ------------------------------------------------------------------------------


def _object_root(spark: SparkSession) -> str:
    root = new_folder(spark, "objects")
    path = root.removeprefix("file:")
    return root if path == root and not root.startswith("/") else "file:///" + path.lstrip("/")


# a folder of a file system takes one new object at a time, so the documents go into many
OBJECT_FOLDERS = 256


def _stored(spark: SparkSession, sf_dir: str, content: str, root: str | None = None) -> DataFrame:
    """(doc_id, path) after every document was written as one object in a folder below ``root``."""
    root = root or _object_root(spark)
    path = F.concat(F.lit(root + "/"), F.pmod("doc_id", F.lit(OBJECT_FOLDERS)), F.lit("/"), "doc_id", F.lit(".txt"))
    docs = spread_documents(spark, sf_dir).select("doc_id", path.alias("path"), F.col(content).alias("content"))
    write_objects(docs, "path", "content").write.format("noop").mode("overwrite").save()
    return docs.select("doc_id", "path")


@query
def objects_roundtrip(spark, sf_dir):
    stored = _stored(spark, sf_dir, "text")
    return fetch_objects(stored, "path", "text").select("doc_id", "text")


@query
def embed_fetched_texts(spark, sf_dir):
    fetched = fetch_objects(_stored(spark, sf_dir, "text"), "path", "text").select("doc_id", "text")
    return _vector_rows(embed_column(fetched, "text", fake_client(4), "vector", dedupe="global"), "vector")


@query
def objects_scan(spark, sf_dir):
    root = _object_root(spark)
    _stored(spark, sf_dir, "text", root)
    found = read_objects(spark, root, "*.txt")
    doc_id = F.regexp_extract("path", r"([0-9]+)\.txt$", 1).cast("long")
    return found.select(doc_id.alias("doc_id"), F.col("content").alias("text"))


@query
def objects_probe(spark, sf_dir):
    stored = _stored(spark, sf_dir, "lang")
    absent = F.replace("path", F.lit(".txt"), F.lit(".gone"))
    both = stored.select(
        "doc_id", F.explode(F.array("path", absent)).alias("path")
    ).withColumn("suffix", F.regexp_extract("path", r"\.(\w+)$", 1))
    return objects_exist(both, "path").select("doc_id", "suffix", "found")


@query
def objects_probe_listing(spark, sf_dir):
    """Objects written into folders by language, asked for by one listing a folder."""
    root = _object_root(spark)
    language = F.coalesce("lang", F.lit("none"))
    docs = spread_documents(spark, sf_dir).select("doc_id", language.alias("lang"))
    path = F.concat(F.lit(root + "/"), "lang", F.lit("/"), "doc_id", F.lit(".txt"))
    docs = docs.withColumn("path", path)
    write_objects(docs, "path", "lang").write.format("noop").mode("overwrite").save()
    absent = F.replace("path", F.lit(".txt"), F.lit(".gone"))
    elsewhere = F.replace("path", F.concat(F.lit("/"), "lang", F.lit("/")), F.lit("/no such folder/"))
    asked = docs.select("doc_id", F.explode(F.map_from_arrays(
        F.array(F.lit("here"), F.lit("gone"), F.lit("elsewhere")), F.array("path", absent, elsewhere)
    )).alias("kind", "path"))
    return objects_exist_by_listing(asked, "path").select("doc_id", "kind", "found")


# far less than most documents have
LINE_RANGE = 1 << 12


@query
def object_lines(spark, sf_dir):
    """The lines of every document, read from an object by ranges."""
    stored = _stored(spark, sf_dir, "text")
    found = read_lines(stored, "path", range_bytes=LINE_RANGE)
    return found.select("doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


@query
def objects_transformed(spark, sf_dir):
    stored = _stored(spark, sf_dir, "text")
    mode = F.when(F.col("doc_id") % 2 == 0, "lower").otherwise("oneline")
    one_line = fetch_stripped(stored, "path", "one_line")
    return fetch_with_mode(one_line, "path", mode, "by_mode").select("doc_id", "one_line", "by_mode")


@query
def objects_scripted(spark, sf_dir):
    stored = _stored(spark, sf_dir, "text")
    return fetch_with_script(stored, "path", "take_lines(text, 1)").select("doc_id", "content")


@query
def object_paths(spark, sf_dir):
    parsed = table(spark, sf_dir, "pages").select("page_id", parse_path("url").alias("p"))
    return parsed.select("page_id", "p.scheme", "p.bucket", "p.key")


# --- SQL names ----------------------------------------------------------------------------


def _spread_rows(spark: SparkSession, sf_dir: str, function: str) -> DataFrame:
    register_functions(spark)
    return spark.sql(
        f"SELECT page_id, e.* FROM (SELECT page_id, {function}(html) AS rows FROM {{pages}}), "
        "LATERAL inline(rows) AS e",
        pages=pages(spark, sf_dir),
    )


@query
def sql_html_paragraph(spark, sf_dir):
    return _spread_rows(spark, sf_dir, "html_paragraphs")


@query
def sql_html_semantic(spark, sf_dir):
    return _spread_rows(spark, sf_dir, "html_chunks")


@query
def sql_html_raw(spark, sf_dir):
    return _spread_rows(spark, sf_dir, "html_raw")


@query
def sql_html_extract_config(spark, sf_dir):
    register_functions(spark)
    return spark.sql(
        "SELECT page_id, e.* FROM (SELECT page_id, html_extract(html, config) AS rows FROM {pages}), "
        "LATERAL inline(rows) AS e",
        pages=_configured(spark, sf_dir),
    )


@query
def sql_text_functions(spark, sf_dir):
    register_functions(spark)
    return spark.sql(
        "SELECT doc_id, squeeze_whitespace(regex_replace(text, '[0-9]+', 'NUM')) AS squeezed, "
        "text_mode(text, 'lower') AS lowered, skip_lines(text, 2) AS rest, "
        "token_count(text) AS tokens, round(embed_fake(text, 2)[1], 6) AS value FROM {documents}",
        documents=spread_documents(spark, sf_dir),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to heading-aware chunks with their token counts and stand-in vectors."""
    chunks = extract_html(pages(spark, sf_dir), "html", ["page_id"])
    return chunks.withColumn("tokens", token_count("text")).withColumn(
        "vector", embed_fake("text", 16)
    )
