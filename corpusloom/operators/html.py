"""HTML extraction over tables of pages.

One Arrow function scans a page for headings and paragraphs; filtering, chunking and the
layout of the rows are column expressions over the scanned array. The whole operator is
narrow: no shuffle, one row in, its chunks out, whatever the size of the table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache, reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from corpusloom.functions.markup import page_elements, with_headings
from corpusloom.functions.text import SQL_FUNCTIONS, _runs_of_texts, as_column, trim_text

# Size guard, filter defaults, chunk defaults and mode names.
MAX_HTML_BYTES = 50 * 1024 * 1024
# pages scanned at once
SCAN_BYTES = 2 << 20
SKIP_CLASSES = (
    "nav", "navbar", "navigation", "menu", "sidebar", "sidenav",
    "footer", "copyright", "breadcrumb", "header", "advertisement",
)
MIN_PARAGRAPH_WORDS = 10
MIN_CHUNK_WORDS = 100
MAX_CHUNK_WORDS = 500
MODE_NAMES = {
    "semantic": ("semantic", "rag"),
    "paragraph": ("paragraph", "nlp"),
    "raw": ("raw", "elements"),
}

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

_TEXTS = [StructField(h, StringType()) for h in HEADINGS]
ELEMENT = StructType(
    [
        StructField("element_type", StringType()),
        StructField("text", StringType()),
        StructField("word_count", IntegerType()),
        *_TEXTS,
        StructField("classes", StringType()),
    ]
)
BOUND = StructType(
    [
        StructField("start", IntegerType()),
        StructField("size", IntegerType()),
        StructField("words", IntegerType()),
    ]
)
CONFIG = StructType(
    [
        StructField("mode", StringType()),
        StructField("min_words", LongType()),
        StructField("max_words", LongType()),
        StructField("filtered", BooleanType()),
        StructField("skip", ArrayType(StringType())),
        StructField("min_paragraph", LongType()),
    ]
)
# rows of any mode; element_type and classes are of elements, paragraph_count is of chunks
ROW = StructType(
    [
        StructField("mode", StringType()),
        StructField("position", IntegerType()),
        StructField("element_type", StringType()),
        StructField("text", StringType()),
        StructField("word_count", IntegerType()),
        *_TEXTS,
        StructField("classes", StringType()),
        StructField("paragraph_count", IntegerType()),
        StructField("error", StringType()),
    ]
)


def _count(value: Any, default: int) -> int:
    """A JSON count: whole and not negative, else the default."""
    whole = isinstance(value, int) and not isinstance(value, bool) and value >= 0
    return value if whole else default


def mode_named(name: Any) -> str:
    """The mode a name stands for; unknown names mean ``semantic``."""
    wanted = str(name).lower()
    return next((m for m, names in MODE_NAMES.items() if wanted in names), "semantic")


@dataclass(frozen=True)
class ExtractConfig:
    mode: str = "semantic"
    min_words: int = MIN_CHUNK_WORDS
    max_words: int = MAX_CHUNK_WORDS
    filter_enabled: bool = True
    skip_classes: Sequence[str] = field(default=SKIP_CLASSES)
    filter_min_words: int = MIN_PARAGRAPH_WORDS

    @classmethod
    def from_any(cls, config: ExtractConfig | dict | str | None) -> ExtractConfig:
        """Read a config object, a JSON text or a mode name; nothing means the defaults.

        Values of a wrong type fall back to their defaults, malformed JSON raises.
        """
        if isinstance(config, cls):
            return config
        if config is None or config in ("", "NULL"):
            return cls()
        if isinstance(config, str):
            if not config.startswith("{"):
                return cls(mode=mode_named(config))
            try:
                config = json.loads(config)
            except json.JSONDecodeError as error:
                raise ValueError(f"Invalid config JSON: {error}") from error
        mode = config.get("mode")
        filters = config.get("filters", {})
        filters = filters if isinstance(filters, dict) else {}
        enabled, skip = filters.get("enabled"), filters.get("skip_classes")
        return cls(
            mode=mode_named(mode) if isinstance(mode, str) else "semantic",
            min_words=_count(config.get("min_words"), MIN_CHUNK_WORDS),
            max_words=_count(config.get("max_words"), MAX_CHUNK_WORDS),
            filter_enabled=enabled if isinstance(enabled, bool) else True,
            skip_classes=tuple(s for s in skip if isinstance(s, str))
            if isinstance(skip, (list, tuple))
            else SKIP_CLASSES,
            filter_min_words=_count(filters.get("min_words"), MIN_PARAGRAPH_WORDS),
        )


def elements_udf():
    """The Arrow function behind :func:`html_elements`."""
    arrow_fields = [
        pa.field(f.name, pa.int32() if isinstance(f.dataType, IntegerType) else pa.string())
        for f in ELEMENT
    ]

    def elements(pages: pa.Array) -> pa.Array:
        rows, offsets, missing = [], [0], []
        for page in pages.to_pylist():
            missing.append(page is None)
            if page is not None:
                rows.extend(with_headings(page_elements(page)))
            offsets.append(len(rows))
        columns = list(zip(*rows)) if rows else [()] * len(arrow_fields)
        struct = pa.StructArray.from_arrays(
            [pa.array(values, f.type) for values, f in zip(columns, arrow_fields)],
            fields=arrow_fields,
        )
        return pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), struct, mask=pa.array(missing) if any(missing) else None
        )

    @F.arrow_udf(ArrayType(ELEMENT))
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            # elements as Python values take many times the page, so a few pages at a time
            for some in _runs_of_texts(pages, SCAN_BYTES):
                yield elements(some)

    return scan


def html_elements(html: Column | str) -> Column:
    """All headings and paragraphs of a page as an array in document order."""
    return elements_udf()(as_column(html))


def skip_pattern(skip_classes: Sequence[str]) -> str | None:
    """A pattern for class attributes in lower case with a token that contains a skip word.

    Tokens hold no white space, so a word without white space is looked for in the whole
    attribute, one with any never matches.
    """
    words = [w.lower() for w in skip_classes if w and not re.search(r"\s", w)]
    patterns = [re.escape(w) for w in words] + [r"\S" for w in skip_classes if w == ""]
    return "(?U)" + "|".join(patterns) if patterns else None


def _has_skipped_class(classes: Column, skip_classes: Sequence[str]) -> Column:
    pattern = skip_pattern(skip_classes)
    return F.lit(False) if pattern is None else (classes != "") & F.lower(classes).rlike(pattern)


def is_kept(element: Column, config: ExtractConfig) -> Column:
    """False for a paragraph the filter rejects; headings always stay."""
    if not config.filter_enabled:
        return F.lit(True)
    return (element.element_type != "p") | (
        (element.word_count >= config.filter_min_words)
        & ~_has_skipped_class(element.classes, config.skip_classes)
    )


def chunk_bounds(counts: list[int], min_words: int, max_words: int) -> list[tuple[int, int, int]]:
    """(start, size, words) of greedily filled chunks; a wordless tail is no chunk."""
    bounds, start, words = [], 0, 0
    for index, count in enumerate(counts):
        if words + count > max_words and words >= min_words:
            bounds.append((start, index - start, words))
            start, words = index, 0
        words += count
    if words:
        bounds.append((start, len(counts) - start, words))
    return bounds


def pack_udf():
    """The Arrow function behind :func:`pack_bounds`."""

    @F.arrow_udf(ArrayType(BOUND))
    def pack(lists: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:
        flat = lists.values.to_numpy(zero_copy_only=False)
        starts = lists.offsets.to_numpy()
        limits = zip(low.to_pylist(), high.to_pylist())
        packed = [
            None if not lists[i].is_valid else chunk_bounds(
                flat[starts[i] : starts[i + 1]].tolist(), *limit
            )
            for i, limit in enumerate(limits)
        ]
        kind = pa.list_(pa.struct([(f.name, pa.int32()) for f in BOUND]))
        names = [f.name for f in BOUND]
        return pa.array(
            [None if b is None else [dict(zip(names, x)) for x in b] for b in packed], kind
        )

    # not deterministic for the optimizer: it would run the scan again to drop pages without chunks
    return pack.asNondeterministic()


def pack_bounds(word_counts: Column, min_words: int, max_words: int) -> Column:
    """Where chunks start when pieces are packed in order.

    A chunk closes before a piece that would take it over ``max_words``, once it has
    ``min_words``. The scan over counts is linear; a fold in SQL would copy its result list
    at every step.
    """
    return pack_udf()(word_counts, F.lit(min_words), F.lit(max_words))


# Addresses that are no pages, and messages.
URL_STARTS = ("s3://", "http://", "https://")
URL_ERROR = "extract_html expects HTML content, not URL. Fetch the object first."


def size_error(size: str, max_bytes: int) -> str:
    return f"Document too large: {size} bytes (max {max_bytes}). Split into chapters."


def _guard(html: Column, max_bytes: int) -> Column:
    """A message for input that must not be parsed, else NULL."""
    size = F.octet_length(html)
    is_url = reduce(Column.__or__, [html.startswith(start) for start in URL_STARTS])
    return F.when(
        size > max_bytes, F.format_string(size_error("%d", max_bytes), size)
    ).when(is_url, F.lit(URL_ERROR))


def _row(**values: Column) -> Column:
    return F.struct(*[value.alias(name) for name, value in values.items()])


def _no_headings() -> dict[str, Column]:
    return {h: F.lit("") for h in HEADINGS}


def extract_html(
    df: DataFrame,
    html_col: str,
    keys: Sequence[str] = (),
    config: ExtractConfig | dict | str | None = None,
    max_bytes: int = MAX_HTML_BYTES,
) -> DataFrame:
    """Rows of ``keys`` plus chunks (modes semantic, paragraph) or elements (mode raw).

    Input over ``max_bytes`` or naming a URL gives one row with the reason in ``error``.
    A NULL page gives no rows.
    """
    config = ExtractConfig.from_any(config)
    names = list(keys)
    source = df.select(
        *[F.col(f"`{k}`") for k in names],
        _guard(F.col(f"`{html_col}`"), max_bytes).alias("__error"),
        F.col(f"`{html_col}`").alias("__html"),
    )
    scanned = source.select(
        *names,
        "__error",
        html_elements(F.when(F.col("__error").isNull(), F.col("__html"))).alias("__elements"),
    )
    if config.mode == "raw":
        blank = dict(
            element_type=F.lit(""), text=F.lit(""), word_count=F.lit(0), **_no_headings(),
            classes=F.lit(""),
        )
        kept = F.filter("__elements", lambda e: is_kept(e, config))
        items = F.when(F.col("__error").isNull(), kept).otherwise(F.array(_row(**blank)))
        rows = scanned.select(*names, "__error", F.posexplode(items).alias("position", "__e"))
        return rows.select(
            *names, "position", *[F.col(f"__e.{f.name}") for f in ELEMENT],
            F.coalesce("__error", F.lit("")).alias("error"),
        )

    paragraphs = F.filter("__elements", lambda e: (e.element_type == "p") & is_kept(e, config))
    if config.mode == "paragraph":
        blank = dict(
            element_type=F.lit(""), text=F.lit(""), word_count=F.lit(0), **_no_headings(),
            classes=F.lit(""),
        )
        items = F.when(F.col("__error").isNull(), paragraphs).otherwise(F.array(_row(**blank)))
        rows = scanned.select(*names, "__error", F.posexplode(items).alias("chunk_id", "__e"))
        return rows.select(
            *names, "chunk_id", "__e.text", *[F.col(f"__e.{h}") for h in HEADINGS],
            "__e.word_count",
            F.when(F.col("__error").isNull(), F.lit(1)).otherwise(F.lit(0)).alias("paragraph_count"),
            F.coalesce("__error", F.lit("")).alias("error"),
        )

    packed = scanned.select(*names, "__error", paragraphs.alias("__paragraphs")).select(
        *names,
        "__error",
        "__paragraphs",
        pack_bounds(
            F.transform("__paragraphs", lambda p: p.word_count), config.min_words, config.max_words
        ).alias("__bounds"),
    )
    pieces = F.col("__paragraphs")

    def first(bound: Column, name: str) -> Column:
        inside = F.when(bound.size > 0, F.get(pieces, bound.start)[name])
        return F.coalesce(inside, F.lit(""))

    chunks = F.transform(
        "__bounds",
        lambda b: _row(
            text=trim_text(
                F.array_join(
                    F.transform(F.slice(pieces, b.start + 1, b.size), lambda p: p.text), "\n\n"
                )
            ),
            **{h: first(b, h) for h in HEADINGS},
            word_count=b.words,
            paragraph_count=b.size,
        ),
    )
    blank = dict(
        text=F.lit(""), **_no_headings(), word_count=F.lit(0), paragraph_count=F.lit(0)
    )
    items = F.when(F.col("__error").isNull(), chunks).otherwise(F.array(_row(**blank)))
    rows = packed.select(*names, "__error", F.posexplode(items).alias("chunk_id", "__c"))
    return rows.select(
        *names, "chunk_id", "__c.text", *[F.col(f"__c.{h}") for h in HEADINGS],
        "__c.word_count", "__c.paragraph_count",
        F.coalesce("__error", F.lit("")).alias("error"),
    )


# --- a config for each row ----------------------------------------------------------------

_LONGEST = (1 << 62) - 1


@lru_cache(maxsize=1024)
def _config_values(text: str | None) -> dict[str, Any]:
    config = ExtractConfig.from_any(text)
    return {
        "mode": config.mode,
        "min_words": min(config.min_words, _LONGEST),
        "max_words": min(config.max_words, _LONGEST),
        "filtered": config.filter_enabled,
        "skip": [w.lower() for w in config.skip_classes if not re.search(r"\s", w)],
        "min_paragraph": min(config.filter_min_words, _LONGEST),
    }


def config_udf():
    """The Arrow function from a config text or mode name to its values."""
    types = {LongType(): pa.int64(), StringType(): pa.string(), BooleanType(): pa.bool_()}
    kind = pa.struct([(f.name, types.get(f.dataType, pa.list_(pa.string()))) for f in CONFIG])

    @F.arrow_udf(CONFIG)
    def parse(configs: pa.Array) -> pa.Array:
        return pa.array([_config_values(text) for text in configs.to_pylist()], kind)

    # not deterministic for the optimizer: merged into the steps after it, it would stand in their lambdas
    return parse.asNondeterministic()


def kept_sql(elements: str, config: str) -> str:
    """SQL for the elements that a row's config keeps; headings stay in mode raw only."""
    skipped = (
        f"e.classes RLIKE '(?U)\\\\S' AND exists({config}.skip, w -> contains(lower(e.classes), w))"
    )
    return (
        f"filter({elements}, e -> CASE WHEN e.element_type <> 'p' THEN {config}.mode = 'raw' "
        f"ELSE NOT {config}.filtered OR (e.word_count >= {config}.min_paragraph AND NOT ({skipped})) END)"
    )


def row_sql(**values: str) -> str:
    """SQL for a row of :data:`ROW`; fields without a value are empty headings or NULL."""
    empty = {h: "''" for h in HEADINGS} | {"error": "''"}
    fields = (
        f"'{f.name}', CAST({values.get(f.name) or empty.get(f.name, 'NULL')} AS {f.dataType.simpleString()})"
        for f in ROW
    )
    return f"named_struct({', '.join(fields)})"


def rows_sql(kept: str, bounds: str, mode: str) -> str:
    """SQL for a page's rows from its kept elements and, in mode semantic, where chunks start."""
    named = dict(mode=mode, position="i", text="e.text", word_count="e.word_count")
    headings = {h: f"e.{h}" for h in HEADINGS}
    element = row_sql(**named, **headings, element_type="e.element_type", classes="e.classes")
    paragraph = row_sql(**named, **headings, paragraph_count="1")
    joined = f"array_join(transform(slice({kept}, b.start + 1, b.size), e -> e.text), '\\n\\n')"
    chunk = row_sql(
        mode=mode, position="i",
        text=SQL_FUNCTIONS["trim_text"][2].replace("FROM text", f"FROM {joined}"),
        word_count="b.words", paragraph_count="b.size",
        **{h: f"coalesce(CASE WHEN b.size > 0 THEN get({kept}, b.start).{h} END, '')" for h in HEADINGS},
    )
    return (
        f"CASE {mode} WHEN 'raw' THEN transform({kept}, (e, i) -> {element}) "
        f"WHEN 'paragraph' THEN transform({kept}, (e, i) -> {paragraph}) "
        f"ELSE transform({bounds}, (b, i) -> {chunk}) END"
    )


def error_sql(mode: str, error: str) -> str:
    """SQL for the one row of a page that must not be parsed."""
    element = f"CASE WHEN {mode} = 'raw' THEN '' END"
    chunk = f"CASE WHEN {mode} <> 'raw' THEN 0 END"
    row = row_sql(
        mode=mode, position="0", text="''", word_count="0", element_type=element, classes=element,
        paragraph_count=chunk, error=error,
    )
    return f"array({row})"


def extract_html_per_row(
    df: DataFrame,
    html_col: str,
    config_col: str,
    keys: Sequence[str] = (),
    max_bytes: int = MAX_HTML_BYTES,
) -> DataFrame:
    """As :func:`extract_html`, by the config (JSON or a mode name) that each row holds.

    Rows of all modes have the columns of :data:`ROW`: ``mode`` names the row's mode, ``position``
    its place in the page. A NULL or empty config means the defaults, malformed JSON fails, a NULL
    page gives no rows. There is no shuffle.
    """
    names = [F.col(f"`{k}`") for k in keys]
    html = F.col(f"`{html_col}`")
    error = _guard(html, max_bytes)
    scan = elements_udf().asNondeterministic()  # for the reason given in config_udf
    scanned = df.select(
        *names,
        error.alias("__error"),
        scan(F.when(error.isNull(), html)).alias("__elements"),
        config_udf()(F.col(f"`{config_col}`").cast("string")).alias("__config"),
    )
    kept = scanned.select(
        *names, "__error", "__config", F.expr(kept_sql("__elements", "__config")).alias("__kept")
    )
    counts = F.when(
        F.col("__config.mode") == "semantic", F.transform("__kept", lambda e: e.word_count)
    )
    packed = kept.withColumn(
        "__bounds", pack_udf()(counts, F.col("__config.min_words"), F.col("__config.max_words"))
    )
    found = F.when(
        F.col("__error").isNull(), F.expr(rows_sql("__kept", "__bounds", "__config.mode"))
    ).otherwise(F.expr(error_sql("__config.mode", "__error")))
    return packed.select(*names, F.inline(found))
