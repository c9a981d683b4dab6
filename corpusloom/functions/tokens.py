"""Counting tokens and splitting texts to a token budget."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from corpusloom.functions.markup import words_in
from corpusloom.functions.retry import (
    CALL_TEXTS,
    DEFAULT_IN_FLIGHT,
    NO_RETRY,
    TOKEN_RETRY,
    Clients,
    InFlight,
    RetryPolicy,
    ask_all,
    rows_by_endpoint,
)
from corpusloom.functions.text import (
    as_column,
    fill_nulls,
    java_pattern,
    library_pattern,
    word_count,
)

# A counter takes a list of texts and returns their token counts in the same order.
Counter = Callable[[list[str]], list[int]]
# A factory makes a counter for an endpoint inside the Python worker, once per task.
CounterFactory = Callable[[str], Counter]
Tokenizer = str | CounterFactory

_SENTENCE_END = re.compile(rb"[.!?]")


def _local_counter(tokenizer: Tokenizer) -> tuple[CounterFactory, bool]:
    """The counter factory for a tokenizer and whether it is local (deterministic)."""
    if callable(tokenizer):
        return tokenizer, False
    if tokenizer == "words":
        return lambda _: lambda texts: [words_in(t) for t in texts], True
    if tokenizer.startswith("regex:"):
        pattern = library_pattern(tokenizer[len("regex:") :])
        # concurrent: the library would give up Python's lock for every match
        return lambda _: lambda texts: [len(pattern.findall(t, concurrent=False)) for t in texts], True
    raise ValueError(f"unknown tokenizer {tokenizer!r}")


def endpoint_column(endpoint: Column | str | None) -> Column:
    return endpoint if isinstance(endpoint, Column) else F.lit(endpoint).cast("string")


def counter_udf(
    factory: CounterFactory,
    retry: RetryPolicy = NO_RETRY,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    call_size: int = CALL_TEXTS,
):
    """The Arrow function of (text, endpoint) that asks a counter."""

    @F.arrow_udf(LongType())
    def count(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        clients = Clients(factory)
        with InFlight(max_in_flight) as flight:
            for batch in batches:
                texts, endpoints = (column.to_pylist() for column in batch)
                counts: list[int | None] = [None] * len(texts)
                for endpoint, rows in rows_by_endpoint(texts, endpoints).items():
                    distinct = list(dict.fromkeys(texts[row] for row in rows))
                    answers = ask_all(flight, clients[endpoint], distinct, retry, call_size)
                    found = dict(zip(distinct, answers, strict=True))
                    for row in rows:
                        counts[row] = found[texts[row]]
                yield pa.array(counts, pa.int64())

    return count.asNondeterministic()


def token_count(
    text: Column | str,
    tokenizer: Tokenizer = "words",
    endpoint: Column | str | None = None,
    retry: RetryPolicy = NO_RETRY,
    null_compat: bool = False,
    **options,
) -> Column:
    """Tokens per text as a long.

    ``"words"`` and ``"regex:<pattern>"`` are built-in expressions. Any other tokenizer is a
    factory called once per task and endpoint; its counter gets the distinct texts of an Arrow
    batch in calls of ``call_size`` texts, ``max_in_flight`` of them at a time.
    """
    column = as_column(text)
    if tokenizer == "words":
        counted = word_count(column).cast("long")
    elif isinstance(tokenizer, str) and tokenizer.startswith("regex:"):
        pattern = java_pattern(tokenizer[len("regex:") :])
        counted = F.regexp_count(column, F.lit(pattern)).cast("long")
    else:
        factory, _ = _local_counter(tokenizer)

        counted = counter_udf(factory, retry, **options)(column, endpoint_column(endpoint))
    return fill_nulls(counted, F.lit(0).cast("long"), null_compat)


def halves(data: bytes) -> tuple[bytes, bytes]:
    """Split UTF-8 bytes near their middle, best after a sentence.

    In order: after the first sentence end from the middle on, after the last one before it,
    at the first space from the middle on, at the middle itself.
    """
    middle = len(data) // 2
    while middle < len(data) and data[middle] & 0xC0 == 0x80:
        middle += 1
    end = _SENTENCE_END.search(data, middle)
    cut = end.end() if end else 1 + max(data.rfind(mark, 0, middle) for mark in (b".", b"!", b"?"))
    if cut:
        rest = cut + 1 if data[cut : cut + 1] == b" " else cut
        return data[:cut], data[rest:]
    space = data.find(b" ", middle)
    if space >= 0:
        return data[:space], data[space + 1 :]
    return data[:middle], data[middle:]


def _strict_halves(data: bytes) -> tuple[bytes, bytes]:
    """As :func:`halves`, but going on to the next rule where one side would be empty."""
    left, right = halves(data)
    if left and right:
        return left, right
    middle = len(data) // 2
    while middle < len(data) and data[middle] & 0xC0 == 0x80:
        middle += 1
    ends = [m for m in (data.rfind(mark, 0, middle) for mark in (b".", b"!", b"?")) if m >= 0]
    if ends:
        cut = max(ends) + 1
        return data[:cut], data[cut + 1 :] if data[cut : cut + 1] == b" " else data[cut:]
    for space in (data.find(b" ", middle), data.rfind(b" ", 0, middle)):
        if 0 < space < len(data) - 1:
            return data[:space], data[space + 1 :]
    return data[:middle], data[middle:]


def _limit(budget: int) -> int:
    """A negative budget reads as a very large unsigned one, so it never splits."""
    return budget if budget >= 0 else budget + 2**32


def split_to_budget(
    texts: list[str | None],
    max_tokens: int | list[int],
    counter: Counter,
    strict: bool = False,
) -> list[list[tuple[str, int]] | None]:
    """Halve every text until its pieces are within ``max_tokens``; pieces with their counts.

    The budget is one for all texts or one per text.

    All pieces still to be judged are counted in one call per level, so a remote counter is
    asked as often as the deepest text has levels, not once per piece.
    """
    split = _strict_halves if strict else halves
    # a piece that is split gives way to the pair of its halves; leaves are read off in order
    budgets = max_tokens if isinstance(max_tokens, list) else [max_tokens] * len(texts)
    roots = [None if t is None else [t.encode()] for t in texts]
    open_nodes = [
        (root, 0, _limit(budget))
        for root, budget in zip(roots, budgets)
        if root is not None
    ]
    while open_nodes:
        counts = counter([node[at].decode() for node, at, _ in open_nodes])
        following = []
        for (node, at, budget), tokens in zip(open_nodes, counts):
            data = node[at]
            left, right = split(data) if tokens > budget else (data, b"")
            if left and right:
                node[at] = [left, right]
                following += [(node[at], 0, budget), (node[at], 1, budget)]
            else:
                node[at] = (data.decode(), tokens)
        open_nodes = following

    def leaves(root: list) -> list[tuple[str, int]]:
        result, stack = [], [root]
        while stack:
            top = stack.pop()
            if isinstance(top, tuple):
                result.append(top)
            else:
                stack.extend(reversed(top))
        return result

    return [None if root is None else leaves(root) for root in roots]


# The white space beyond ASCII in UTF-8.
_WIDE_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


class _WordCounts:
    """Words in any span of a text, after one pass over it."""

    def __init__(self, data: bytes) -> None:
        if not data.isascii():
            data = _WIDE_SPACE.sub(lambda m: b" " * len(m[0]), data)
        values = np.frombuffer(data, dtype=np.uint8)
        inside = (values != 32) & ((values < 9) | (values > 13))
        self.inside = inside
        self.starts = inside.copy()
        self.starts[1:] &= ~inside[:-1]
        self.before = np.concatenate(([0], np.cumsum(self.starts)))

    def __call__(self, start: int, end: int) -> int:
        # a span that starts within a word has the rest of it as its first word
        cut_word = start < end and self.inside[start] and not self.starts[start]
        return int(self.before[end] - self.before[start]) + int(cut_word)


def split_words(text: str, max_words: int, strict: bool = False) -> list[tuple[str, int]]:
    """As :func:`split_to_budget` for one text and words as tokens, without counting again."""
    whole = words_in(text)
    if whole <= max_words:
        return [(text, whole)]
    split = _strict_halves if strict else halves
    data = text.encode()
    count = _WordCounts(data)
    pieces, stack = [], [(0, len(data))]
    while stack:
        start, end = stack.pop()
        words = count(start, end)
        left, right = split(data[start:end]) if words > max_words else (b"", b"")
        if left and right:
            stack += [(end - len(right), end), (start, start + len(left))]
        else:
            pieces.append((data[start:end].decode(), words))
    return pieces


CHUNK = StructType([StructField("text", StringType()), StructField("n_tokens", LongType())])


def chunks_udf(
    tokenizer: Tokenizer = "words",
    retry: RetryPolicy = TOKEN_RETRY,
    strict_budget: bool = False,
    counted: bool = False,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    call_size: int = CALL_TEXTS,
):
    """The Arrow function of (text, max_tokens, endpoint), with token counts if ``counted``."""
    factory, local = _local_counter(tokenizer)

    def arrow(parts: list[list[tuple[str, int]] | None]) -> pa.Array:
        if not counted:
            pieces = [p and [piece for piece, _ in p] for p in parts]
            return pa.array(pieces, pa.list_(pa.string()))
        pairs = [p and [{"text": piece, "n_tokens": n} for piece, n in p] for p in parts]
        return pa.array(
            pairs, pa.list_(pa.struct([("text", pa.string()), ("n_tokens", pa.int64())]))
        )

    @F.arrow_udf(ArrayType(CHUNK if counted else StringType()))
    def chunks(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        clients = Clients(factory)
        with InFlight(max_in_flight) as flight:
            for batch in batches:
                texts, budgets, endpoints = (column.to_pylist() for column in batch)
                texts = [None if budget is None else text for text, budget in zip(texts, budgets)]
                if tokenizer == "words":
                    parts = [
                        text if text is None else split_words(text, _limit(budget), strict_budget)
                        for text, budget in zip(texts, budgets)
                    ]
                    yield arrow(parts)
                    continue
                parts = [None] * len(texts)
                for endpoint, rows in rows_by_endpoint(texts, endpoints).items():
                    client = clients[endpoint]

                    def ask(pieces, client=client):
                        # threads are for calls that wait; counting here would only pass Python's lock around
                        return client(pieces) if local else ask_all(flight, client, pieces, retry, call_size)

                    split = split_to_budget(
                        [texts[row] for row in rows], [budgets[row] for row in rows], ask, strict_budget
                    )
                    for row, pieces in zip(rows, split):
                        parts[row] = pieces
                yield arrow(parts)

    return chunks if local else chunks.asNondeterministic()


def _budget(max_tokens: Column | int) -> Column:
    return (max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)).cast("int")


def chunk_text(
    text: Column | str,
    max_tokens: Column | int,
    tokenizer: Tokenizer = "words",
    endpoint: Column | str | None = None,
    retry: RetryPolicy = TOKEN_RETRY,
    strict_budget: bool = False,
    null_compat: bool = False,
) -> Column:
    """The pieces of a text, each within ``max_tokens`` where the split rule allows it.

    A piece that the rule cannot split stays whole over the budget unless ``strict_budget``.
    """
    split = chunks_udf(tokenizer, retry, strict_budget)
    result = split(as_column(text), _budget(max_tokens), endpoint_column(endpoint))
    return fill_nulls(result, F.array().cast("array<string>"), null_compat)


def chunk_documents(
    df: DataFrame,
    text_col: str,
    keys: list[str],
    max_tokens: Column | int,
    tokenizer: Tokenizer = "words",
    endpoint: Column | str | None = None,
    retry: RetryPolicy = TOKEN_RETRY,
    strict_budget: bool = False,
) -> DataFrame:
    """One row per chunk: ``keys``, chunk_id, text and n_tokens. No shuffle."""
    split = chunks_udf(tokenizer, retry, strict_budget, counted=True)
    pieces = split(F.col(f"`{text_col}`"), _budget(max_tokens), endpoint_column(endpoint))
    rows = df.select(*keys, F.posexplode(pieces).alias("chunk_id", "__chunk"))
    return rows.select(*keys, "chunk_id", "__chunk.text", "__chunk.n_tokens")
