"""Heading context and semantic chunks over ordered tables of lines or elements, keys of any length.

The rows are range-sorted by key and position into pinned parts, so a key may fill many parts and a
part hold many keys. What runs along a key (the headings in force, the open chunk) is worked out
within each part and carried from part to part by a table of one row per part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from corpusloom.functions.text import trim_text, word_count
from corpusloom.operators.batches import MAX_BROADCAST_PARTS, numbered_parts
from corpusloom.operators.html import HEADINGS, MAX_CHUNK_WORDS, MIN_CHUNK_WORDS
from corpusloom.session import pinned

_KEY, _PART, _PLACE = "__key", "__part", "__place"


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _in_parts(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """The rows in sorted parts, with the key as one text."""
    rows = numbered_parts(df, [*keys, pos])
    return rows.withColumn(_KEY, F.to_json(F.struct(*_named(keys)), {"ignoreNullFields": "false"}))


def _sent(carried: DataFrame) -> DataFrame:
    """A table of one row per part, by broadcast up to a checked size."""
    return F.broadcast(carried) if carried.count() <= MAX_BROADCAST_PARTS else carried


def heading_context(df: DataFrame, keys: Sequence[str], pos: str, level: Column, text: Column) -> DataFrame:
    """Add h1 to h6: the headings in force at each row, within its key and in the order of ``pos``.

    ``level`` is 1 to 6 for a heading and NULL for other rows; ``text`` is the heading's text, trimmed
    here, NULL as ''. A heading is in force from its own row on; it ends those of its level and deeper.
    Levels without a heading are ''. Rows equal in ``pos`` keep the order in which they were read,
    NULL keys are one key, NULL positions come first. Columns h1 to h6 that the table has are replaced.

    Both steps are windows: over the rows of one key in one sorted part, and over the parts of a key,
    of which there is one row each.
    """
    columns = [c for c in df.columns if c not in HEADINGS]
    marked = df.select(*_named(columns), level.cast("int").alias("__level"), F.coalesce(trim_text(text), F.lit("")).alias("__text"))
    rows = _in_parts(marked, keys, pos)
    so_far = Window.partitionBy(_PART, _KEY).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)

    def said(k: int) -> Column:
        """What a row says of level k: its text, '' where a higher heading clears it, else nothing."""
        return F.when(F.col("__level") == k, F.col("__text")).when(F.col("__level") < k, F.lit(""))

    local = rows.select("*", *[F.last(said(k), ignorenulls=True).over(so_far).alias(f"__h{k}") for k in range(1, 7)])
    headings = rows.where("__level BETWEEN 1 AND 6")
    ends = headings.groupBy(_KEY, _PART).agg(*[F.max_by(said(k), F.when(said(k).isNotNull(), F.col(_PLACE))).alias(f"__e{k}") for k in range(1, 7)])
    # of a sorted part, only the first key can have begun before it
    first = rows.groupBy(_PART).agg(F.min_by(_KEY, _PLACE).alias(_KEY))
    both = ends.unionByName(first, allowMissingColumns=True)
    before = Window.partitionBy(_KEY).orderBy(_PART).rangeBetween(Window.unboundedPreceding, -1)
    carried = both.select(_KEY, _PART, *[F.last(f"__e{k}", ignorenulls=True).over(before).alias(f"__e{k}") for k in range(1, 7)])
    carried = carried.join(first, [_KEY, _PART], "left_semi").distinct()
    found = local.join(_sent(carried), [_KEY, _PART], "left")
    return found.select(*_named(columns), *[F.coalesce(f"__h{k}", f"__e{k}", F.lit("")).alias(h) for k, h in enumerate(HEADINGS, 1)])


# --- semantic chunks -------------------------------------------------------------------------


def next_starts(counts: np.ndarray, low: int, high: int) -> np.ndarray:
    """For a chunk that starts at each piece: the piece at which the next one starts, or the number of pieces."""
    total = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(len(counts))
    enough = np.searchsorted(total, total[:-1] + low, "left")
    over = np.searchsorted(total, total[:-1] + high, "right") - 1
    return np.minimum(np.maximum(np.maximum(enough, over), at + 1), len(counts))


def carry_table(counts: np.ndarray, low: int, high: int) -> list[tuple[int, int, int]]:
    """What a run of pieces does to a chunk that is open before it, as rows (from, words, closed).

    A chunk open with at least ``from`` words (the last row that holds) leaves ``closed`` chunks closed
    and one open with ``words`` words; where ``closed`` is 0 the words are to be added. More than
    max(low, high) + 1 words act as that many.
    """
    n, total = len(counts), np.concatenate(([0], np.cumsum(counts)))
    after = next_starts(counts, low, high)
    closed, end = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for i in range(n - 1, -1, -1):
        j = after[i]
        closed[i], end[i] = (1, i) if j == n else (closed[j] + 1, end[j])
    opened = np.arange(max(low, high) + 2)
    enough = np.searchsorted(total, low - opened, "left")
    over = np.searchsorted(total, high - opened, "right") - 1
    first = np.minimum(np.maximum(np.maximum(enough, over), 0), n)
    rows = []
    for w in np.flatnonzero(np.diff(first, prepend=-1)).tolist():
        j = int(first[w])
        rows.append((w, int(total[n]), 0) if j == n else (w, int(total[n] - total[end[j]]), int(closed[j])))
    return rows


def carried_on(rows: list[tuple[int, int, int]], words: int, limit: int) -> tuple[int, int]:
    """The words of the open chunk and the number of closed ones after a run, from ``words`` before it."""
    words = min(words, limit)
    at = max(k for k, row in enumerate(rows) if row[0] <= words)
    _, after, closed = rows[at]
    return (min(words + after, limit), 0) if closed == 0 else (min(after, limit), closed)


_FOLD = "part long, first string, last string, froms array<long>, words array<long>, closed array<long>, tail_words long, tail_closed long"


def _part_folds(low: int, high: int):
    """One row per part of rows (__part, __key, __words) in order: its first and last key and what they do."""

    def fold(part: int, first: str, counts: list[int], last: str, tail: tuple[int, int]) -> pa.RecordBatch:
        table = carry_table(np.array(counts, np.int64), low, high)
        lists = [pa.array([[row[k] for row in table]], pa.list_(pa.int64())) for k in range(3)]
        columns = [pa.array([part]), pa.array([first]), pa.array([last]), *lists, pa.array([tail[0]]), pa.array([tail[1]])]
        return pa.record_batch(columns, names=[c.split()[0] for c in _FOLD.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = key = None
        counts: list[int] = []
        words = closed = 0
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in (_PART, _KEY, "__words"))
            for own_part, own_key, count in zip(*columns, strict=True):
                if own_part != part:
                    if part is not None:
                        yield fold(part, first, counts, key, (words, closed))
                    part, first, key, counts, words, closed = own_part, own_key, own_key, [], 0, 0
                elif own_key != key:
                    key, words, closed = own_key, 0, 0
                if key == first:
                    counts.append(count)
                if words + count > high and words >= low:
                    words, closed = 0, closed + 1
                words += count
        if part is not None:
            yield fold(part, first, counts, key, (words, closed))

    return run


def _chunk_pieces(low: int, high: int, keys: list[str], context: list[str], schema: pa.Schema):
    """Chunks, or pieces of those that go over the border of a part, of rows in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = key = None
        words = chunk = 0  # as carried in: of the whole chunk
        own: list = []  # of the open chunk in this part: texts, words, first row's key and context
        out: list[list] = [[] for _ in schema]
        held = 0

        def emit(whole: bool, closed: bool) -> None:
            nonlocal held
            texts, count, names, row = own
            values = [*names, *(row or [None] * len(context)), chunk, part, "\n\n".join(texts), count, len(texts), row is not None, whole, closed]
            for column, value in zip(out, values, strict=True):
                column.append(value)
            held += sum(map(len, texts)) + 100

        def flush() -> pa.RecordBatch:
            nonlocal out, held
            batch = pa.record_batch([pa.array(values, field.type) for values, field in zip(out, schema, strict=True)], schema=schema)
            out, held = [[] for _ in schema], 0
            return batch

        began = False  # whether the open chunk began in this part
        for batch in batches:
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for k in range(batch.num_rows):
                same_part = columns[_PART][k] == part
                if not same_part or columns[_KEY][k] != key:
                    if part is not None:
                        # a part's last chunk may go on in the next; any other ends with its key
                        emit(whole=began and same_part, closed=False)
                    carried = None if same_part else columns["__open"][k]
                    part, key = columns[_PART][k], columns[_KEY][k]
                    words, chunk, began = (0, 0, True) if carried is None else (carried, columns["__chunk"][k], False)
                    own = [[], 0, [columns[n][k] for n in keys], None]
                count = columns["__words"][k]
                if words + count > high and words >= low:
                    emit(whole=began, closed=True)
                    words, chunk, began = 0, chunk + 1, True
                    own = [[], 0, own[2], None]
                if own[3] is None:
                    own[3] = [columns[c][k] for c in context]
                own[0].append(columns["__text"][k])
                own[1] += count
                words += count
                if held > 4 << 20:
                    yield flush()
        if part is not None:
            emit(whole=False, closed=False)
        yield flush()

    return run


def pack_lines(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    text: str,
    min_words: int = MIN_CHUNK_WORDS,
    max_words: int = MAX_CHUNK_WORDS,
    context: Sequence[str] = (),
) -> DataFrame:
    """Semantic chunks of the rows of each key in the order of ``pos``: keys, chunk_id, text, context, word_count, paragraph_count.

    The rule of :func:`corpusloom.operators.html.extract_html`: a chunk closes before a row that would
    take it over ``max_words``, once it has ``min_words``; rows are joined by a blank line, a wordless
    tail is no chunk. ``context`` names columns of which a chunk takes its first row's values.

    A NULL text is '' and has no words. Rows equal in ``pos`` keep the order in which they were read;
    NULL keys are one key. Nothing is gathered per key: a task holds the rows of the open chunk, and of
    a part its first key's word counts. Where the chunks of a key begin in a part depends on the words
    open before it: each part gives that as a small table, and the tables are followed part by part.
    Chunks that go over a border move as pieces, all others are made where their rows lie.
    """
    keys, context = list(keys), list(context)
    limit = max(min_words, max_words) + 1
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text")
    extra = [c for c in dict.fromkeys(context) if c not in (*keys, pos)]
    lines = df.select(*_named(keys), F.col(f"`{pos}`"), *_named(extra), body)
    rows = _in_parts(lines.withColumn("__words", word_count("__text").cast("long")), keys, pos)

    def in_order(frame: DataFrame) -> DataFrame:
        return frame.repartition(_PART).sortWithinPartitions(_PART, _PLACE)

    counted = in_order(rows.select(_PART, _PLACE, _KEY, "__words")).drop(_PLACE)
    folds = counted.mapInArrow(_part_folds(min_words, max_words), _FOLD).orderBy("part")
    carried, last, state = [], None, (0, 0)
    for part in folds.toLocalIterator():  # one row per part
        if part.first == last:
            carried.append((part.part, *state))
            words, closed = carried_on(list(zip(part.froms, part.words, part.closed, strict=True)), state[0], limit)
            state = (words, state[1] + closed)
        if part.first != last or part.last != part.first:
            state = (min(part.tail_words, limit), part.tail_closed)
        last = part.last
    known = df.sparkSession.createDataFrame(carried, f"{_PART} int, __open long, __chunk long")
    ordered = in_order(rows.join(_sent(known), _PART, "left"))

    field = {f.name: f for f in ordered.schema.fields}
    made = [
        *[StructField(f"__k{i}", field[k].dataType) for i, k in enumerate(keys)],
        *[StructField(f"__c{i}", field[c].dataType) for i, c in enumerate(context)],
        StructField("chunk_id", LongType()), StructField(_PART, LongType()), StructField("__text", StringType()), StructField("words", LongType()),
        StructField("rows", IntegerType()), StructField("__real", BooleanType()), StructField("__whole", BooleanType()), StructField("__closed", BooleanType()),
    ]
    schema = StructType(made)
    pieces = ordered.mapInArrow(_chunk_pieces(min_words, max_words, keys, context, to_arrow_schema(schema)), schema)
    pieces = pinned(pieces, "chunks")
    whole = pieces.where("__whole").select(*schema.names)
    named = [f"__k{i}" for i in range(len(keys))]
    real = F.col("__real")
    parts = F.sort_array(F.collect_list(F.when(real, F.struct(_PART, "__text"))))
    joined = pieces.where("NOT __whole").groupBy(*named, "chunk_id").agg(
        *[F.min_by(F.struct(f"__c{i}"), F.when(real, F.col(_PART))).getField(f"__c{i}").alias(f"__c{i}") for i in range(len(context))],
        F.array_join(F.transform(parts, lambda p: p["__text"]), "\n\n").alias("__text"),
        F.sum("words").alias("words"), F.sum("rows").cast("int").alias("rows"), F.max("__closed").alias("__closed"),
    )
    chunks = whole.select(*joined.columns).unionByName(joined).where("words > 0 OR __closed")
    return chunks.select(
        *[F.col(n).alias(k) for n, k in zip(named, keys)],
        F.col("chunk_id").cast("int").alias("chunk_id"),
        trim_text("__text").alias("text"),
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(context)],
        F.col("words").cast("int").alias("word_count"),
        F.col("rows").alias("paragraph_count"),
    )
