"""Dense batch numbers over an ordered table of any size."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from corpusloom.session import pinned


# Messages.
INVALID_SIZE = "Invalid batch_size: "
ZERO_SIZE = "batch_size must be greater than 0"


def batch_size_of(value: int | str) -> int:
    """A batch size given as a whole number or its digits."""
    if isinstance(value, bool) or not isinstance(value, (int, str)) or not re.fullmatch(r"\+?[0-9]+", str(value)):
        raise ValueError(f"{INVALID_SIZE}{value!r} is not a whole number")
    size = int(value)
    if size == 0:
        raise ValueError(ZERO_SIZE)
    return size


# a row id holds the number of its part above the bits of the place in it
_PLACE_BITS = 33
# 16 bytes each
MAX_BROADCAST_PARTS = 1 << 20


def numbered_parts(df: DataFrame, order_by: Sequence[str], unique: bool = False) -> DataFrame:
    """The rows pinned in order, with ``__part`` and ``__place`` in it."""
    names = [F.col(f"`{c}`") for c in df.columns]
    row_id = F.monotonically_increasing_id().alias("__row")
    if order_by and unique:
        ordered = df.orderBy(*[F.col(f"`{c}`") for c in order_by])
        rows = pinned(ordered.select(*names, row_id), "ordered")
    else:
        rows = pinned(df.select(*names, row_id), "rows")
    if order_by and not unique:
        ordered = rows.orderBy(*[F.col(f"`{c}`") for c in order_by], "__row")
        rows = pinned(ordered.select(*names, row_id), "ordered", source=rows)
    return rows.select(
        *names,
        F.shiftright("__row", _PLACE_BITS).cast("int").alias("__part"),
        F.col("__row").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias("__place"),
    )


def dense_positions(df: DataFrame, order_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Add ``position``: 0, 1, 2, ... without gaps, in the order of ``order_by``.

    The rows are pinned with a row id, range-sorted over all tasks with that id as the last
    sort key, and pinned again. The id makes the sort deterministic when a task is repeated,
    keeps rows of equal order in the order they were read, and lets a value that many rows
    share be split over several sorted parts. Then the parts are counted, which reads one
    column, and the place of a row in its part is moved by the sizes of the parts before it.
    That table has one row per sort task and is joined by broadcast, after a check of its size.

    Without ``order_by`` the rows keep the order in which they were read and nothing is sorted.
    With ``unique`` the caller says that no two rows are equal in ``order_by`` and that ``df``
    gives the same rows each time; then they are sorted and pinned once, without the id.
    """
    rows = numbered_parts(df, order_by, unique)
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")
    )
    if sizes.count() <= MAX_BROADCAST_PARTS:
        starts = F.broadcast(starts)
    placed = rows.join(starts, "__part")
    return placed.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__start") + F.col("__place")).alias("position"),
    )


def dense_batches(
    df: DataFrame, order_by: Sequence[str], batch_size: int | str, unique: bool = False
) -> DataFrame:
    """Add ``position`` and ``batch_id`` = position divided by the batch size.

    Only the last batch can be short.
    """
    size = batch_size_of(batch_size)
    placed = dense_positions(df, order_by, unique)
    return placed.withColumn("batch_id", F.expr(f"position div {size}"))


def _batch_runs(size: int, total: int, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (position, payload), those of whole batches (or of all others) as (batch_id, first, payloads).

    A batch is whole if all its rows follow each other here. Tasks read sorted files in runs of
    consecutive positions, so all batches but those at the ends of a run are whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []  # the rows so far of the batch that is not complete yet
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*waiting, batch]).combine_chunks()
            position = rows.column("position").to_numpy()
            number = position // size
            # a new run also begins where positions do not follow each other
            starts = np.flatnonzero((np.diff(number, prepend=-1) != 0) | (np.diff(position, prepend=position[0] - 1) != 1))
            last = int(starts[-1])
            waiting = rows.slice(last).to_batches()
            yield from _runs(rows, position, starts, last)
        if waiting:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            yield from _runs(rows, rows.column("position").to_numpy(), np.zeros(1, np.int64), rows.num_rows)

    def _runs(rows: pa.Table, position: np.ndarray, starts: np.ndarray, end: int) -> Iterator[pa.RecordBatch]:
        starts = starts[starts < end]
        if not len(starts):
            return
        sizes = np.diff(starts, append=end)
        number = position[starts] // size
        complete = sizes == np.minimum(size, total - number * size)
        chosen = np.flatnonzero(complete if whole else ~complete)
        if not len(chosen):
            return
        take = np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in chosen])
        payload = rows.column("payload").combine_chunks().take(pa.array(take))
        offsets = np.concatenate(([0], np.cumsum(sizes[chosen]))).astype(np.int32)
        yield pa.record_batch([pa.array(number[chosen]), pa.array(position[starts[chosen]]), pa.ListArray.from_arrays(pa.array(offsets), payload)], names=["batch_id", "first", "payloads"])

    return run


def batch_arrays(df: DataFrame, column: str, order_by: Sequence[str], batch_size: int | str, unique: bool = False) -> DataFrame:
    """(batch_id, payloads): the values of ``column`` in dense batches, as :func:`dense_batches` numbers them.

    After the range sort the values stay where they are: batches that lie in one run of the sorted
    files are made there, and only the rows of batches at the ends of runs are moved. NULL values stay.
    """
    size = batch_size_of(batch_size)
    needed = list(dict.fromkeys([*order_by, column]))
    placed = dense_positions(df.select(*[F.col(f"`{c}`") for c in needed]), order_by, unique)
    rows = placed.select("position", F.col(f"`{column}`").alias("payload"))
    total = rows.count()
    schema = StructType([StructField("batch_id", LongType()), StructField("first", LongType()), StructField("payloads", ArrayType(rows.schema["payload"].dataType))])
    whole = rows.mapInArrow(_batch_runs(size, total, whole=True), schema).select("batch_id", "payloads")
    ends = rows.mapInArrow(_batch_runs(size, total, whole=False), schema)
    pieces = F.sort_array(F.collect_list(F.struct("first", "payloads")))
    return whole.unionByName(ends.groupBy("batch_id").agg(F.flatten(F.transform(pieces, lambda p: p["payloads"])).alias("payloads")))
