"""Lines of large objects, read by byte ranges.

Every object is divided into ranges. A first reading counts the line ends of each range and finds
the first; what follows from that for the neighbours (the number of the first line, the byte where
the lines of a range begin and where its last line ends in a later range) is handed over by two
windows over one small row for each range. So every range then reads whole lines, which are whole
UTF-8 texts, and no object is held by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, InFlight
from corpusloom.session import pinned, scratch
from corpusloom.sources.objects import FETCH_FAILED, HELD_BYTES, AHEAD_BYTES, DefaultResolver, ObjectError, Resolver, _settle

RANGE_BYTES = 8 << 20
READ_BYTES = 1 << 20
_ENDS = StructType([StructField("n", LongType()), StructField("first", LongType())])
_ARROW_ENDS = pa.struct([("n", pa.int64()), ("first", pa.int64())])


def _opened(resolve: Resolver, path: str, use: Callable):
    system, inner = resolve(path)
    try:
        with system.open_input_file(inner) as stream:
            return use(stream)
    except (OSError, pa.ArrowException) as error:
        raise ObjectError(f"{FETCH_FAILED}: {path}: {error}") from error


def _size(resolve: Resolver, path: str) -> int:
    return _opened(resolve, path, lambda stream: stream.size())


def _line_ends(resolve: Resolver, path: str, start: int, stop: int) -> dict:
    """How many line feeds the range has, and where the first one is."""

    def count(stream) -> dict:
        n, first = 0, None
        for at in range(start, stop, READ_BYTES):
            data = stream.read_at(min(READ_BYTES, stop - at), at)
            n += data.count(b"\n")
            if first is None and (place := data.find(b"\n")) >= 0:
                first = at + place
        return {"n": n, "first": first}

    return _opened(resolve, path, count)


def _text_or_none(line: bytes) -> str | None:
    try:
        return line.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _lines(resolve: Resolver, path: str, start: int, stop: int, strict: bool) -> pa.Array:
    """The lines between two places where lines begin or end; one that is not UTF-8 raises if ``strict``, else it is null."""
    data = _opened(resolve, path, lambda stream: stream.read_at(stop - start, start))
    if len(data) != stop - start:
        raise ObjectError(f"{FETCH_FAILED}: {path}: the object became shorter")
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as error:
        if strict:
            raise ObjectError(f"object is not valid UTF-8: {path}") from error
        rows = data.removesuffix(b"\n").split(b"\n")
        closed = len(rows) if data.endswith(b"\n") else len(rows) - 1
        rows = [row.removesuffix(b"\r") if k < closed else row for k, row in enumerate(rows)]
        return pa.array([_text_or_none(row) for row in rows], pa.large_string())
    found = pc.split_pattern(pa.array([text.removesuffix("\n")], pa.large_string()), "\n").values
    # a line feed ends a line also where it is the last byte, and takes the carriage return before it along
    closed = text.endswith("\n")
    cut = pc.replace_substring_regex(found, r"\r\z", "")
    if closed or len(found) == 0:
        return cut
    return pa.concat_arrays([cut.slice(0, len(cut) - 1), found.slice(len(found) - 1)])


def _size_udf(resolver: Resolver, max_in_flight: int, on_error: str):
    size = _settle(_size, on_error)

    @F.arrow_udf(LongType())
    def sizes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with InFlight(max_in_flight) as flight:
            for batch in batches:
                found = flight.map(lambda p: None if p is None else size(resolver, p), batch.to_pylist())
                yield pa.array(list(found), pa.int64())

    return sizes.asNondeterministic()


def _ends_udf(resolver: Resolver, max_in_flight: int):
    @F.arrow_udf(_ENDS)
    def ends(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        with InFlight(max_in_flight) as flight:
            for columns in batches:
                rows = zip(*(c.to_pylist() for c in columns))
                yield pa.array(list(flight.map(lambda r: _line_ends(resolver, *r), rows)), _ARROW_ENDS)

    return ends.asNondeterministic()


def _lines_udf(resolver: Resolver, max_in_flight: int, max_bytes: int, on_error: str):
    read = _settle(_lines, on_error)

    @F.arrow_udf(ArrayType(StringType()))
    def lines(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def one(row: tuple[str, int, int], claim: Callable[[int], None]) -> pa.Array | None:
            claim(row[2] - row[1])
            return read(resolver, *row, on_error == "fail")

        def joined(found: list) -> pa.Array:
            ends = list(accumulate((0 if x is None else len(x) for x in found), initial=0))
            values = pa.concat_arrays([pa.array([], pa.string())] + [x.cast(pa.string()) for x in found if x is not None])
            missing = pa.array([x is None for x in found], pa.bool_())
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=missing)

        with InFlight(max_in_flight, max_bytes) as flight:
            for columns in batches:
                held, found = 0, []
                rows = list(zip(*(c.to_pylist() for c in columns)))
                for row, texts in zip(rows, flight.map(one, rows, claims=True), strict=True):
                    found.append(texts)
                    held += row[2] - row[1]
                    if held > HELD_BYTES:
                        yield joined(found)
                        held, found = 0, []
                if found or not rows:
                    yield joined(found)

    return lines.asNondeterministic()


def read_lines(
    df: DataFrame,
    path_col: str,
    range_bytes: int = RANGE_BYTES,
    resolver: Resolver | None = None,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    max_bytes: int = AHEAD_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """The rows of ``df`` with ``line_no`` (long, from 0) and ``line``, a row for each line of the object that ``path_col`` names.

    Lines are those of :func:`corpusloom.functions.text.lines`: they end with ``\\n`` or ``\\r\\n``, and an
    end that closes the object opens no further line. A task holds ``range_bytes`` and the line that
    goes on after them, and reads ahead up to ``max_bytes``; every byte is read twice. NULL paths and empty objects have no lines; with
    ``on_error="null"`` neither have objects that are not there, and lines that are not UTF-8 are NULL. Each row that names an object gives its lines. The columns of a row travel with each range,
    so select those to keep before; ``line_no`` and ``line`` are replaced. ``tasks`` divides the ranges
    (by default as ``spark.sql.shuffle.partitions`` says). Objects must not change in between.
    """
    if range_bytes < 1:
        raise ValueError(f"range_bytes must be positive, not {range_bytes}")
    resolve = resolver or DefaultResolver()
    kept = [c for c in df.columns if c.lower() not in ("line_no", "line")]
    if path_col.lower() not in [c.lower() for c in kept]:
        raise ValueError(f"{path_col!r} names the lines, not the objects")
    parts = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spark = df.sparkSession
    with scratch(spark) as keep:
        sized = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{path_col}`").alias("path"))
        size = _size_udf(resolve, max_in_flight, on_error)
        sized = sized.withColumn("size", size("path")).where("size > 0")
        sized = pinned(sized.withColumn("rid", F.monotonically_increasing_id()), "sizes")
        last = F.floor((F.col("size") - 1) / F.lit(range_bytes))
        ranges = sized.withColumn("no", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        start = F.col("no") * F.lit(range_bytes)
        stop = F.least(start + F.lit(range_bytes), "size")
        ends = _ends_udf(resolve, max_in_flight)
        counted = ranges.repartition(parts, "rid", "no").withColumn("ends", ends("path", start, stop))
        before = Window.partitionBy("rid").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
        after = Window.partitionBy("rid").orderBy(F.desc("no")).rowsBetween(Window.unboundedPreceding, -1)
        first = F.when(F.col("no") == 0, 0).otherwise(F.col("ends.first") + 1)
        following = F.last("ends.first", ignorenulls=True).over(after) + 1
        borders = counted.select(
            "row", "path", "rid", "no",
            first.alias("begin"),
            F.coalesce(following, "size").alias("end"),
            F.when(F.col("no") == 0, 0).otherwise(F.coalesce(F.sum("ends.n").over(before), F.lit(0)) + 1).cast("long").alias("first_no"),
        ).where("begin < end")
        borders = pinned(borders, "borders")
        keep(borders)
    text = _lines_udf(resolve, max_in_flight, max_bytes, on_error)("path", "begin", "end")
    found = borders.repartition(parts, "rid", "no").select("row", "first_no", F.posexplode(text).alias("i", "line"))
    return found.select("row.*", (F.col("first_no") + F.col("i")).alias("line_no"), "line")
