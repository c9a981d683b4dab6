"""Files that hold one JSON array each, of any size, read by many tasks.

Spark splits a file at its commas. Whether a comma divides two elements depends on what stands before
it: on the quotes (inside a string or not) and on the brackets (how deep). Both compose, so each
split tells what it does to them, the splits are followed in order, one row for each, and a second
reading cuts every split at its own element borders. Only elements that run over the end of a split
move.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.operators.batches import MAX_BROADCAST_PARTS

INVALID = "Invalid payloads JSON"
_MARKS = re.compile(r'\\.|["\[\]{}]', re.S)
_STEP = {"[": 1, "{": 1, "]": -1, "}": -1}
_FOLD = (
    "file string, split long, quotes int, size long, depth0 long, depth1 long, "
    "commas0 map<long, long>, commas1 map<long, long>, first string, last string, marks long"
)
_COUNTS = pa.map_(pa.int64(), pa.int64())
_FOLD_ARROW = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("quotes", pa.int32()), ("size", pa.int64()), ("depth0", pa.int64()), ("depth1", pa.int64()),
     ("commas0", _COUNTS), ("commas1", _COUNTS), ("first", pa.string()), ("last", pa.string()), ("marks", pa.int64())]
)
_PIECE = "file string, position long, split long, value string, whole boolean"


def payload_text(value) -> str:
    """A payload as it is sent: a text as it is, any other JSON value in compact form with sorted keys."""
    if isinstance(value, str):
        return value
    return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def depth_steps(piece: str, inside: bool) -> tuple[int, bool]:
    """How far the brackets of a piece lead up or down, and whether it ends inside a string."""
    depth = 0
    for mark in _MARKS.findall(piece):
        if mark == '"':
            inside = not inside
        elif not inside and mark in _STEP:
            depth += _STEP[mark]
    return depth, inside


def _folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to a state before it, for both: outside (0) and inside (1) a string."""
    folds: dict[tuple[str, int], dict] = {}
    for batch in batches:
        for file, split, value in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "value")), strict=True):
            own = folds.setdefault((file, split), dict(state=[[0, False], [0, True]], size=0, commas=[Counter(), Counter()], first="", last="", marks=0, begun=False))
            for k, state in enumerate(own["state"]):
                if own["begun"] and not state[1]:
                    own["commas"][k][state[0]] += 1  # the comma before this piece
                step, state[1] = depth_steps(value, state[1])
                state[0] += step
            own["begun"] = True
            own["size"] += len(value.encode()) + 1
            blank = value.strip()
            own["first"] = own["first"] or blank[:1]
            own["last"] = blank[-1:] or own["last"]
            own["marks"] += sum(map(len, blank.split()))
    rows = [
        dict(
            file=file, split=split, quotes=int(own["state"][0][1]), size=own["size"], depth0=own["state"][0][0], depth1=own["state"][1][0],
            commas0=list(own["commas"][0].items()), commas1=list(own["commas"][1].items()), first=own["first"], last=own["last"], marks=own["marks"],
        )
        for (file, split), own in folds.items()
    ]
    yield pa.RecordBatch.from_pylist(rows, _FOLD_ARROW)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each split; those at its ends are pieces of elements.

    Rows (file, split, value, inside, depth, position): the last three are the state before the split.
    """
    at = None
    out: list[tuple] = []
    parts: list[str] = []
    position = depth = 0
    inside = began = False

    def table() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        names = [c.split()[0] for c in _PIECE.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for k, value in enumerate(columns["value"]):
            file, split = columns["file"][k], columns["split"][k]
            if (file, split) != at:
                if at is not None:
                    out.append((at[0], position, at[1], ",".join(parts), False))
                at, parts = (file, split), []
                inside, depth, position = (columns[c][k] for c in ("inside", "depth", "position"))
                began = split == 0
                if split and not inside and depth == 1:
                    # the comma before the split divides two elements
                    began, position = True, position + 1
            elif not inside and depth == 1:
                text = ",".join(parts)
                out.append((file, position, split, text, began))
                position, parts, began = position + 1, [], True
            parts.append(value)
            step, inside = depth_steps(value, inside)
            depth += step
        if len(out) > 1 << 14:
            yield table()
            out = []
    if at is not None:
        out.append((at[0], position, at[1], ",".join(parts), False))
    yield table()


def _parsed(text: str, first: bool, last: bool) -> str:
    """The payload of an element; the first and the last hold the brackets of the array."""
    body = text.strip(" \t\r\n")
    if first:
        body = body.removeprefix("[")
    if last:
        body = body.removesuffix("]")
    try:
        return payload_text(json.loads(body))
    except json.JSONDecodeError as error:
        raise ValueError(f"{INVALID}: {error}") from error


def payloads_from_file(spark: SparkSession, path: str) -> DataFrame:
    """(position, payload) of files that hold one JSON array each; positions are those in the array of a file.

    A text is sent as it is, other values in compact JSON. The file is read in as many tasks as it has
    splits (``spark.sql.files.maxPartitionBytes``), its elements stay in them, and a task holds one
    element at a time. An empty file, one that is no JSON or holds something else fails the query.
    """
    lengths = {r.path: r.length for r in spark.read.format("binaryFile").load(path).select("path", "length").collect()}
    if not lengths or 0 in lengths.values():
        raise ValueError(f"{INVALID}: the file is empty")
    read = spark.read.option("lineSep", ",").text(path)
    pieces = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")
    folds = pieces.mapInArrow(_folds, _FOLD).orderBy("file", "split")
    states, ends = [], []
    file, inside, depth, position, size, first, last, marks = None, 0, 0, 0, 0, "", "", 0

    def ended() -> None:
        if file is None:
            return
        if first and first != "[":
            raise ValueError(f"{INVALID}: Payloads must be a JSON array")
        sizes = [n for name, n in lengths.items() if _same(name, file)]
        if not first or last != "]" or inside or depth or (sizes and size - 1 != sizes[0]):
            raise ValueError(f"{INVALID}: the array is not closed")
        # two marks are the brackets of an array without elements
        ends.append((file, position, marks > 2 or position > 0))

    for own in folds.toLocalIterator():  # one row for each split
        if own.file != file:
            ended()
            file, inside, depth, position, size, first, last, marks = own.file, 0, 0, 0, 0, "", "", 0
        states.append((own.file, own.split, bool(inside), depth, position))
        commas = own.commas1 if inside else own.commas0
        first = first or own.first
        if first == "[" and (any(depth + step < 1 for step in commas) or (own.split and not inside and depth < 1)):
            raise ValueError(f"{INVALID}: a comma outside of the array")
        position += commas.get(1 - depth, 0) + int(own.split > 0 and not inside and depth == 1)
        depth, inside = depth + (own.depth1 if inside else own.depth0), inside ^ own.quotes
        size, last, marks = size + own.size, own.last or last, marks + own.marks
    ended()
    known = spark.createDataFrame(states, "file string, split long, inside boolean, depth long, position long")
    last_of = spark.createDataFrame(ends, "file string, final long, holds boolean")
    if len(states) <= MAX_BROADCAST_PARTS:
        known, last_of = F.broadcast(known), F.broadcast(last_of)
    cut = pieces.join(known, ["file", "split"]).mapInArrow(_elements, _PIECE)
    whole = cut.where("whole").select("file", "position", "value")
    texts = F.sort_array(F.collect_list(F.struct("split", "value")))
    # the comma at which a split begins belongs to an element that runs on
    joined = cut.where("NOT whole").groupBy("file", "position").agg(F.array_join(F.transform(texts, lambda p: p["value"]), ",").alias("value"))
    elements = whole.unionByName(joined).join(last_of, "file").where("holds")

    @F.arrow_udf("string")
    def parsed(values: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
        return pa.array([_parsed(*row) for row in zip(values.to_pylist(), first.to_pylist(), last.to_pylist(), strict=True)], pa.string())

    return elements.select("position", parsed("value", F.col("position") == 0, F.col("position") == F.col("final")).alias("payload"))


def _same(path: str, other: str) -> bool:
    """Whether two addresses name one file, with or without an authority or a scheme's slashes."""
    return re.sub(r"^\w+:/*", "", path) == re.sub(r"^\w+:/*", "", other)
