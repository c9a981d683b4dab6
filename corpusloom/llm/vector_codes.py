"""Product codes of vectors by dual-tree Lloyd rounds, in integers throughout.

Vectors become integers and are cut into equal parts; each part position has a codebook of its own.

- The vectors are dealt into blocks. A block has a balanced tree for every part position: a node has
  the box around its points, their sum and their number. Trees are built once, are written to the
  shared folder, and serve all rounds.
- The entries of a codebook are few; a tree over them is made on the driver and sent to the tasks.
- A round walks pairs of a point node and an entry node from the roots down. A pair goes when the
  least distance between its boxes is beyond the largest distance of another pair of the same point
  node. A node with one entry left is assigned as a whole, by its cached sum and number. Leaves in
  which several entries are left compute the distances of their points, ties to the lower index.
- What a round sends is one sum and one number for each task, entry and component. The next codebook
  is their quotient, rounded down.

All bounds and distances are exact integers, so the codes are those of plain Lloyd rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import join_groups, saved

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
BLOCK = 1024
LEAF = 16
_BLOCK_COLUMNS = "size long, points binary, low binary, high binary, sums binary, ranks binary, keys array<long>, labels array<string>"


class Trees(NamedTuple):
    """Balanced trees over rows of integers, one for each part, of one shape."""

    points: np.ndarray  # (parts, rows, components), in the order of the leaves
    low: list[np.ndarray]  # of each level: (parts, nodes, components)
    high: list[np.ndarray]
    sums: list[np.ndarray]
    borders: list[np.ndarray]  # of each level: the first row of each node, and the end


def borders_of(rows: int, leaf: int) -> list[np.ndarray]:
    """Where the nodes of each level begin; every node is halved until all have at most ``leaf`` rows."""
    out = [np.array([0, rows])]
    while np.diff(out[-1]).max() > leaf:
        last = out[-1]
        halves = np.empty(2 * len(last) - 1, np.int64)
        halves[::2] = last
        halves[1::2] = (last[:-1] + last[1:]) // 2
        out.append(halves)
    return out


def _ordered(points: np.ndarray, leaf: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of the rows of each part (parts, rows) in which every node is a run, and the borders."""
    parts, rows, _ = points.shape
    borders = borders_of(rows, leaf)
    order = np.broadcast_to(np.arange(rows), (parts, rows)).copy()
    lane = np.arange(parts)[:, None]
    for cuts in borders[:-1]:
        now = points[lane, order]
        starts = np.minimum(cuts[:-1], max(rows - 1, 0))
        spread = np.maximum.reduceat(now, starts, axis=1) - np.minimum.reduceat(now, starts, axis=1)
        node = np.repeat(np.arange(len(starts)), np.diff(cuts))
        along = spread.argmax(axis=2)[:, node]  # each node is cut along its widest component
        value = np.take_along_axis(now, along[:, :, None], axis=2)[:, :, 0]
        for k in range(parts):
            order[k] = order[k][np.lexsort((value[k], node))]
    return order, borders


def _boxes(points: np.ndarray, borders: list[np.ndarray]) -> Trees:
    low, high, sums = [], [], []
    for cuts in borders:
        starts = cuts[:-1]
        low.append(np.minimum.reduceat(points, starts, axis=1))
        high.append(np.maximum.reduceat(points, starts, axis=1))
        sums.append(np.add.reduceat(points, starts, axis=1))
    return Trees(points, low, high, sums, borders)


class Codebook(NamedTuple):
    """The different entries of one part and a tree over them."""

    entries: np.ndarray  # (entries, components)
    number: list[np.ndarray]  # of each level: the entry of a node that has one, else -1
    low: list[np.ndarray]  # of each level: (nodes, components)
    high: list[np.ndarray]
    real: list[np.ndarray]  # whether the node has an entry at all


def codebook(entries: np.ndarray, depth: int) -> Codebook:
    """A tree of ``depth`` levels below the root. Of equal entries, which tie everywhere, the first stands in it."""
    _, first = np.unique(entries, axis=0, return_index=True)
    order = np.sort(first)
    cuts = [np.array([0, len(order)])]
    for _ in range(depth):
        last, halves = cuts[-1], np.empty(2 * len(cuts[-1]) - 1, np.int64)
        halves[::2], halves[1::2] = last, (last[:-1] + last[1:]) // 2
        for a, b in zip(last[:-1].tolist(), last[1:].tolist(), strict=True):
            own = entries[order[a:b]]
            if b - a > 1:
                order[a:b] = order[a:b][np.argsort(own[:, np.ptp(own, axis=0).argmax()], kind="stable")]
        cuts.append(halves)
    numbers, lows, highs, reals = [], [], [], []
    for borders in cuts:
        sizes = np.diff(borders)
        groups = [entries[order[a:b]] if b > a else entries[:1] for a, b in zip(borders[:-1], borders[1:], strict=True)]
        lows.append(np.array([g.min(axis=0) for g in groups]))
        highs.append(np.array([g.max(axis=0) for g in groups]))
        numbers.append(np.where(sizes == 1, order[np.minimum(borders[:-1], len(order) - 1)], -1))
        reals.append(sizes > 0)
    return Codebook(entries, numbers, lows, highs, reals)


class Books(NamedTuple):
    """The codebooks of all parts, level by level."""

    entries: np.ndarray  # (parts, entries, components)
    number: list[np.ndarray]  # (parts, nodes)
    low: list[np.ndarray]  # (parts, nodes, components)
    high: list[np.ndarray]
    real: list[np.ndarray]


def books_of(entries: np.ndarray) -> Books:
    depth = max(entries.shape[1] - 1, 0).bit_length()
    made = [codebook(own, depth) for own in entries]
    levels = range(depth + 1)
    return Books(entries, *([np.array([getattr(m, name)[k] for m in made]) for k in levels] for name in ("number", "low", "high", "real")))


class Assigned(NamedTuple):
    """Whole nodes (level, part, node, entry) and single points (part, row, entry)."""

    nodes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    part: np.ndarray
    row: np.ndarray
    entry: np.ndarray


def assign(trees: Trees, books: Books) -> Assigned:
    """The nearest entry of every point of every part, ties to the lower index."""
    part = np.arange(len(trees.points))
    node, other = np.zeros_like(part), np.zeros_like(part)
    level = entry_level = 0
    depth, entry_depth = len(trees.borders) - 1, len(books.number) - 1
    whole = []
    while len(part):
        low, high = trees.low[level][part, node], trees.high[level][part, node]
        entry_low, entry_high = books.low[entry_level][part, other], books.high[entry_level][part, other]
        gap = np.maximum(np.maximum(low - entry_high, entry_low - high), 0)
        reach = np.maximum(high - entry_low, entry_high - low)
        least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        lane = part * (1 << level) + node
        starts = np.flatnonzero(np.diff(lane, prepend=-1))
        bound = np.repeat(np.minimum.reduceat(most, starts), np.diff(starts, append=len(lane)))
        stay = least <= bound
        part, node, other, lane = part[stay], node[stay], other[stay], lane[stay]
        starts = np.flatnonzero(np.diff(lane, prepend=-1))
        number = books.number[entry_level][part, other]
        alone = np.zeros(len(lane), bool)
        alone[starts] = np.diff(starts, append=len(lane)) == 1
        alone &= number >= 0
        if alone.any():
            whole.append((level, part[alone], node[alone], number[alone]))
            part, node, other = part[~alone], node[~alone], other[~alone]
        if level == depth and entry_level == entry_depth:
            break
        if entry_level < entry_depth:
            entry_level += 1
            part, node = np.repeat(part, 2), np.repeat(node, 2)
            other = np.stack((2 * other, 2 * other + 1), axis=1).ravel()
            real = books.real[entry_level][part, other]
            part, node, other = part[real], node[real], other[real]
        if level < depth:
            level += 1
            part, other = np.concatenate((part, part)), np.concatenate((other, other))
            node = np.concatenate((2 * node, 2 * node + 1))
            order = np.lexsort((node, part))
            part, node, other = part[order], node[order], other[order]
    none = np.zeros(0, np.int64)
    if not len(part):
        return Assigned(whole, none, none, none)
    # uncertain leaves: every point meets the entries that are left of its leaf
    cuts = trees.borders[depth]
    number = books.number[entry_depth][part, other]
    size = np.diff(cuts)[node]
    pair = np.repeat(np.arange(len(part)), size)
    row = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size) + cuts[node][pair]
    lane, entry = part[pair], number[pair]
    order = np.lexsort((entry, row, lane))
    lane, row, entry = lane[order], row[order], entry[order]
    gap = trees.points[lane, row] - books.entries[lane, entry]
    distance = (gap * gap).sum(axis=1)
    starts = np.flatnonzero((np.diff(lane, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0))
    nearest = distance == np.repeat(np.minimum.reduceat(distance, starts), np.diff(starts, append=len(lane)))
    best = np.minimum.reduceat(np.where(nearest, entry, books.entries.shape[1]), starts)
    return Assigned(whole, lane[starts], row[starts], best)


def _blocks(parts: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                values = np.floor(vectors * scale).astype(np.int64)
                points = values.reshape(part.num_rows, parts, -1).transpose(1, 0, 2)
                order, borders = _ordered(points, LEAF)
                trees = _boxes(np.take_along_axis(points, order[:, :, None], axis=1), borders)
                flat = lambda arrays, kind: np.concatenate([a.astype(kind).ravel() for a in arrays]).tobytes()
                binary = [trees.points.astype(np.int32).tobytes(), flat(trees.low, np.int32), flat(trees.high, np.int32), flat(trees.sums, np.int64), order.astype(np.int32).tobytes()]
                columns = [pa.array([part.num_rows], pa.int64()), *(pa.array([x], pa.binary()) for x in binary)]
                columns.append(pa.array([part.column("key").to_pylist()], pa.list_(pa.int64())))
                columns.append(pa.array([part.column("label").to_pylist()], pa.list_(pa.string())))
                yield pa.record_batch(columns, names=[c.split()[0] for c in _BLOCK_COLUMNS.split(", ")])

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, one at a time."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _read(row: dict, parts: int) -> Trees:
    """The trees of a block."""
    borders = borders_of(row["size"], LEAF)
    points = np.frombuffer(row["points"], np.int32).astype(np.int64).reshape(parts, row["size"], -1)
    width = points.shape[2]
    out: dict[str, list[np.ndarray]] = {}
    for name, kind in (("low", np.int32), ("high", np.int32), ("sums", np.int64)):
        flat, at, levels = np.frombuffer(row[name], kind).astype(np.int64), 0, []
        for cuts in borders:
            n = parts * (len(cuts) - 1) * width
            levels.append(flat[at : at + n].reshape(parts, -1, width))
            at += n
        out[name] = levels
    return Trees(points, out["low"], out["high"], out["sums"], borders)


def _round(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The sums of the points of each entry, one row for each task, part, entry and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.entries.shape
        sums, counts = np.zeros(books.entries.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in _rows(batch):
                trees = _read(row, parts)
                found = assign(trees, books)
                for level, part, node, entry in found.nodes:
                    np.add.at(sums, (part, entry), trees.sums[level][part, node])
                    np.add.at(counts, (part, entry), np.diff(trees.borders[level])[node])
                np.add.at(sums, (found.part, found.entry), trees.points[found.part, found.row])
                np.add.at(counts, (found.part, found.entry), 1)
        at = np.flatnonzero(np.repeat(counts.ravel() > 0, width))
        yield pa.record_batch([pa.array(at), pa.array(sums.ravel()[at]), pa.array(counts.ravel()[at // width])], names=["place", "total", "n"])

    return run


def _coded(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The code and the error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(books.entries)
        lane = np.arange(parts)[:, None]
        for batch in batches:
            for row in _rows(batch):
                trees = _read(row, parts)
                found = assign(trees, books)
                entry = np.zeros((parts, row["size"]), np.int64)
                for level, part, node, own in found.nodes:
                    cuts = trees.borders[level]
                    size = np.diff(cuts)[node]
                    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(cuts[node], size)
                    entry[np.repeat(part, size), at] = np.repeat(own, size)
                entry[found.part, found.row] = found.entry
                gap = trees.points - books.entries[lane, entry]
                ranks = np.frombuffer(row["ranks"], np.int32).reshape(parts, -1)
                errors, codes = np.zeros(row["size"], np.int64), np.zeros((row["size"], parts), np.int64)
                for k in range(parts):
                    errors[ranks[k]] += (gap[k] * gap[k]).sum(axis=1)
                    codes[ranks[k], k] = entry[k]
                code = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel().astype(np.int32)), parts).cast(pa.list_(pa.int32()))
                yield pa.record_batch([pa.array(row["keys"], pa.int64()), pa.array(row["labels"], pa.string()), code, pa.array(errors)], names=["key", "label", "code", "error"])

    return run


class Coded(NamedTuple):
    rows: DataFrame  # key, label (as a string), code (array<int>), error
    codebooks: np.ndarray  # (parts, entries, components), integers


def compress_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Coded:
    """Codebooks for the parts of the vectors in a column, and the code of every vector.

    A component x is the integer floor(scale * x). A part's codebook begins with that part of the
    vectors with the ``entries`` smallest keys, changes for ``rounds`` rounds, and codes the vectors.

    Rows whose vector is null, empty, or holds a null or a number that is not finite are left out.
    Rows without key come after all others when the codebooks begin; equal keys are ordered by their
    vectors. With fewer rows than entries there are as many entries as rows; an empty table gives
    neither. Entries that nothing is nearest to stay. Further columns are ignored. Vectors of
    different lengths, a length that ``parts`` does not divide, and components whose squared distances
    would not fit 64 bits raise a ValueError.
    """
    spark = df.sparkSession
    good = F.col("vector").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label")).where(good)
    facts = rows.agg(F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most"), F.max(F.greatest(F.array_max("vector"), -F.array_min("vector"))).alias("far")).first()
    if facts.least is None:
        empty = spark.createDataFrame([], "key long, label string, code array<int>, error long")
        return Coded(empty, np.zeros((parts, 0, 0), np.int64))
    if facts.least != facts.most or facts.least % parts:
        raise ValueError(f"vectors have {facts.least} to {facts.most} components; one length that {parts} parts divide is needed")
    if facts.most * (2 * (facts.far * scale + 1)) ** 2 >= 2.0**62:
        raise ValueError(f"a component of size {facts.far} is too large for distances of 64 bits")
    first = rows.orderBy(F.col("key").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.floor(np.array([r.vector for r in first]) * scale).astype(np.int64)
    books = books_of(np.ascontiguousarray(start.reshape(len(first), parts, -1).transpose(1, 0, 2)))
    blocks, _ = saved(rows.mapInArrow(_blocks(parts, scale), _BLOCK_COLUMNS), "blocks")
    points = blocks.select("size", "points", "low", "high", "sums")
    for _ in range(rounds):
        sent = points.mapInArrow(_round(books), "place long, total long, n long")
        # one row for each component of each entry, however many vectors there are
        after = sent.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
        flat = books.entries.ravel().copy()
        for r in after:
            flat[r.place] = int(r.total) // r.n
        books = books_of(flat.reshape(books.entries.shape))
    coded = blocks.mapInArrow(_coded(books), "key long, label string, code array<int>, error long")
    return Coded(coded, books.entries)


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers with commas, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Add label_error, the error of all rows with an equal label; rows without label are together."""
    rows, _ = saved(coded.withColumn("of", F.struct("label")), "coded")
    sums = rows.groupBy("of").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return join_groups(rows, sums, "of", rows.count()).drop("of", "n")
