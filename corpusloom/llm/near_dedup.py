"""Near duplicates by a chosen-path set similarity join, confirmed on full shingle sets.

1. Texts become sets of word shingles. Equal sets are one class from here on, so copies cost nothing.
2. Every class has ``COORDINATES`` minwise values. Each of ``trees`` independent trees branches the
   classes: a node picks coordinates (one, and a second in so many nodes that a pair at the threshold
   is expected to share one child), and the value there names the child. Comparing begins at level
   ``FIRST``, as most classes that meet above it do so by chance. Nodes with at most
   ``SMALL`` classes are compared exhaustively. In a larger one each class is compared with the first
   of the node and with its ``SMALL`` neighbours in the order of the values' low bytes, which begins at
   another coordinate in every node; a node too large for one task is dealt into pieces that share
   its first. Classes that this does not tie to the first are loose. A node with at most ``SMALL``
   loose classes ends there: these meet all its classes, and all others are in one candidate group.
   The rest branch again, to ``depth`` and beyond it as long as a child has at most three quarters
   of its node, so the rows shrink from level to level. In nodes that stay whole all loose classes
   meet all classes, in chunks and pieces of bounded size, so no node is compared in part.
3. Classes that look alike (estimate, well below the threshold) form candidate groups. Texts of the
   candidates move once, to their group, and all pairs in a group are confirmed on full sets. A
   group too large for one task is dealt into blocks that share some pivots; classes which that does
   not tie to the largest component of the group then meet every block, so no link is lost.
4. Confirmed links give the components.

A pair of similarity p shares a node of depth d in a tree with probability p ** d at least; there are
as many trees as miss it with probability 2e-5 at most at ``depth`` (16 for 0.8 and depth 3). Beyond
that depth a pair at the threshold expects one shared child, so it thins out slowly: 16 trees miss it
with probability 1e-4 at depth 8.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import mix, shingles, words
from corpusloom.llm.common import LARGE_JOIN, components, drop_folders, release, saved, slices, small_batches, texts_of

COORDINATES = 64
SMALL = 24
MISSED = 2e-5
FIRST = 2  # the level at which classes are compared first
DEEPEST = 48
PIECE = 2048  # classes of a node that one task compares
CHUNK = 512  # loose classes that meet a piece at once
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 1 << 20
PIVOTS = 8
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_FEATURES = "doc_id long, set_key binary, n_shingles long, minwise binary"


def alike(percent: int) -> int:
    """The equal coordinates of candidates: five standard deviations below what the threshold gives."""
    p = percent / 100
    return max(1, math.ceil(COORDINATES * p - 5 * math.sqrt(COORDINATES * p * (1 - p))))


def trees_for(percent: int, depth: int) -> int:
    """The trees that a pair at the threshold needs."""
    return max(1, math.ceil(math.log(MISSED) / math.log1p(-min((percent / 100) ** depth, 0.999))))


def set_of(hashes: np.ndarray, size: int) -> np.ndarray:
    return np.unique(shingles(hashes, size))


def set_key(members: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    low = mix(members).sum(dtype=np.uint64)
    high = mix(members ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return np.array([low, high + np.uint64(len(members))], np.uint64).tobytes()


def minwise(members: np.ndarray) -> np.ndarray:
    """The low 16 bits of the smallest hash in each coordinate."""
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint64)
    for start in range(0, len(members), 4096):
        part = members[start : start + 4096, None] * _FACTORS
        least = np.minimum(least, (part >> np.uint64(32)).min(axis=0))
    return least.astype(np.uint16)


def _features(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = words(texts_of(part.column("text")))
                keys, counts, values = [], [], []
                for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
                    members = set_of(found.hashes[low:high], size)
                    keys.append(set_key(members))
                    counts.append(len(members))
                    values.append(minwise(members).tobytes())
                yield pa.record_batch([part.column("doc_id").cast(pa.int64()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()), pa.array(values, pa.binary())], names=["doc_id", "set_key", "n_shingles", "minwise"])

    return run


def _children(node: np.ndarray, values: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The children of rows at ``node`` (n) with minwise ``values`` (n, 64): the row and the child of each branch."""
    often = np.uint64(100 * 100 // percent - 100)  # of 100 nodes, those with a second branch
    rows = np.arange(len(node))
    first = (mix(node) % np.uint64(COORDINATES)).astype(np.int64)
    second = (mix(node + np.uint64(1)) % np.uint64(COORDINATES)).astype(np.int64)
    # the same coordinate again would only repeat the child
    twice = np.flatnonzero((mix(node + np.uint64(2)) % np.uint64(100) < often) & (second != first))
    rows, coordinate = np.concatenate((rows, twice)), np.concatenate((first, second[twice]))
    value = values[rows, coordinate].astype(np.uint64)
    return rows, mix(node[rows] ^ (value + (coordinate.astype(np.uint64) << np.uint64(20))) * np.uint64(0x9FB21C651E98DF25))


def _branch(trees: int | None, percent: int, levels: int = 1) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the roots of all trees, or (None) from the column ``node``, to the nodes ``levels`` below, with the size of the node (of a root: 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("set_key")
            values = np.frombuffer(b"".join(batch.column("minwise").to_pylist()), np.uint16).reshape(-1, COORDINATES)
            if trees is None:
                starts = [batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)]
            else:
                starts = [np.full(len(values), mix(np.array([tree + 1], np.uint64))[0]) for tree in range(trees)]
            size = pa.array(np.zeros(len(values), np.int64)) if trees else batch.column("size")
            for child in starts:
                rows = np.arange(len(values))
                for _ in range(levels):
                    taken, child = _children(child, values[rows], percent)
                    rows = rows[taken]
                yield pa.record_batch([pa.array(child.view(np.int64)), key.take(pa.array(rows)), size.take(pa.array(rows))], names=["node", "set_key", "parent"])

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The low bytes of the minwise values, which are enough to compare classes."""
    for batch in batches:
        values = batch.column("minwise")
        marks = [np.frombuffer(v, np.uint16).astype(np.uint8).tobytes() for v in values.to_pylist()]
        yield pa.record_batch([batch.column("set_key"), batch.column("n_shingles"), pa.array(marks, pa.binary())], names=["set_key", "n_shingles", "marks"])


def _roots(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``count`` rows reaches over the links i-j."""
    root = np.arange(count)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (before == root).all():
            break
    return root


def _least(keys: np.ndarray, root: np.ndarray) -> np.ndarray:
    """For each row the one with the smallest key of those with its root.

    A class has the same links in most nodes if the smallest key of what it is tied to stands for it.
    """
    order = np.argsort(keys, kind="stable")[::-1]
    low = np.empty(len(keys), np.int64)
    low[root[order]] = order
    return low[root]


def _alike(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows ordered by piece: candidate links (a, b), and the loose classes a of large nodes (b null) with node, size and parent.

    What it holds is a batch and ``SMALL`` rows more.
    """
    equal = alike(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: tuple | None = None
        head: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            piece, node, total, parent, size = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("piece", "node", "size", "parent", "n_shingles"))
            keys = np.array(batch.column("set_key").to_pylist(), dtype=object)
            values = np.frombuffer(b"".join(batch.column("marks").to_pylist()), np.uint8).reshape(-1, COORDINATES)
            seen = 0
            if tail is not None:
                # the first of the running piece stands before the rows kept of it
                seen = len(head[0]) + len(tail[0])
                piece, keys, size, values, node, total, parent = (np.concatenate(x) for x in zip(head, tail, (piece, keys, size, values, node, total, parent), strict=True))
            begins = np.concatenate(([True], piece[1:] != piece[:-1]))
            pivot = np.maximum.accumulate(np.where(begins, np.arange(len(piece)), 0))
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            pairs = [(pivot, np.arange(len(piece)))] + [(np.arange(max(len(piece) - lag, 0)), np.arange(lag, max(len(piece), lag))) for lag in range(1, SMALL + 1)]
            for i, j in pairs:
                same = (piece[i] == piece[j]) & (i != j)
                near = np.minimum(size[i], size[j]) * 100 >= np.maximum(size[i], size[j]) * percent
                i, j = i[same & near], j[same & near]
                for start in range(0, len(i), 1 << 16):
                    a, b = i[start : start + (1 << 16)], j[start : start + (1 << 16)]
                    ok = (values[a] == values[b]).sum(axis=1) >= equal
                    left.append(a[ok])
                    right.append(b[ok])
            root = _roots(len(piece), np.concatenate(left), np.concatenate(right))
            least = _least(keys, root)
            linked = np.flatnonzero(least != np.arange(len(piece)))
            loose = np.flatnonzero((total > SMALL) & (root != root[pivot]) & (np.arange(len(piece)) >= seen))
            both = np.concatenate((linked, loose))
            columns = (
                pa.array(keys[least[linked]].tolist() + keys[loose].tolist(), pa.binary()),
                pa.array(keys[linked].tolist() + [None] * len(loose), pa.binary()),
                *(pa.array(x[both], mask=np.arange(len(both)) < len(linked)) for x in (node, total, parent)),
            )
            yield pa.record_batch(list(columns), names=["a", "b", "node", "size", "parent"])
            last = int(pivot[-1])
            keep = max(last + 1, len(piece) - SMALL)
            head = tuple(x[last : last + 1] for x in (piece, keys, size, values, node, total, parent))
            tail = tuple(x[keep:] for x in (piece, keys, size, values, node, total, parent))

    return run


def _meet(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidate links (a, b) between the loose classes (``host`` 0) of each block and its others, which come after them."""
    equal = alike(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, held = None, ([], [], [])  # keys, sizes and marks of the loose classes of a block
        for batch in batches:
            a, b = [], []
            block = batch.column("block").to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))[: len(block)]
            for low, high in zip(begins.tolist(), [*begins[1:].tolist(), len(block)], strict=True):
                if block[low] != running:
                    running, held = block[low], ([], [], [])
                part = batch.slice(low, high - low)
                host = part.column("host").to_numpy(zero_copy_only=False).astype(np.int64)
                keys = part.column("set_key").to_pylist()
                size = part.column("n_shingles").to_numpy(zero_copy_only=False).astype(np.int64)
                values = np.frombuffer(b"".join(part.column("marks").to_pylist()), np.uint8).reshape(-1, COORDINATES)
                for k in np.flatnonzero(host == 0).tolist():
                    for kept, one in zip(held, (keys[k], size[k], values[k]), strict=True):
                        kept.append(one)
                others = np.flatnonzero(host == 1)
                first = len(held[0])
                names = held[0] + [keys[k] for k in others.tolist()]
                size, values = size[others], values[others]
                left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for k, (n, own) in enumerate(zip(*held[1:], strict=True)):
                    near = np.flatnonzero(np.minimum(size, n) * 100 >= np.maximum(size, n) * percent)
                    near = near[(values[near] == own).sum(axis=1) >= equal]
                    left, right = np.concatenate((left, np.full(len(near), k))), np.concatenate((right, near + first))
                    if len(left) > 1 << 18 or k == first - 1:
                        # at most one link for each class goes on
                        least = _least(np.array(names, dtype=object), _roots(len(names), left, right))
                        right = np.flatnonzero(least != np.arange(len(names)))
                        left = least[right]
                a += [names[k] for k in left.tolist()]
                b += [names[k] for k in right.tolist()]
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    begins = np.concatenate(([True], joined[1:] != joined[:-1])) if len(joined) else np.zeros(0, bool)
    column = np.cumsum(begins) - 1
    shared = np.bincount(column, minlength=1)[column] > 1 if len(column) else begins
    column, owner = column[shared], owner[shared]
    out = np.zeros((len(sets), len(sets)), np.float64)
    edges = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1]))) if len(column) else np.zeros(0, np.int64)
    for start in range(0, len(edges), 8192):
        low = edges[start]
        high = edges[start + 8192] if start + 8192 < len(edges) else len(column)
        grid = np.zeros((len(sets), min(8192, len(edges) - start)), np.float32)
        number = np.searchsorted(edges, np.arange(low, high), side="right") - 1 - start
        grid[owner[low:high], number] = 1
        out += grid @ grid.T
    return out.astype(np.int64)


def _confirm(size: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Confirmed links (a, b) of rows (group, set_key, text) ordered by group; a group is a block of bounded size."""

    def links(rows: dict[bytes, np.ndarray]) -> tuple[list[bytes], list[bytes]]:
        keys = sorted(rows)
        sets = [rows[k] for k in keys]
        if len(keys) < 2:
            return [], []
        common = overlaps(sets)
        n = np.array([len(s) for s in sets])
        i, j = np.nonzero(np.triu(100 * common >= percent * (n[:, None] + n[None, :] - common), 1))
        root = _roots(len(keys), i, j)
        tied = np.flatnonzero(root != np.arange(len(keys)))
        return [keys[root[x]] for x in tied], [keys[x] for x in tied]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, {}
        for batch in batches:
            a, b = [], []
            for part in slices(batch, "text"):
                found = words(texts_of(part.column("text")))
                for k, (own, key) in enumerate(zip(part.column("block").to_pylist(), part.column("set_key").to_pylist(), strict=True)):
                    if own != group:
                        for out, more in zip((a, b), links(rows), strict=True):
                            out += more
                        group, rows = own, {}
                    if key not in rows:
                        members = set_of(found.hashes[found.first[k] : found.first[k + 1]], size)
                        if set_key(members) == key:  # not so if another row has the same doc_id
                            rows[key] = members
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
        a, b = links(rows)
        yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _ordered(df: DataFrame, by: str, *more: str) -> DataFrame:
    return df.repartition(by).sortWithinPartitions(by, *more)


def _pieces(compared: DataFrame, cut: bool) -> DataFrame:
    """The rows to compare, dealt into pieces of bounded size (``cut``: a node needs several), in the order in which they are compared."""
    # the order of the marks begins at another coordinate in every node; it does not travel with the rows
    at = F.pmod("node", F.lit(COORDINATES)).cast("int")
    turned = F.concat(F.expr(f"substring(marks, cast(pmod(node, {COORDINATES}) + 1 as int))"), F.substring("marks", F.lit(1), at))
    pieces = F.ceil(F.col("size") / PIECE)
    columns = ["node", "size", "parent", "set_key", "n_shingles", "marks"]
    both = compared.select(*columns, F.pmod(F.xxhash64("set_key"), pieces).alias("part"), F.lit(1).alias("rank"))
    if cut:
        large = compared.where(F.col("size") > PIECE)
        first = large.groupBy("node", "size", "parent").agg(F.min(F.struct(turned.alias("turned"), "set_key", "n_shingles", "marks")).alias("first"))
        every = F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("part")
        both = both.unionByName(first.select("node", "size", "parent", "first.set_key", "first.n_shingles", "first.marks", every, F.lit(0).alias("rank")))
    both = both.withColumn("piece", F.xxhash64("node", "part")).drop("part")
    return both.repartition("piece").sortWithinPartitions("piece", "rank", turned).select("piece", *columns)


def _rest(ended: DataFrame, loose: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links of the ``loose`` (node, set_key) classes with all classes of their nodes in ``ended`` (node, size, n, set_key), of which ``n`` are loose."""
    chunks = F.ceil(F.col("n") / CHUNK)
    whole = ended.join(classes, "set_key")
    pieces = F.ceil(F.col("size") / PIECE)
    part, chunk = F.pmod(F.xxhash64("set_key"), pieces), F.pmod(F.xxhash64("set_key", F.lit(1)), chunks)
    every = F.sequence(F.lit(0).cast("long"), chunks - 1)
    hosts = whole.select("node", "set_key", "n_shingles", "marks", F.lit(1).alias("host"), part.alias("part"), F.explode(every).alias("chunk"))
    asked = ended.join(loose, ["node", "set_key"], "left_semi").join(classes, "set_key")
    every = F.sequence(F.lit(0).cast("long"), pieces - 1)
    asked = asked.select("node", "set_key", "n_shingles", "marks", F.lit(0).alias("host"), F.explode(every).alias("part"), chunk.alias("chunk"))
    both = hosts.unionByName(asked).withColumn("block", F.xxhash64("node", "part", "chunk"))
    rows = _ordered(both, "block", "host").select("block", "host", "set_key", "n_shingles", "marks")
    return rows.mapInArrow(_meet(percent), "a binary, b binary")


def _candidates(classes: DataFrame, percent: int, trees: int, depth: int, folders: list[str]) -> DataFrame:
    """Links between classes that share a node and look alike; a link may come more than once."""
    spark = classes.sparkSession

    def keep(df: DataFrame, label: str) -> DataFrame:
        df, folder = saved(df, label)
        folders.append(folder)
        return df

    marked = classes.mapInArrow(_marks, "set_key binary, n_shingles long, marks binary")
    branch = "node long, set_key binary, parent long"
    begin = min(FIRST, depth)
    rows, folder = saved(classes.select("set_key", "minwise").mapInArrow(_branch(trees, percent, begin), branch), "nodes")
    found, whole, open_classes = [], [], []
    for level in range(begin, max(begin, DEEPEST) + 1):
        sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        sized = keep(rows.join(sizes, "node").select("node", "size", "parent", "set_key"), "sized")
        drop_folders(spark, folder)
        release(spark)
        cut = sized.where(F.col("size") > PIECE).limit(1).count() > 0
        compared = _pieces(sized.join(marked, "set_key"), cut).mapInArrow(_alike(percent), "a binary, b binary, node long, size long, parent long")
        compared = keep(compared, "compared")
        found.append(compared.where("b IS NOT NULL").select("a", "b"))
        loose = compared.where("b IS NULL")
        # up to depth every node with many loose classes branches; beyond it those that are no longer mostly whole
        further = F.col("n") > SMALL
        if level >= depth:
            further = further & (F.col("size") * 4 <= F.col("parent") * 3)
        if level >= DEEPEST:
            further = F.lit(False)
        state = loose.groupBy("node").agg(F.count("*").alias("n"), F.first("size").alias("size"), F.max("parent").alias("parent"))
        state = keep(state.select("node", "n", further.alias("further")), "state")
        ends, goes_on = state.agg(F.count_if(~F.col("further")), F.count_if("further")).first()
        if ends:
            ending = state.where("NOT further").select("node", "n")
            whole.append(sized.drop("parent").join(ending, "node"))
            open_classes.append(loose.select("node", F.col("a").alias("set_key")))
        if not goes_on:
            break
        on = sized.join(state.where("further").select("node"), "node", "left_semi").join(classes, "set_key")
        rows, folder = saved(on.select("node", "size", "set_key", "minwise").mapInArrow(_branch(None, percent), branch), "nodes")
    if whole:
        ended = keep(reduce(DataFrame.unionByName, whole).select("node", "size", "n", "set_key"), "ended")
        rest = _rest(ended, reduce(DataFrame.unionByName, open_classes), marked, percent)
        found.append(keep(rest, "rest"))
        release(spark)
    return reduce(DataFrame.unionByName, found)


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80, trees: int | None = None, depth: int = 3) -> DataFrame:
    """Groups of near duplicates among rows (doc_id, text); further columns are ignored.

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets of
    ``shingle`` consecutive words (fewer words: all of them as one shingle). Returns doc_id,
    n_shingles, component_id (the smallest doc_id that links reach) and kept (doc_id is that id).
    ``percent`` is 50 to 100; ``trees`` follows from it if it is not given.

    A null or empty text, or one of white space, has no shingles, is linked with nothing and keeps
    its own id. Equal sets are always linked. A row without doc_id takes part, never lends its id
    where another has one, and is kept only if its whole group has none. Rows with equal doc_id are
    one document in the result's terms: each row is returned. An empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be 50 to 100")
    small_batches(df.sparkSession)
    trees = trees or trees_for(percent, depth)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folders: list[str] = []
    features, folder = saved(rows.mapInArrow(_features(shingle), _FEATURES), "features")
    try:
        tied = _tied(rows, features, shingle, percent, trees, depth, folders)
        least = features.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("least"))
        roots = least.join(tied.withColumnRenamed("node", "set_key"), "set_key", "left")
        roots = roots.select("set_key", "least", F.coalesce("root", "set_key").alias("root"))
        own = roots.groupBy("root").agg(F.min("least").alias("component"))
        groups, kept = saved(roots.join(own, "root").select("set_key", "component"), "groups")
    finally:
        drop_folders(df.sparkSession, *folders)
    joined = features.select("doc_id", "n_shingles", "set_key").join(groups, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _tied(rows: DataFrame, features: DataFrame, shingle: int, percent: int, trees: int, depth: int, folders: list[str]) -> DataFrame:
    """The smallest class (root) that each class with links (node) reaches."""

    def keep(df: DataFrame, label: str) -> DataFrame:
        df, folder = saved(df, label)
        folders.append(folder)
        return df

    def joined_up(edges: DataFrame) -> DataFrame:
        out, folder = components(edges)
        folders.append(folder)
        return out

    classes = features.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("minwise").alias("minwise")
    )
    classes = keep(classes, "classes")
    before = len(folders)
    groups = joined_up(_candidates(classes.select("set_key", "n_shingles", "minwise"), percent, trees, depth, folders))
    drop_folders(rows.sparkSession, *folders[before:-1])
    del folders[before:-1]
    member = groups.withColumnRenamed("node", "set_key").join(classes.drop("minwise"), "set_key")
    # how many blocks a candidate group needs, and the classes that stand in all of them
    weight = member.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("load"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("load") / BLOCK_SHINGLES))
    member = member.join(weight.select("root", blocks.alias("blocks")), "root")
    member = member.withColumn("at", F.xxhash64("set_key"))
    texts = rows.withColumnRenamed("doc_id", "id")
    member = keep(
        texts.join(member.hint(LARGE_JOIN), texts["id"].eqNullSafe(member["doc_id"])).select("root", "set_key", "blocks", "at", "n_shingles", "text"),
        "members",
    )
    release(rows.sparkSession)
    large = member.where("blocks > 1")
    dealt = member.withColumn("part", F.pmod("at", "blocks")).select("root", "set_key", "part", "text")
    pivot_rows = large.join(_pivots(large), ["root", "set_key"])
    shared = pivot_rows.select("root", "set_key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part"), "text")
    dealt = dealt.unionByName(shared).withColumn("block", F.xxhash64("root", "part"))
    link = "a binary, b binary"
    ordered = dealt.select("block", "set_key", "text")
    edges = keep(_ordered(ordered, "block").mapInArrow(_confirm(shingle, percent), link), "links")
    release(rows.sparkSession)
    if large.select(F.lit(1)).limit(1).count() == 0:
        return joined_up(edges)
    # classes of large groups that are not tied to the group's largest component meet every block
    first = joined_up(edges).withColumnsRenamed({"root": "component", "node": "set_key"})
    state = large.join(first, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    count = state.groupBy("root", "component").agg(F.count("*").alias("n"))
    largest = count.groupBy("root").agg(F.max(F.struct("n", "component")).alias("top"))
    loose = state.join(largest, "root").where("component <> top.component").select("root", "set_key", "blocks", "at", "n_shingles", "text")
    loose = keep(loose, "loose")
    chunks = loose.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("load"))
    number = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("load") / BLOCK_SHINGLES))
    chunks = chunks.select("root", number.alias("chunks"))
    loose = loose.join(chunks, "root").withColumn("chunk", F.pmod(F.xxhash64("at"), "chunks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part")
    meet = loose.select("root", "chunk", every, "set_key", "text")
    hosts = large.join(chunks, "root").select("root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.pmod("at", "blocks").alias("part"), "set_key", "text")
    again = meet.unionByName(hosts).select(F.xxhash64("root", "chunk", "part").alias("block"), "set_key", "text")
    more = _ordered(again, "block").mapInArrow(_confirm(shingle, percent), link)
    return joined_up(keep(edges.unionByName(more), "links"))


def _pivots(large: DataFrame) -> DataFrame:
    """The ``PIVOTS`` classes of each group that come first in hash order."""
    order = Window.partitionBy("root").orderBy("at", "set_key")
    ranked = large.select("root", "at", "set_key").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= PIVOTS).select("root", "set_key")
