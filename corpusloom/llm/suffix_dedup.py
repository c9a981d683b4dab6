"""Removal of repeated strings by a suffix sort over sampled suffixes, exact to the byte.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Sorting the suffixes of all positions would move every text
``length`` times, so only suffixes that can matter are sorted:

1. Every window of ``length`` bytes elects the anchor in it: its 20 bytes with the smallest hash, the
   leftmost of equals. Equal windows elect equal anchors. Windows in a row with one anchor are a run,
   about forty positions. Runs, with the hash of the anchor and of the run's whole string, are first
   reduced within a task, then grouped by anchor. An anchor that occurs once ends there. A run whose
   whole string occurred before is removed.
2. What is left are the first of unequal runs around one anchor: the edges of repeats. They are cut
   into windows that lie alike around the anchor, 20 and then 5 at a time; a part goes if the bytes
   that all its windows share occur once. The strings of the others are dealt by sampled splitters into ranges of the suffixes that start at the anchor (its leading
   bytes, then the place, so that one frequent anchor may span many ranges). In its range every
   window is a suffix that is cut at ``length``; a multikey quicksort, eight bytes a step, puts equal
   ones side by side, and all but the first are removed.
3. Across range boundaries: windows of the first and the last anchor of each range, which may go on
   in a neighbour, are compared once more by their bytes.

Nothing is gathered beyond one document's spans, or one range, whose size the splitters bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import buffers, mix
from corpusloom.llm.common import LARGE_JOIN, drop_folders, keyed, release, saved, slices, small_batches, texts_of

ANCHOR = 20
BLOCK = 1 << 19
COMBINE_BYTES = 32 << 20
RANGE_WINDOWS = 1 << 19
_PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(_PRIME, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_RUNS = "anchor long, run long, rid long, place long"


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def runs_of(raw: np.ndarray, offsets: np.ndarray, length: int, tables: dict) -> tuple[np.ndarray, ...]:
    """The runs of the texts in ``raw``: first window, windows, anchor's distance, hash of anchor, of run."""
    reach = length - ANCHOR + 1  # anchors that fit into a window
    found: list[tuple[np.ndarray, ...]] = []
    for low in range(0, len(raw), BLOCK):
        high = min(low + BLOCK, len(raw))  # of the first bytes of windows
        part = raw[low : min(high + length + reach, len(raw))]
        if len(part) < length:
            break
        if len(part) + 1 > len(tables.get("up", ())):
            tables["up"], tables["down"] = _powers(_PRIME, len(part) + 1), _powers(_INVERSE, len(part) + 1)
        up, down = tables["up"], tables["down"]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[: len(part)], out=sums[1:])
        count = len(part) - ANCHOR + 1
        grams = mix((sums[ANCHOR:] - sums[:count]) * down[:count])
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(count, dtype=np.uint64)
        width = 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        anchor = (least[: high - low] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # a window ends in the text in which it starts
        texts = np.arange(np.searchsorted(offsets, low, side="right") - 1, np.searchsorted(offsets, low + len(anchor)))
        inside = np.minimum(offsets[texts + 1], low + len(anchor)) - np.maximum(offsets[texts], low)
        window = np.flatnonzero(np.arange(low + length, low + length + len(anchor)) <= np.repeat(offsets[texts + 1], inside))
        if not len(window):
            continue
        anchor = anchor[window]
        begins = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (np.diff(window) != 1))))
        ends = np.concatenate((begins[1:], [len(window)]))
        first, many, at = window[begins], ends - begins, anchor[begins]
        stop = first + many + length - 1
        whole = mix((sums[stop] - sums[first]) * down[first] + (many * 1024 + at - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        found.append((first + low, many, at - first, grams[at], whole))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _pack(first: np.ndarray, many: np.ndarray, distance: np.ndarray) -> np.ndarray:
    return (first << 20) | (many << 10) | distance


def _runs(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs (first of equal ones in a batch), and with windows 0 the spans that equal ones cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict = {}
        for batch in batches:
            for part in slices(batch, "text", COMBINE_BYTES):
                rid = part.column("rid").to_numpy(zero_copy_only=False).astype(np.int64)
                order = np.argsort(rid, kind="stable")
                texts = texts_of(part.column("text")).take(pa.array(order))
                rid = rid[order]
                raw, offsets = buffers(texts)
                first, many, distance, anchor, whole = runs_of(raw, offsets, length, tables)
                text = np.searchsorted(offsets, first, side="right") - 1
                local = first - offsets[text]
                _, keep = np.unique(whole, return_index=True)
                again = np.ones(len(first), bool)
                again[keep] = False
                # runs that follow one another are one span
                at = np.flatnonzero(again)
                joined = np.zeros(len(at), bool)
                joined[1:] = (text[at[1:]] == text[at[:-1]]) & (local[at[1:]] == local[at[:-1]] + many[at[:-1]])
                heads = np.flatnonzero(~joined)
                tails = np.concatenate((heads[1:], [len(at)]))[: len(heads)] - 1
                begin, stop = at[heads], at[tails]
                size = local[stop] + many[stop] + length - 1 - local[begin]
                span_rid, span_place = rid[text[begin]], _pack(local[begin], 0 * begin, 0 * begin)
                columns = (
                    np.concatenate((anchor[keep].view(np.int64), mix((span_rid ^ span_place).astype(np.uint64)).view(np.int64))),
                    np.concatenate((whole[keep].view(np.int64), size)),
                    np.concatenate((rid[text[keep]], span_rid)),
                    np.concatenate((_pack(local[keep], many[keep], distance[keep]), span_place)),
                )
                yield pa.record_batch([pa.array(c) for c in columns], names=["anchor", "run", "rid", "place"])

    return run


def _contexts(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The strings of undecided runs, with the leading bytes of the suffix at the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                heads, strings, rids, places = [], [], [], []
                rows = zip(part.column("rid").to_pylist(), part.column("text").to_pylist(), part.column("places").to_pylist(), strict=True)
                for rid, text, own in rows:
                    raw = text.encode()
                    for place in own:
                        first, many, distance = place >> 20, (place >> 10) & 1023, place & 1023
                        heads.append(raw[first + distance : first + distance + ANCHOR])
                        strings.append(raw[first : first + many + length - 1])
                        rids.append(rid)
                        places.append(place)
                columns = [pa.array(heads, pa.binary()), pa.array(strings, pa.binary()), pa.array(rids, pa.int64()), pa.array(places, pa.int64())]
                yield pa.record_batch(columns, names=["head", "string", "rid", "place"])

    return run


def _narrowed(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """The rows cut into parts of ``width`` windows; of those, the ones whose shared bytes others have too.

    Parts are counted from the anchor, so that equal windows of different rows lie in equal parts.
    """
    many, distance = F.shiftright("place", 10).bitwiseAND(F.lit(1023)), F.col("place").bitwiseAND(F.lit(1023))
    rows = contexts.select("head", "string", "rid", F.shiftright("place", 20).alias("first"), many.alias("many"), distance.alias("distance"))
    rows = rows.select("*", F.expr(f"explode(sequence((distance - many + 1) div {width}, distance div {width}))").alias("part"))
    rows = rows.withColumn("far", F.least("distance", F.col("part") * width + width - 1)).withColumn("near", F.greatest(F.expr("distance - many + 1"), F.col("part") * width))
    cut = rows.selectExpr(
        "head",
        f"substring(string, int(distance - far + 1), int(far - near + {length})) AS string",
        "rid",
        "shiftleft(first + distance - far, 20) + shiftleft(far - near + 1, 10) + far AS place",
        f"xxhash64(part, substring(string, int(distance - part * {width} + 1), {length - width + 1})) AS core",
    )
    again = cut.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    return cut.join(again.hint(LARGE_JOIN), "core", "left_semi").drop("core")


def equal_suffixes(raw: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``starts`` whose ``length`` bytes are not alone, and the group of equal ones of each.

    A multikey quicksort with eight bytes for a character: each step sorts the rows of a group by the
    next character and goes on with those that are still equal to another.
    """
    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    wide = np.lib.stride_tricks.sliding_window_view(padded, 8)
    row, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    for depth in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        character = np.ascontiguousarray(wide[starts[row] + depth]).view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((character, group))
        row, group, character = row[order], group[order], character[order]
        begins = np.concatenate(([True], (group[1:] != group[:-1]) | (character[1:] != character[:-1])))[: len(row)]
        group = np.cumsum(begins) - 1
        many = np.bincount(group, minlength=1)[group] > 1
        row, group = row[many], group[many]
        if not len(row):
            break
    return row, group


def _resolve(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of one range: spans of windows that occurred before (string null), and windows to compare with other ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        whole = pa.Table.from_batches(rows).combine_chunks()
        heads = whole.column("head").to_pylist()
        raw, offsets = buffers(whole.column("string").combine_chunks().cast(pa.large_binary()))
        rid = whole.column("rid").to_numpy().astype(np.int64)
        place = whole.column("place").to_numpy().astype(np.int64)
        many = (place >> 10) & 1023
        owner = np.repeat(np.arange(len(rid)), many)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
        at = (place >> 20)[owner] + shift
        row, group = equal_suffixes(raw, offsets[owner] + shift, length)
        order = np.lexsort((at[row], rid[owner[row]], group))
        row, group = row[order], group[order]
        again = row[np.concatenate(([False], group[1:] == group[:-1]))[: len(row)]]
        seen = np.zeros(len(owner), bool)
        seen[again] = True
        hits = np.flatnonzero(seen)
        begins = np.flatnonzero(np.concatenate(([True], (owner[hits[1:]] != owner[hits[:-1]]) | (np.diff(hits) != 1)))[: len(hits)])
        ends = np.concatenate((begins[1:], [len(hits)]))[: len(begins)] - 1
        first, last = hits[begins], hits[ends]
        ends_at = {min(heads), max(heads)}
        border = np.array([head in ends_at for head in heads])
        open_ = np.flatnonzero(border[owner] & ~seen)
        base = (offsets[owner] + shift)[open_]
        bytes_ = raw.tobytes()
        strings = [None] * len(first) + [bytes_[b : b + length] for b in base.tolist()]
        columns = [
            pa.array(np.concatenate((rid[owner[first]], rid[owner[open_]]))),
            pa.array(np.concatenate((at[first], at[open_]))),
            pa.array(np.concatenate((at[last], at[open_])) + length),
            pa.array(strings, pa.binary()),
        ]
        yield pa.record_batch(columns, names=["rid", "start", "stop", "string"])

    return run


def _cut(as_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Join the spans of each row and take them out of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                kept, merged, sizes = [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    raw = (text or "").encode()
                    runs: list[list[int]] = []
                    for span in sorted((s["start"], s["stop"]) for s in spans or ()):
                        if runs and span[0] <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], span[1])
                        else:
                            runs.append(list(span))
                    last, pieces = 0, []
                    for start, stop in runs:
                        pieces.append(raw[last:start])
                        last = stop
                    left = b"".join([*pieces, raw[last:]])
                    kept.append(left.decode("utf-8", "ignore") if as_text else left)
                    merged.append([{"start": a, "stop": b} for a, b in runs])
                    sizes.append(len(raw))
                span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(merged, span), pa.array(kept, pa.string() if as_text else pa.binary())]
                yield pa.record_batch([*columns, part.column("carried")], names=["doc_id", "n_bytes", "removed", "kept", "carried"])

    return run


def remove_repeats(df: DataFrame, length: int = 100, carry: Sequence[str] = (), as_text: bool = False) -> DataFrame:
    """Take out of the texts of (doc_id, text) every byte that an earlier string of ``length`` bytes covers.

    Returns doc_id, n_bytes (UTF-8), removed (the maximal spans that went, ``start`` and ``stop`` in
    bytes), kept (the other bytes, joined; a cut may fall inside a character, whose bytes go too if
    ``as_text`` makes kept a string) and carried, a struct of the columns named by ``carry``. Strings
    are judged on the texts as they came and never cross documents.

    A null text is empty; shorter texts than ``length`` lose nothing. Equal rows are documents of
    their own: missing or repeated ids are ordered by (doc_id, text), null first. An empty table
    gives no rows. Further columns are ignored. ``length`` is from 40 to 1000.
    """
    if not 40 <= length <= 1000:
        raise ValueError("length must be from 40 to 1000")
    spark = df.sparkSession
    small_batches(spark)
    carried = F.struct(*(F.col(f"`{c}`") for c in carry), F.lit(None).cast("string").alias("__none")).alias("carried")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = keyed(df.select(F.col("doc_id").cast("long").alias("doc_id"), text, carried), "text")
    runs = rows.select("rid", "text").mapInArrow(_runs(length), _RUNS)
    folders: list[str] = []
    try:
        by_anchor = "(PARTITION BY anchor)"
        ranked = runs.selectExpr(
            "rid", "place",
            "place & 1047552 = 0 AS span", "run",
            "row_number() OVER (PARTITION BY anchor, run ORDER BY rid, place) AS number",
            f"min(run) OVER {by_anchor} <> max(run) OVER {by_anchor} AS unequal",
        )
        kind = F.when(F.col("span"), 0).when(F.col("number") > 1, 1).when(F.col("unequal"), 2)
        marks = ranked.select("rid", "place", F.when(F.col("span"), F.col("run")).alias("size"), kind.alias("kind")).where("kind IS NOT NULL")
        marks, marks_folder = saved(marks, "marks")
        release(spark)
        undecided = marks.where("kind = 2").groupBy("rid").agg(F.collect_list("place").alias("places"))
        found = rows.select("rid", "text").join(undecided.hint(LARGE_JOIN), "rid")
        contexts = found.mapInArrow(_contexts(length), "head binary, string binary, rid long, place long")
        for width in (None, 20, 5):
            contexts, folder = saved(_narrowed(contexts, length, width) if width else contexts, "contexts")
            folders.append(folder)
            release(spark)
        windows = contexts.agg(F.sum(F.shiftright("place", 10).bitwiseAND(F.lit(1023)))).first()[0] or 0
        ranges = contexts.repartitionByRange(windows // RANGE_WINDOWS + 1, "head", "rid", "place")
        resolved, resolved_folder = saved(ranges.mapInArrow(_resolve(length), "rid long, start long, stop long, string binary"), "resolved")
        release(spark)
    finally:
        drop_folders(spark, *folders)
    open_ = resolved.where("string IS NOT NULL")
    earliest = open_.groupBy("string").agg(F.min(F.struct("rid", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    across = open_.join(earliest, "string").where("struct(rid, start) <> first")
    first_byte = F.shiftright("place", 20)
    whole = F.when(F.col("kind") == 0, F.col("size")).otherwise(F.shiftright("place", 10).bitwiseAND(F.lit(1023)) + length - 1)
    spans = marks.where("kind < 2").select("rid", first_byte.alias("start"), (first_byte + whole).alias("stop"))
    spans = spans.unionByName(resolved.where("string IS NULL").select("rid", "start", "stop")).unionByName(across.select("rid", "start", "stop"))
    spans = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = rows.join(spans.hint(LARGE_JOIN), "rid", "left").select("doc_id", "text", "spans", "carried")
    removed = "array<struct<start: bigint, stop: bigint>>"
    kept = "string" if as_text else "binary"
    schema = f"doc_id long, n_bytes long, removed {removed}, kept {kept}, carried {joined.schema['carried'].dataType.simpleString()}"
    cut = joined.mapInArrow(_cut(as_text), schema)
    return cut.withColumn("carried", F.col("carried").dropFields("__none")) if carry else cut.drop("carried")
