"""Benchmark decontamination by spaced seeds.

A mask looks at some of the words of a window and ignores the others, so that a substituted word at
an ignored place does not break the match. The hashes of all masked windows of the test items are
joined with those of every training document; around each hit the item is laid over the document and
the longest stretch that agrees in enough words is taken. The masks below meet every stretch of 13
words or more of which four fifths agree: one of 26 words or more holds such a stretch of half its
length, and the tests try all placements of substitutions in 13 to 25 words. An item that must agree
as a whole is cut into two parts more than words may differ; each choice of two parts is a mask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import Words, mix, words
from corpusloom.llm.common import slices, small_batches, texts_of

MASKS = ("1101111", "11010001011", "1110001000101")
MIN_WORDS = 13
AGREE = 0.8
BLOCK_BYTES = 8 << 20
_PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_FILTER_BITS = 22
_EXPANDED = 1 << 20  # hits held at once
_COMPARED = 1 << 20  # words compared at once
LEAST_ITEM = 3
SPACE = r"[\x20\x09-\x0D]+"


def seeds(hashes: np.ndarray, mask: str, salt: int) -> np.ndarray:
    """The hash of each window of ``hashes`` under ``mask``."""
    count = max(0, len(hashes) - len(mask) + 1)
    out = np.zeros(count, np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out += hashes[k : k + count] * _PLACES[k % 64] + np.uint64(k)
    return mix(out + np.uint64(salt))


def may_differ(n: int, agree: float) -> int:
    """How many of ``n`` words may differ where ``agree`` of them must be equal."""
    return int(n - np.ceil(round(agree * n, 9)))


def stretch_masks(min_words: int, agree: float) -> tuple[str, ...]:
    """Masks that meet every stretch of at least ``min_words`` words of which ``agree`` are equal."""
    if min_words >= MIN_WORDS and agree >= AGREE:
        return MASKS
    # a longer stretch holds one of less than twice min_words; k differing words leave a run of so many
    lengths = range(max(1, min_words), 2 * max(1, min_words))
    return ("1" * min(64, *(-(-(n - k) // (k + 1)) for n, k in ((n, may_differ(n, agree)) for n in lengths)), 64),)


def whole_masks(n: int, agree: float) -> list[str]:
    """Masks of ``n`` words that meet any text of ``n`` words of which ``agree`` are equal."""
    parts = min(may_differ(n, agree) + 2, n)
    need = max(1, parts - may_differ(n, agree))  # parts that are left whole
    border = [n * k // parts for k in range(parts + 1)]
    return ["".join(("1" if k in chosen else "0") * (border[k + 1] - border[k]) for k in range(parts)) for chosen in combinations(range(parts), need)]


class Items(NamedTuple):
    """Test items, and their seeds in order with the item and the place of each."""

    ids: list
    words: list[np.ndarray]
    masks: list[tuple[str, int]]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray


def items_of(ids: list, texts: list[str | None], masks: tuple[str, ...], min_words: int = MIN_WORDS, agree: float = AGREE) -> Items:
    found = words(texts_of(pa.array(texts, pa.string())))
    own = [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    # an item that must agree as a whole has masks of its own length, each with one place
    lengths = [(len(w) if len(w) <= min_words else 0) for w in own]
    used = [(m, i, 0) for i, m in enumerate(masks)]
    for n in sorted({len(w) for w in own if 0 < len(w) <= min_words}):
        used += [(m, 1000 + len(used) + k, n) for k, m in enumerate(whole_masks(n, agree))]
    all_seeds, item, place = [], [], []
    for mask, salt, length in used:
        for k, w in enumerate(own):
            if len(w) and lengths[k] == length:
                s = seeds(w, mask, salt)
                all_seeds.append(s)
                item.append(np.full(len(s), k))
                place.append(np.arange(len(s)))
    joined = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((all_seeds, np.uint64), (item, np.int64), (place, np.int64))]
    order = np.argsort(joined[0], kind="stable")
    return Items(ids, own, [(m, salt) for m, salt, _ in used], *(x[order] for x in joined))


def longest_stretch(same: np.ndarray, agree: float) -> tuple[int, int]:
    """Start and stop of the longest stretch in which at least ``agree`` of the places agree."""
    sums = np.concatenate(([0.0], np.cumsum(same - agree))).round(9)
    low = np.minimum.accumulate(sums)
    high = np.maximum.accumulate(sums[::-1])[::-1]
    # for each start that is a new low, the last stop whose sum is not below it
    starts = np.flatnonzero(np.concatenate(([True], sums[1:] < low[:-1])))
    stops = np.searchsorted(-high, -sums[starts], side="right") - 1
    best = int(np.argmax(stops - starts))
    return int(starts[best]), int(stops[best])


def best_stretch(own: np.ndarray, test: np.ndarray, shifts: np.ndarray, agree: float, min_words: int) -> tuple[int, int, int] | None:
    """(words, equal words, first word in ``own``) of the longest stretch over all ``shifts`` of ``test``; None if too short.

    Where all that lies over each other agrees in enough words, as in texts that repeat themselves, that is
    the stretch of a shift; others are looked at one by one, as long as they may hold a longer one.
    """
    least = min(min_words, len(test))
    best: tuple[int, int, int] | None = None
    step = max(1, _COMPARED // max(1, len(test)))
    for at in range(0, len(shifts), step):
        some = shifts[at : at + step]
        places = some[:, None] + np.arange(len(test))
        same = (places >= 0) & (places < len(own))
        same &= own[np.clip(places, 0, len(own) - 1)] == test
        equal = same.sum(axis=1)
        left, right = np.maximum(0, -some), np.minimum(len(test), len(own) - some)
        size = right - left
        whole = (equal - agree * size).round(9) >= 0
        fits = np.flatnonzero(whole & (size >= least))
        if len(fits):
            k = fits[np.lexsort((left[fits] + some[fits], equal[fits], size[fits]))[-1]]
            hit = int(size[k]), int(equal[k]), int(left[k] + some[k])
            best = hit if best is None else max(best, hit)
        longest = np.floor(equal / agree + 1e-6)
        rest = np.flatnonzero(~whole & (longest >= least))
        for k in rest[np.argsort(-longest[rest], kind="stable")]:
            if best and longest[k] < best[0]:
                break
            b, e = longest_stretch(same[k, left[k] : right[k]].astype(float), agree)
            if e - b >= least:
                hit = int(e - b), int(same[k, left[k] + b : left[k] + e].sum()), int(left[k] + b + some[k])
                best = hit if best is None else max(best, hit)
    return best


def _laid_over(found: Words, items: Items, likely: np.ndarray) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """For each row and item that share a seed, where in the row the item's first word would lie.

    Hits are expanded in blocks and each place is kept once, so a text that repeats itself holds no
    more than its own words and those of the item, however many of their seeds are equal.
    """
    span = len(found.hashes) + max((len(w) for w in items.words), default=0) + 1
    known, fresh, held = np.zeros(0, np.int64), [], 0
    for mask, salt in items.masks:
        own = seeds(found.hashes, mask, salt)
        at = np.flatnonzero(likely[own >> np.uint64(64 - _FILTER_BITS)])
        row = np.searchsorted(found.first, at, side="right") - 1
        inside = at + len(mask) <= found.first[row + 1]
        at, row = at[inside], row[inside]
        low, high = (np.searchsorted(items.seeds, own[at], side=s) for s in ("left", "right"))
        at, row, low, many = (x[high > low] for x in (at, row, low, high - low))
        before = np.concatenate(([0], np.cumsum(many)))
        start = 0
        while start < len(at):
            stop = max(start + 1, int(np.searchsorted(before, before[start] + _EXPANDED, side="right")) - 1)
            each = many[start:stop]
            k = np.repeat(low[start:stop] - (before[start:stop] - before[start]), each) + np.arange(before[stop] - before[start])
            pair = np.repeat(row[start:stop], each) * len(items.words) + items.item[k]
            fresh.append(np.unique(pair * span + np.repeat(at[start:stop], each) - items.place[k] + (span - len(found.hashes) - 1)))
            held += len(fresh[-1])
            if held > max(_EXPANDED, len(known)):
                known, fresh, held = np.unique(np.concatenate([known, *fresh])), [], 0
            start = stop
    known = np.unique(np.concatenate([known, *fresh]))
    pairs, place = np.divmod(known, span)
    place -= span - len(found.hashes) - 1
    border = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1], [True]))) if len(pairs) else np.zeros(1, np.int64)
    for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
        r, item = divmod(int(pairs[a]), len(items.words))
        yield (r, item), place[a:b] - found.first[r]


def _overlaps(sent: Broadcast, min_words: int, agree: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = sent.value
        likely = np.zeros(1 << _FILTER_BITS, bool)
        likely[items.seeds >> np.uint64(64 - _FILTER_BITS)] = True
        for batch in batches:
            for part in slices(batch, "text"):
                found = words(texts_of(part.column("text")))
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for (r, item), shifts in _laid_over(found, items, likely):
                    own = found.hashes[found.first[r] : found.first[r + 1]]
                    if hit := best_stretch(own, items.words[item], shifts, agree, min_words):
                        best[r, item] = hit
                rows = sorted(best)
                columns = [
                    part.column("doc_id").take(pa.array([r for r, _ in rows], pa.int64())),
                    pa.array([items.ids[i] for _, i in rows], pa.int64()),
                    *(pa.array([best[k][n] for k in rows], pa.int64()) for n in (2, 0, 1)),
                    pa.array([len(items.words[i]) for _, i in rows], pa.int64()),
                ]
                keys = pa.array([r for r, _ in rows], pa.int64())
                yield pa.record_batch([*columns, keys], names=["doc_id", "item_id", "first_word", "n_words", "n_equal", "item_words", "row"]), part

    return run


def _items(df: DataFrame, benchmark: DataFrame, masks: tuple[str, ...], min_words: int, agree: float) -> Iterator[Broadcast]:
    """The test items in blocks of bounded size, each sent to all executors."""
    small_batches(df.sparkSession)
    tests = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = tests.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    for block in range(blocks):
        own = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        own.sort(key=lambda r: (r.item_id is None, r.item_id or 0, r.text or ""))
        yield df.sparkSession.sparkContext.broadcast(items_of([r.item_id for r in own], [r.text for r in own], masks, min_words, agree))


def _limits(masks: tuple[str, ...], agree: float) -> None:
    if not 0 < agree <= 1 or not masks or any(set(m) - {"0", "1"} or "1" not in m or len(m) > 64 for m in masks):
        raise ValueError("agree must be in (0, 1] and masks strings of 0 and 1")


def benchmark_overlaps(df: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] | None = None, min_words: int = MIN_WORDS, agree: float = AGREE) -> DataFrame:
    """Where documents (doc_id, text) repeat test items (item_id, text).

    A row per document and item that overlap in a stretch of at least ``min_words`` words (all words
    of a shorter item), of which at least ``agree`` are equal, lying over each other word for word:
    doc_id, item_id, first_word (of the stretch in the document), n_words and n_equal (of the longest
    such stretch) and item_words. Words are runs without white space, A-Z as a-z. All such overlaps are
    found, unless other ``masks`` are given for items over ``min_words``.

    Null or empty texts overlap with nothing. Each row of documents is judged by itself, also where
    ids are missing or repeated; repeated items are each reported. Empty tables give no rows. Further
    columns are ignored. Texts and items that repeat themselves are laid over each other once for each place. The items go to the executors in blocks of at most 8 MB of text on average,
    one pass over the documents for each block; documents are not shuffled.
    """
    masks = stretch_masks(min_words, agree) if masks is None else masks
    _limits(masks, agree)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_word long, n_words long, n_equal long, item_words long"

    def found(sent: Broadcast) -> DataFrame:
        inner = _overlaps(sent, min_words, agree)

        def only_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for hits, _ in inner(batches):
                yield hits.select(hits.schema.names[:-1])

        return rows.mapInArrow(only_hits, schema)

    return reduce(DataFrame.unionByName, [found(sent) for sent in _items(df, benchmark, masks, min_words, agree)])


def too_short(benchmark: DataFrame, least_item: int = LEAST_ITEM) -> DataFrame:
    """(item_id, n_words) of the test items with fewer than ``least_item`` words, which :func:`decontaminate` passes over.

    Words are runs without white space; null or empty texts have none. Repeated items are each reported.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n_words = F.size(F.filter(F.split(text, SPACE), lambda w: w != "")).cast("long")
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), n_words.alias("n_words")).where(F.col("n_words") < least_item)


def decontaminate(
    df: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] | None = None, min_words: int = MIN_WORDS, agree: float = AGREE, least_item: int = LEAST_ITEM
) -> DataFrame:
    """The rows of ``df``, with all their columns, that overlap with no test item (see above).

    Test items of fewer than ``least_item`` words condemn nothing, as any text may hold so few words;
    :func:`too_short` names them.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    benchmark = benchmark.where(F.size(F.filter(F.split(text, SPACE), lambda w: w != "")) >= least_item)
    masks = stretch_masks(min_words, agree) if masks is None else masks
    _limits(masks, agree)
    for sent in _items(df, benchmark, masks, min_words, agree):
        inner = _overlaps(sent, min_words, agree)

        def clean(batches: Iterator[pa.RecordBatch], inner=inner) -> Iterator[pa.RecordBatch]:
            for hits, part in inner(batches):
                keep = np.ones(part.num_rows, bool)
                keep[hits.column("row").to_numpy()] = False
                yield part.filter(pa.array(keep))

        df = df.mapInArrow(clean, df.schema)
    return df
