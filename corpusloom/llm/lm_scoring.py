"""Scores by cross-entropy difference between a target and a background language model.

Both are bigram models over all words of the corpus. The background counts every document, the target
those named as target. Both are smoothed alike: a bigram's count is filled up with ``prior`` draws
from the model's own unigrams, and these with one draw of each word of the corpus and ``CLASSES`` for
words that it lacks.

A document's score is the mean over its tokens of the target model's loss minus the background's: the
lower, the more it resembles the target.

No table of all words or bigrams is gathered. The documents are dealt into blocks of 16 MB of text. A
block counts its distinct bigrams and words and sends the counts to ranges of their hashes, packed: a
row holds all keys of one block in one range. A range of ``RANGE_TOKENS`` tokens sums the counts of
all blocks and sends the sums back to the blocks whose own counts fall short. Then every block has
all counts of its own words and scores its documents in one task. What moves grows with the text: a
row for each block and range as long as that is less than one for each distinct key of a block, and a
frequent word or bigram is one entry of each block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import Words, buffers, mix, words
from corpusloom.llm.common import LARGE_JOIN, keyed, release, saved, slices, texts_of

PRIOR = 50.0
CLASSES = 64
BLOCK_BYTES = 16 << 20
RANGE_TOKENS = 2 << 20
START = np.uint64(0x3C6EF372FE94F82B)  # what stands before a document's first word
_WORD, _PAIR = np.uint64(0xA54FF53A5F1D36F1), np.uint64(0x9B05688C2B3E6C1F)

_SMALL = "rid long, doc_id long, n_bytes long, small binary"
_PACKED = "block long, part long, size int, keys binary, counts binary"
COUNTS = 4  # of a key: as word or bigram, and as word before another (less the former); of all and of the target
_SCORES = "doc_id long, n_tokens long, target_loss double, background_loss double"


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts compressed, for the way through a shuffle."""
    for batch in batches:
        for part in slices(batch, "text"):
            small = [pa.compress((x or "").encode(), "zstd", asbytes=True) for x in part.column("text").to_pylist()]
            sizes = pa.array(np.diff(buffers(texts_of(part.column("text")))[1]))
            yield pa.record_batch([part.column("rid"), part.column("doc_id"), sizes, pa.array(small, pa.binary())], names=["rid", "doc_id", "n_bytes", "small"])


def _texts(small: pa.Array, sizes: list[int]) -> pa.LargeStringArray:
    found = [pa.decompress(x, n, "zstd", asbytes=True) if n else b"" for x, n in zip(small.to_pylist(), sizes, strict=True)]
    return pa.array(found, pa.large_binary()).cast(pa.large_string())


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each run of documents and how often they occur there, in all and in those of the target."""
    for batch in batches:
        sizes = batch.column("n_bytes").to_pylist()
        start = total = 0
        for stop in range(1, len(sizes) + 1):
            total += sizes[stop - 1]
            if stop == len(sizes) or total + sizes[stop] > BLOCK_BYTES:
                found, target = _documents(pa.Table.from_batches([batch.slice(start, stop - start)]))
                at, word = pd.factorize(found.hashes)
                own = np.repeat(target, np.diff(found.first))
                columns = (word.view(np.int64), np.bincount(at, minlength=len(word)), np.bincount(at[own], minlength=len(word)))
                yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], names=["word", "n", "n_target"])
                start, total = stop, 0


def before_each(found: Words) -> np.ndarray:
    """The word before each word, START for the first of a text."""
    before = np.concatenate(([START], found.hashes[:-1]))[: len(found.hashes)]
    before[found.first[:-1][np.diff(found.first) > 0]] = START
    return before


class Keys(NamedTuple):
    """The distinct words and bigrams of some documents, their counts, and those of each token."""

    keys: np.ndarray  # sorted; a word is its own key, START is one of them
    counts: np.ndarray  # (COUNTS, keys)
    words: np.ndarray  # where the words stand among the keys
    word: np.ndarray  # of each token: its word, as a place in ``words``
    pair: np.ndarray  # of each token: the key of its bigram


def keys_of(found: Words, target: np.ndarray) -> Keys:
    own = np.repeat(target, np.diff(found.first))
    filled = np.flatnonzero(np.diff(found.first))
    before = before_each(found)
    pair = mix(mix(before ^ _PAIR) + found.hashes)
    pairs, n = np.unique(pair, return_counts=True)
    some, m = np.unique(pair[own], return_counts=True)
    word, distinct = pd.factorize(np.append(found.hashes, START))
    order = np.argsort(distinct)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    word = rank[word]
    places = np.searchsorted(pairs, distinct[order]) + np.arange(len(order))
    keys, counts = np.empty(len(pairs) + len(order), np.uint64), np.zeros((COUNTS, len(pairs) + len(order)), np.int64)
    rest = np.ones(len(keys), bool)
    rest[places] = False
    keys[places], keys[rest] = distinct[order], pairs
    counts[0, rest], (at,) = n, np.nonzero(rest)
    counts[1, at[np.searchsorted(pairs, some)]] = m
    start, word = word[-1], word[:-1]
    ends = found.first[1:][filled] - 1
    for k, (tokens, last) in enumerate(((word, word[ends]), (word[own], word[ends[target[filled]]]))):
        counts[k, places] = np.bincount(tokens, minlength=len(order))
        # a word leads as often as it occurs, but at the end of a text; START leads once in each text
        counts[2 + k, places] = -np.bincount(last, minlength=len(order))
        counts[2 + k, places[start]] += len(last)
    return Keys(keys, counts, places, word, pair)


def _zip(values: np.ndarray) -> bytes:
    """Numbers of 64 bits, compressed byte by byte of all of them, as most of the higher bytes are equal."""
    return pa.compress(np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T), "zstd", asbytes=True)


def _unzip(packed: bytes, size: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(packed, 8 * size, "zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(np.int64).ravel()


def _parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each of ``parts`` equal ranges begin, and the end."""
    step = (1 << 64) // parts + 1
    borders = np.array([k * step for k in range(1, parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, borders), [len(keys)]))


def _documents(docs: pa.Table) -> tuple[Words, np.ndarray]:
    """The words of the documents of a block, and which belong to the target."""
    docs = docs.combine_chunks()
    column = docs.column("small").combine_chunks() if docs.num_rows else pa.array([], pa.binary())
    return words(_texts(column, docs.column("n_bytes").to_pylist())), docs.column("target").to_numpy(zero_copy_only=False).astype(bool)


def _sent(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _PACKED.split(", ")])


def _block_counts(parts: int) -> Callable[[pa.Table], pa.Table]:
    """The counts of a block, a row for each range in which it has keys."""

    def run(docs: pa.Table) -> pa.Table:
        own = keys_of(*_documents(docs))
        borders = _parts_of(own.keys, parts)
        block, rows = docs.column("block")[0].as_py(), []
        for k in np.flatnonzero(np.diff(borders)).tolist():
            part = slice(int(borders[k]), int(borders[k + 1]))
            step = np.diff(own.keys[part], prepend=np.uint64(0))
            rows.append((block, k, part.stop - part.start, _zip(step.view(np.int64)), _zip(own.counts[:, part])))
        return _sent(rows)

    return run


def _range_sums(table: pa.Table) -> pa.Table:
    """For each block of a range: the keys of which other blocks have more, by their places, and the sums of their counts."""
    blocks, sizes, part = table.column("block").to_pylist(), table.column("size").to_pylist(), table.column("part")[0].as_py()
    keys = [np.cumsum(_unzip(x, n).view(np.uint64), dtype=np.uint64) for x, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    del keys
    packed, borders = table.column("counts").to_pylist(), np.concatenate(([0], np.cumsum(sizes)))
    total = np.zeros((COUNTS, len(distinct)), np.int64)
    for k, (x, n) in enumerate(zip(packed, sizes, strict=True)):
        total[:, at[borders[k] : borders[k + 1]]] += _unzip(x, COUNTS * n).reshape(COUNTS, n)
    rows = []
    for k, (x, n) in enumerate(zip(packed, sizes, strict=True)):
        sums = total[:, at[borders[k] : borders[k + 1]]]
        less = np.flatnonzero((sums != _unzip(x, COUNTS * n).reshape(COUNTS, n)).any(axis=0))
        rows.append((blocks[k], part, len(less), _zip(np.diff(less, prepend=0)), _zip(sums[:, less])))
    return _sent(rows)


def _scored(parts: int, distinct: int, draws: tuple[float, float], prior: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The losses of the documents of a block, by its own counts and the sums over all blocks."""

    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        found, target = _documents(docs)
        own = keys_of(found, target)
        borders = _parts_of(own.keys, parts)
        for part, size, places, counts in zip(*(sums.column(c).to_pylist() for c in ("part", "size", "keys", "counts")), strict=True):
            own.counts[:, borders[part] + np.cumsum(_unzip(places, size))] = _unzip(counts, COUNTS * size).reshape(COUNTS, size)
        rest = np.ones(len(own.keys), bool)
        rest[own.words] = False
        order = np.argsort(own.pair)
        runs = np.diff(np.flatnonzero(np.concatenate(([True], np.diff(own.pair[order]) != 0))), append=len(order)) if len(order) else order
        filled = np.flatnonzero(np.diff(found.first))
        first = found.first[filled]
        start = np.searchsorted(own.keys[own.words], START)
        lead = np.concatenate(([start], own.word[:-1]))[: len(own.word)]
        lead[first] = start
        means = []
        for k in (1, 0):  # the target, then all
            n, more = own.counts[k][own.words], own.counts[2 + k][own.words]
            pair = np.empty(len(order), np.int64)
            pair[order] = np.repeat(own.counts[k][rest], runs)
            loss = np.log((n + more)[lead] + prior) - np.log(pair + prior * (n[own.word] + 1) / (draws[k] + distinct + CLASSES))
            mean = np.full(docs.num_rows, np.nan)
            if len(filled):
                mean[filled] = np.add.reduceat(loss, first) / np.diff(found.first)[filled]
            means.append(pa.array(mean, from_pandas=True))
        return pa.table([docs.column("doc_id"), pa.array(np.diff(found.first).astype(np.int64)), *means], names=["doc_id", "n_tokens", "target_loss", "background_loss"])

    return run


def score_documents(df: DataFrame, targets: DataFrame, prior: float = PRIOR) -> DataFrame:
    """Score every whole text of (doc_id, text) with models of all of them and of those in ``targets`` (doc_id).

    Returns doc_id, n_tokens, target_loss and background_loss (nats a token) and score, their
    difference. A null or empty text has no tokens and null losses and score. Ids in ``targets`` that
    no document has, and repeated ones, change nothing; without any target document the target model
    is uniform. Each row is counted and scored, also where ids are missing or repeated. An empty table
    gives no rows. Further columns are ignored. Every word counts as itself, however rare. Words and
    bigrams are told apart by 64-bit hashes. A text is scored in one task, whatever its length.
    """
    if prior <= 0:
        raise ValueError("prior must be positive")
    spark = df.sparkSession
    rows = keyed(df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    chosen = targets.select(F.col("doc_id").cast("long").alias("target_id")).where("target_id IS NOT NULL").distinct()
    small = rows.select("rid", "doc_id", "text").mapInArrow(_small, _SMALL)
    marked = small.join(chosen.hint(LARGE_JOIN), F.col("doc_id") == F.col("target_id"), "left")
    marked = marked.select(F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block"), "doc_id", "n_bytes", "small", F.col("target_id").isNotNull().alias("target"))
    docs, _ = saved(marked, "blocks")
    release(spark)
    each = docs.mapInArrow(word_counts, "word long, n long, n_target long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_target").alias("n_target"))
    facts = each.agg(F.count("*").alias("distinct"), F.sum("n").alias("n"), F.sum("n_target").alias("n_target")).first()
    release(spark)
    parts = 1 + int(facts.n or 0) // RANGE_TOKENS
    packed = docs.groupBy("block").applyInArrow(_block_counts(parts), _PACKED)
    sums = packed.groupBy("part").applyInArrow(_range_sums, _PACKED)
    scored = docs.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(_scored(parts, facts.distinct, (float(facts.n or 0), float(facts.n_target or 0)), prior), _SCORES)
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
