"""Packing by power-of-two decomposition: no sequence crosses documents and none is padded.

A document's token ids, closed by an end id, are split into pieces of ``max_length`` and then of the
lengths that the binary digits of the rest name, longest first. Each piece is a sequence of its own,
and pieces of equal length are a bucket from which batches of one length can be drawn.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import slices, small_batches, texts_of

MAX_LENGTH = 1024
END_ID = 0
PART_CHARS = 1 << 20

# The split patterns of byte-level BPE; the short one is equal where no two white spaces meet.
FULL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SHORT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"

_TWO_SPACES = re.compile(r"[\s\x1c-\x1f\x85]{2}")
_BETWEEN_WORDS = re.compile(r"(?<=[a-z]) (?=[a-z])")


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a text as the tokenizers library gives them for the file, special strings included.

    A plain byte-level BPE file whose ids are in the order of its merges is read into tiktoken, which
    gives the same ids several times faster; any other file goes to its own library.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, added = spec["model"], spec["added_tokens"]
    letters = byte_letters()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    own = {token: i for token, i in model["vocab"].items() if i not in {a["id"] for a in added}}
    ordered = all(own.get(a + b) == 256 + i for i, (a, b) in enumerate(merges)) and len(own) == 256 + len(merges)
    before = spec["pre_tokenizer"] or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    simple = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]) for a in added)
    if not (ordered and plain and simple and spec["normalizer"] is None and not model.get("end_of_word_suffix")):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        return lambda text: library.encode(text, add_special_tokens=False).ids
    import tiktoken

    ranks = {bytes(letters[c] for c in token): i for token, i in own.items()}
    full, short = (tiktoken.Encoding(path, pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (FULL, SHORT))
    special = {a["content"]: a["id"] for a in added}
    cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None

    def plain_ids(text: str) -> list[int]:
        which = full if _TWO_SPACES.search(text) else short
        if len(text) <= PART_CHARS:
            return which.encode_ordinary(text)
        out, start = [], 0
        while start < len(text):
            border = _BETWEEN_WORDS.search(text, start + PART_CHARS)
            stop = border.start() if border else len(text)
            out += which.encode_ordinary(text[start:stop])
            start = stop
        return out

    def ids(text: str) -> list[int]:
        if cut is None or not cut.search(text):
            return plain_ids(text)
        out: list[int] = []
        for part in cut.split(text):
            out += [special[part]] if part in special else plain_ids(part) if part else []
        return out

    return ids


def piece_lengths(total: int, max_length: int) -> list[int]:
    """``max_length`` as often as it fits, then the powers of two that make up the rest."""
    rest = total % max_length
    bits = [1 << k for k in range(max_length.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [max_length] * (total // max_length) + bits


def _pieces(path: str, max_length: int, end_id: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows, starts, lengths, checks, totals, tokens = [], [], [], [], [], []
                for k, text in enumerate(texts_of(part.column("text")).to_pylist()):
                    ids = array("I", encode(text))
                    ids.append(end_id)
                    raw, at = memoryview(np.frombuffer(ids, np.uint32).astype("<u4")).cast("B"), 0
                    for length in piece_lengths(len(ids), max_length):
                        piece = raw[4 * at : 4 * (at + length)]
                        rows.append(k)
                        starts.append(at)
                        lengths.append(length)
                        checks.append(zlib.crc32(piece))
                        totals.append(len(ids))
                        if with_ids:
                            tokens.append(np.frombuffer(piece, "<i4"))
                        at += length
                count = len(rows)
                columns = [part.column("doc_id").take(pa.array(rows, pa.int64()))]
                columns += [pa.array(x, pa.int64()) for x in (starts, lengths, checks, totals, range(number, number + count), [0] * count, lengths)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket"]
                if with_ids:
                    columns.append(pa.array(tokens, pa.list_(pa.int32())))
                    names.append("ids")
                number += count
                yield pa.record_batch(columns, names=names)

    return run


def pack_documents(df: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Split the documents (doc_id, text) into sequences whose lengths are powers of two.

    Returns a row per piece: doc_id, start (the document's ids before it), length, ids_crc32 (of the
    ids as little-endian unsigned 32-bit numbers), doc_tokens (all ids, the end id included),
    sequence_id, offset (always 0: a piece is a sequence), bucket (its length) and, with ``with_ids``,
    the ids. ``tokenizer`` is the path of a tokenizers file that all executors can read.

    A null or empty text is the end id alone. Each row is a document, also where ids are missing or
    repeated. Sequence numbers are unique in one evaluation, so write the result before it is joined.
    An empty table gives no rows. Further columns are ignored. There is no shuffle.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    small_batches(df.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, bucket long"
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, max_length, end_id, with_ids), schema + ", ids array<int>" * with_ids)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Write pieces as Parquet with one folder per length, so that a reader draws batches of one length."""
    pieces.sortWithinPartitions("bucket").write.partitionBy("bucket").parquet(folder)
