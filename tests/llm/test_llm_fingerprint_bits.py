"""Fingerprints and likenesses against a plain computation of both."""

import re
import struct

import duckdb
import pytest
import xxhash

from corpusloom.llm.queries import op9_fingerprints

BINS = 128


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def chained(*parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed=seed)
    return signed(seed)


def fingerprint(text):
    words = [chained(w.encode()) for w in re.split("[\x20\x09-\x0d]+", text.lower()) if w]
    number = [struct.pack("<q", w) for w in words]
    if not words:
        return ""
    shingles = {chained(*number[i : i + 5]) for i in range(len(words) - 4)} or {chained(*number, struct.pack("<i", 1))}
    least = {}
    for value in shingles:
        least[(value >> 57) + 64] = min(value, least.get((value >> 57) + 64, value))
    out = []
    for j in range(BINS):
        at = lambda t: chained(struct.pack("<i", j), struct.pack("<i", t))
        order = [j, *(at(t) % BINS for t in range(8)), *((at(-1) + t * (at(-2) % 64 * 2 + 1)) % BINS for t in range(BINS))]
        out.append(least[next(k for k in order if k in least)] & 255)
    return bytes(out).hex().upper()


def likeness(a, b):
    if not a or not b:
        return float(a == b)
    equal = sum(a[k : k + 2] == b[k : k + 2] for k in range(0, 2 * BINS, 2))
    return max(0.0, (equal / BINS - 1 / 256) / (1 - 1 / 256))


def test_fingerprints_and_likenesses(spark, sf_dir):
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall())
    ids = sorted(docs)
    rows = {r.doc_id: r for r in op9_fingerprints(spark, sf_dir).collect()}
    assert sorted(rows) == ids
    for doc, after in zip(ids, ids[1:] + ids[:1]):
        row, text = rows[doc], docs[doc]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + docs[after][:cut]
        assert row.fingerprint.upper() == fingerprint(text), doc
        assert row.edited_fingerprint.upper() == fingerprint(edited), doc
        assert row.near_edited == pytest.approx(likeness(row.fingerprint, row.edited_fingerprint))
        assert row.near_next == pytest.approx(likeness(row.fingerprint, rows[after].fingerprint))
