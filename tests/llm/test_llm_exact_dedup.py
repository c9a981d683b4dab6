"""Exact duplicates, also where hashes collide."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import exact_dedup
from corpusloom.llm.exact_dedup import exact_duplicates

ROWS = [
    (4, "a  b"), (2, "a\t\nb"), (9, "a b "), (3, None), (7, ""), (None, "a b"), (None, "z"), (None, "z"), (5, "c"), (5, "c"), (6, "a b"), (1, " "),
    (10, "\x0b"), (11, "Z" * 300_000), (12, "Z" * 300_000), (13, "A b"),
]


def brute(rows):
    groups = {}
    for at, (doc, text) in enumerate(rows):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append((doc is None, doc or 0, at, doc))
    out = []
    for text, own in groups.items():
        first = min(own)
        out += [(doc, first[3], len(own), (none, key, at, doc) == first, hashlib.sha256(text.encode()).hexdigest()) for none, key, at, doc in own]
    return sorted(out, key=repr)


HASHES = {"md5": exact_dedup.content_hash, "length": lambda text: F.char_length(text), "one": lambda text: F.lit(1)}


@pytest.mark.parametrize("name", HASHES)
def test_groups_are_those_of_equal_texts(spark, name):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("rid", "hash", "n", "first", "keep_id", "key", "low")})
    found = exact_duplicates(df.repartition(3), HASHES[name])
    assert sorted(map(tuple, found.collect()), key=repr) == brute(ROWS)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_more_groups_than_are_sent(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SENT_GROUPS", 1)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert sorted(map(tuple, exact_duplicates(df).collect()), key=repr) == brute(ROWS)


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    found = exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert "Arrow" not in found._jdf.queryExecution().toString() and "Python" not in found._jdf.queryExecution().toString()
