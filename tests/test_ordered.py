"""Headings and chunks along keys that fill many sorted parts, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators.html import chunk_bounds
from corpusloom.operators.ordered import carried_on, carry_table, heading_context, pack_lines


@pytest.mark.parametrize("low, high", [(10, 50), (0, 7), (5, 5), (30, 10), (0, 0)])
def test_carry_tables(low, high):
    rng, limit = random.Random(low + high), max(low, high) + 1
    for _ in range(60):
        counts = [rng.choice([0, 0, 1, 3, 10, 10, 60]) for _ in range(rng.randint(1, 40))]
        table = carry_table(np.array(counts), low, high)
        for start in range(limit + 3):
            words, closed = start, 0
            for count in counts:
                if words + count > high and words >= low:
                    words, closed = 0, closed + 1
                words += count
            after, n = carried_on(table, start, limit)
            assert (after, n) == (min(words, limit), closed)


def lines_of(seed, keys, size):
    rng = random.Random(seed)
    rows = []
    for key in keys:
        n = size if key == "hot" else rng.randint(1, 30)
        for k in range(n):
            rows.append((key, k, " ".join(["w"] * rng.choice([0, 1, 2, 5, 12, 12])) if rng.random() < 0.95 else None, rng.choice([None, None, None, 1, 2, 3, 6])))
    return rows


KEYS = ["a", None, "hot", "b", "c", "z"]


def packed(rows, low, high):
    out = []
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1])
        texts = [r[2] or "" for r in own]
        for number, (start, size, words) in enumerate(chunk_bounds([len(t.split()) for t in texts], low, high)):
            out.append((key, number, "\n\n".join(texts[start : start + size]).strip(), own[start][3] if size else None, words, size))
    return sorted(out, key=repr)


@pytest.mark.parametrize("low, high", [(10, 50), (0, 7), (40, 20)])
@pytest.mark.parametrize("parts", [1, 7])
def test_chunks(spark, low, high, parts):
    rows = lines_of(low + parts, KEYS, 700)
    df = spark.createDataFrame(rows, "key string, n int, line string, level int").withColumns({c: F.lit(1) for c in ("words", "chunk_id", "rows", "part")})
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        found = pack_lines(df.repartition(5), ["key"], "n", "line", low, high, context=["level"])
        assert sorted(map(tuple, found.collect()), key=repr) == packed(rows, low, high)
        assert found.columns == ["key", "chunk_id", "text", "level", "word_count", "paragraph_count"]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def contexts(rows):
    out = []
    for key in {r[0] for r in rows}:
        now = [""] * 6
        for _, n, line, level in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            if level:
                now[level - 1 :] = [(line or "").strip()] + [""] * (6 - level)
            out.append((key, n, line, level, *now))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_heading_context(spark, parts):
    rows = [(k, n, None if line is None else f" {k}{n} ", level) for k, n, line, level in lines_of(9, KEYS, 500)]
    # one heading far before the parts that it rules
    rows = [r if r[0] != "hot" or r[1] < 3 or r[3] in (None, 3, 6) else (*r[:3], 6) for r in rows] + [("hot", -1, "top", 1)]
    df = spark.createDataFrame(rows, "key string, n int, line string, level int")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        found = heading_context(df.withColumn("h2", F.lit("old")), ["key"], "n", F.col("level"), F.col("line"))
        assert sorted(map(tuple, found.collect()), key=repr) == contexts(rows)
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "key string, n int, line string, level int")
    assert pack_lines(df, ["key"], "n", "line").collect() == []
    assert heading_context(df, ["key"], "n", F.col("level"), F.col("line")).collect() == []
