import math

import pytest

from corpusloom.functions.vectors import embed_fake


def expected(text, dim):
    fold = 0.0
    for i, byte in enumerate(text.encode()):
        fold += byte * (i + 1.0) * 0.001
    return [math.sin((fold + j) * 0.01) for j in range(dim)]


def test_values(spark):
    texts = ["hello world", "", "héllo – 日本", "x" * 5000, None, "hello world"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r["v"] for r in df.select("i", embed_fake("text", 6).alias("v")).orderBy("i").collect()]
    for text, vector in zip(texts, got):
        assert vector == (None if text is None else pytest.approx(expected(text, 6), abs=1e-12))


def test_lengths(spark):
    df = spark.createDataFrame([("hello",), ("world",), (None,)], "text string")
    sizes = [len(r[0]) for r in df.where("text is not null").select(embed_fake("text", 384)).collect()]
    assert sizes == [384, 384]
    assert [r[0] for r in df.select(embed_fake("text", 0)).collect()] == [[], [], None]
    assert df.select(embed_fake("text", 2, null_compat=True)).collect()[2][0] == []


def test_negative_dimension():
    with pytest.raises(ValueError):
        embed_fake("text", -1)
