import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import batches
from corpusloom.operators.batches import (
    batch_arrays,
    batch_size_of,
    dense_batches,
    dense_positions,
    numbered_parts,
)
from corpusloom.sources.arrays import payloads_from_file
from corpusloom.sources.http import batch_bodies, payloads_from_json


def test_positions_are_dense_and_ordered(spark):
    df = spark.range(0, 1000, numPartitions=7).select((999 - F.col("id")).alias("k"))
    rows = dense_positions(df, ["k"]).collect()
    assert sorted((r.position, r.k) for r in rows) == [(i, i) for i in range(1000)]


def test_ties_and_copies_keep_their_order(spark):
    # a third of the rows share one value, and these are exact copies
    df = spark.range(0, 900, numPartitions=5).select(
        "id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("k")
    )
    rows = dense_positions(df, ["k"]).collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.position)] == [
        i for _, i in sorted((5 if i % 3 == 0 else i % 11, i) for i in range(900))
    ]
    copies = df.select(F.lit(1).alias("k"), F.lit("same").alias("payload"))
    assert sorted(r.position for r in dense_positions(copies, ["k"]).collect()) == list(range(900))


def test_a_value_with_many_rows_is_split_over_parts(spark):
    df = spark.range(0, 4000, numPartitions=8).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = numbered_parts(df, ["k"]).groupBy("__part").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3000


def test_without_order_the_rows_stay_as_read(spark):
    df = spark.range(0, 100, numPartitions=4)
    assert all(r.id == r.position for r in dense_positions(df).collect())


def test_batches(spark):
    df = spark.range(0, 25, numPartitions=4)
    sizes = dense_batches(df, ["id"], "10").groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 10), (1, 10), (2, 5)]
    assert dense_batches(df.where("id < 0"), ["id"], 10).collect() == []


def test_many_parts_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(batches, "MAX_BROADCAST_PARTS", 1)
    df = spark.range(0, 100, numPartitions=4).select((99 - F.col("id")).alias("k"))
    assert all(r.position == r.k for r in dense_positions(df, ["k"]).collect())


@pytest.mark.parametrize(
    "value, message",
    [
        ("0", "must be greater than 0"), (0, "must be greater than 0"),
        ("not_a_number", "Invalid batch_size"), (2.7, "Invalid batch_size"), ("1_0", "Invalid batch_size"), (-1, "Invalid batch_size"),
    ],
)
def test_batch_size(value, message):
    with pytest.raises(ValueError, match=message):
        batch_size_of(value)


def test_bodies(spark):
    df = spark.createDataFrame([(2, 'c "q"'), (0, "a"), (1, None)], "id int, payload string")
    rows = batch_bodies(df, "payload", ["id"], 2).orderBy("batch_id").collect()
    assert [(r.batch_id, r.row_count, json.loads(r.body)) for r in rows] == [
        (0, 2, ["a", None]), (1, 1, ['c "q"']),
    ]


def test_payload_texts(spark):
    rows = payloads_from_json(spark, '["a", {"b": 1, "a": [1, 2]}, 3, null, "é"]').orderBy("position")
    assert [r.payload for r in rows.collect()] == ["a", '{"a":[1,2],"b":1}', "3", "null", "é"]
    assert payloads_from_json(spark, "[]").collect() == []
    with pytest.raises(ValueError, match="Invalid payloads JSON"):
        payloads_from_json(spark, "not valid json")
    with pytest.raises(ValueError, match="must be a JSON array"):
        payloads_from_json(spark, '{"a": 1}')


def test_payload_file(spark, tmp_path):
    path = tmp_path / "payloads.json"
    path.write_text('["payload1",\n "payload2", {"a": 1}]')
    rows = payloads_from_file(spark, str(path)).orderBy("position").collect()
    assert [tuple(r) for r in rows] == [(0, "payload1"), (1, "payload2"), (2, '{"a":1}')]


@pytest.mark.parametrize("size", [1, 3, 50, 333, 5000])
def test_batches_are_made_where_their_rows_lie(spark, size):
    rows = [(k * 7 % 1000, None if k % 11 == 0 else f"p{k}") for k in range(1000)]
    df = spark.createDataFrame(rows, "id int, payload string").repartition(9)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
        found = batch_arrays(df, "payload", ["id"], size).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    values = [p for _, p in sorted(rows)]
    assert sorted((r.batch_id, r.payloads) for r in found) == [(b, values[b * size : (b + 1) * size]) for b in range(-(-1000 // size))]
