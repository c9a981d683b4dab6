import pytest
from pyspark.sql import functions as F

from corpusloom.functions.retry import RetryPolicy, TransientError
from corpusloom.operators import embedding
from corpusloom.operators.embedding import embed, embed_column, fake_client


def lengths_client(endpoint):
    def ask(texts):
        assert len(texts) == len(set(texts)) and len(texts) <= 64
        return [[float(len(t))] for t in texts]

    return ask


def table(spark):
    # one text makes up a third of the rows, others come once or twice, some are missing
    text = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 2000).cast("string")))
    )
    return spark.range(0, 3000, numPartitions=4).select("id", text.alias("text"))


@pytest.mark.parametrize("dedupe", ["batch", "global"])
def test_all_rows_get_their_vector(spark, dedupe):
    df = table(spark)
    rows = embed_column(df, "text", lengths_client, "v", dedupe).collect()
    assert sorted(r.id for r in rows) == list(range(3000))
    assert all(r.v == (None if r.text is None else [float(len(r.text))]) for r in rows)


def test_the_hot_text_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        frame = embed_column(table(spark), "text", lengths_client, "v", "global")
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        assert frame.where("text = 'hot'").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_vectors_raise_the_share(spark, monkeypatch):
    # room for one vector of one double: no text may be broadcast unless it holds all rows
    monkeypatch.setattr(embedding, "BROADCAST_BYTES", 8)
    rows = embed_column(table(spark), "text", lengths_client, "v", "global").collect()
    assert len(rows) == 3000
    assert all(r.v == (None if r.text is None else [float(len(r.text))]) for r in rows)


def test_a_service_is_asked_once_per_text(spark, tmp_path):
    log = tmp_path / "asked"
    log.mkdir()

    def client(endpoint):
        import os
        import uuid

        def ask(texts):
            with open(os.path.join(log, uuid.uuid4().hex), "w") as file:
                file.write("\n".join(texts))
            return [[1.0] for _ in texts]

        return ask

    frame = embed_column(table(spark), "text", client, "v", "global")
    frame.count(), frame.orderBy("id").collect()
    asked = [line for file in log.iterdir() for line in file.read_text().split("\n")]
    assert len(asked) == len(set(asked))


def test_stand_in_client_agrees_with_the_function(spark):
    from corpusloom.functions.vectors import embed_fake

    df = spark.createDataFrame([("hello",), ("",), (None,)], "text string")
    row = df.select(embed("text", fake_client(5)).alias("a"), embed_fake("text", 5).alias("b"))
    assert all(r.a == r.b for r in row.collect())


def test_null_and_errors(spark):
    df = spark.createDataFrame([("x",), (None,)], "text string")
    assert df.where("text is null").select(embed("text", fake_client(2), null_compat=True)).first()[0] == []

    def unreachable(endpoint):
        def ask(texts):
            raise ConnectionError("Failed to connect")

        return ask

    quick = RetryPolicy(2, 0.0)
    with pytest.raises(Exception, match="Failed to connect"):
        df.select(embed("text", unreachable, retry=quick)).collect()

    def recovering(endpoint):
        left = [TransientError("busy"), TransientError("busy")]

        def ask(texts):
            if left:
                raise left.pop()
            return [[0.5] for _ in texts]

        return ask

    assert df.select(embed("text", recovering, retry=quick)).first()[0] == [0.5]
    with pytest.raises(ValueError):
        embed_column(df, "text", unreachable, dedupe="other")


def test_endpoint_per_row(spark):
    def client(endpoint):
        return lambda texts: [[float(len(endpoint))] for _ in texts]

    df = spark.createDataFrame([("a", "x"), ("a", "yy"), (None, "x")], "text string, e string")
    assert [r[0] for r in df.select(embed("text", client, F.col("e"))).collect()] == [[1.0], [2.0], None]
    named = embed_column(df, "text", client, "v", endpoint="four").collect()
    assert [r.v for r in named] == [[4.0], [4.0], None]


def test_texts_that_change_keep_their_rows(spark):
    df = spark.range(0, 300, numPartitions=3).select("id", F.expr("concat('t', cast(rand() * 1e9 AS STRING))").alias("text"))
    rows = embed_column(df, "text", fake_client(2), "v", "global").collect()
    assert len(rows) == 300 and all(len(r.v) == 2 for r in rows)


def test_a_hot_text_without_vector_keeps_its_rows(spark):
    df = spark.range(0, 1000).select("id", F.when(F.col("id") < 500, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("text"))

    def client(endpoint):
        return lambda texts: [None if t == "hot" else [1.0] for t in texts]

    rows = embed_column(df, "text", client, "v", "global").collect()
    assert len(rows) == 1000 and sum(r.v is None for r in rows) == 500


@pytest.mark.parametrize("more", [1, -1])
@pytest.mark.parametrize("dedupe", ["batch", "global"])
def test_wrong_numbers_of_answers_raise(spark, more, dedupe):
    df = spark.range(0, 200).select(F.concat(F.lit("t"), "id").alias("text"))

    def client(endpoint):
        return lambda texts: [[1.0]] * (len(texts) + more)

    with pytest.raises(Exception, match="answers to"):
        embed_column(df, "text", client, "v", dedupe, call_size=64).collect()


def test_the_input_of_global_dedupe_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 100).selectExpr("id", "concat('t', id % 7) AS text").mapInArrow(counted, "id long, text string")
    assert embed_column(df, "text", fake_client(2), "v", "global").count() == 100
    assert seen.value == 100
