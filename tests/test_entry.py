import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from corpusloom.plans.oracles import ORACLES
from corpusloom.plans.queries import QUERIES
from corpusloom.session import (
    drop_folders,
    new_folder,
    pinned,
    scratch,
    shared_dir,
    spread,
)
from oracle import compare, connect


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, connection, name):
    difference = compare(spark, connection, QUERIES[name], ORACLES[name], sf_dir)
    assert difference is None, difference


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[:3] == ["page_id", "chunk_id", "text"]
    assert frame.where("size(vector) = 16 and tokens = word_count").count() == frame.count() > 0


def test_shared_folder(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_dir(spark) + "/x-")


def test_folders_can_be_dropped(spark):
    first = pinned(spark.range(5), "first")
    second = pinned(first.select((F.col("id") + 1).alias("id")), "second", source=first)
    assert sorted(r.id for r in second.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="(?i)not.exist|path"):
        first.collect()
    kept = new_folder(spark, "kept")
    spark.range(3).write.parquet(kept)
    drop_folders(spark, kept)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(kept)
    with pytest.raises(ValueError, match="not a folder of this session"):
        drop_folders(spark, "/tmp")


def test_scratch_keeps_what_it_is_told(spark):
    with scratch(spark) as outer_keep:
        with scratch(spark) as keep:
            gone = pinned(spark.range(2), "gone")
            kept = pinned(spark.range(3), "kept")
            keep(kept)
        assert kept.count() == 3
        with pytest.raises(Exception):
            gone.collect()
        last = pinned(kept, "last")
        outer_keep(last)
    assert last.count() == 3
    with pytest.raises(Exception):
        kept.collect()


def test_spread_is_asked_for(spark):
    few = spark.range(0, 100, numPartitions=1)
    assert spread(few) is few
    spark.conf.set("corpusloom.spread", "3")
    try:
        assert spread(few).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("corpusloom.spread")
