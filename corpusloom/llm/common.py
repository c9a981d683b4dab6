"""Reading tables, Arrow batches of bounded size, and connected components."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.batches import dense_positions
from corpusloom.session import drop_folders, new_folder, scratch  # noqa: F401 - part of this module's surface

SLICE_BYTES = 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 20
LARGE_JOIN = "shuffle_hash"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and that folder."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def release(spark: SparkSession) -> None:
    """Let the cleaner delete shuffle files of finished steps; else they stay until the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """From now on the session's rows go to Python in Arrow batches of ``BATCH_BYTES``, or of the last row's more.

    Spark bounds a batch by 10,000 rows, which may be 20 MB of texts and more, and an executor keeps the
    memory of its largest batches. A session that has a limit of bytes of its own keeps that.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def keyed(df: DataFrame, *columns: str, nulls_last: bool = False) -> DataFrame:
    """``df`` with ``rid``, a number that no other row has and that orders rows as doc_id does.

    That is doc_id itself unless ids are missing or repeated; then the rows are numbered in the
    order of doc_id (null first, or last) and ``columns``, in the shared folder.
    """
    ids = df.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("doc_id IS NULL OR n > 1").limit(1).count() == 0:
        return df.withColumn("rid", F.col("doc_id"))
    if nulls_last:
        return dense_positions(df.withColumn("no_id", F.col("doc_id").isNull()), ["no_id", "doc_id", *columns]).drop("no_id").withColumnRenamed("position", "rid")
    return dense_positions(df, ["doc_id", *columns]).withColumnRenamed("position", "rid")


HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the other columns of their group; ``groups`` has one row for each ``key``, of ``n`` rows.

    Groups with a thousandth of the ``total`` rows or more, a thousand at most, are sent to the tasks,
    so that no task gets all rows of a large group; the other rows are shuffled to their group.
    ``key`` must not be null.
    """
    large = F.col("n") * HOT_SHARE >= total
    hot = groups.where(large)
    often = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return often.unionByName(rest.join(groups.where(~large).hint(LARGE_JOIN), key))


def texts_of(column: pa.Array) -> pa.LargeStringArray:
    """The column as large strings without nulls (null: empty)."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts in ``column`` have at most ``limit`` bytes together, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield batch.slice(start)


def components(edges: DataFrame, label: str = "components", rounds: int = 60) -> tuple[DataFrame, str]:
    """The smallest node that each node of the edges (a, b) can reach, as (node, root), and its folder.

    Alternating large and small stars: every round links the neighbours of a node to the smallest
    of them, so the number of rounds grows with the logarithm of the longest path. Nothing is
    gathered: a round is an aggregation with map-side combine and a join that may be split.
    Each round is written to the shared folder. Nodes may be of any ordered type.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, folder = saved(pairs, label)
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("v")).agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = current.join(low, "v").select("u", F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # a node's link to the smallest comes once, not with each of its links
        others = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = others.unionByName(low.select("u", F.col("m").alias("v")))
        after, fresh = saved(small.distinct(), label)
        drop_folders(spark, folder)
        current, folder = after, fresh
        # settled when every node with a smaller one has one only, and that has none
        stands = current.select(F.col("u").alias("node"), F.lit(1).alias("below")).unionByName(current.select(F.col("v").alias("node"), F.lit(0).alias("below")))
        stands = stands.groupBy("node").agg(F.sum("below").alias("below"), F.count("*").alias("n"))
        if stands.where("below > 0 AND n > 1").limit(1).count() == 0:
            break
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), folder
