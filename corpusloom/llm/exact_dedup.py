"""Exact duplicates by a 128-bit content hash, with DataFrame functions alone.

1. Every text is normalised and hashed (128 bits); what stays of a row is its ids and hashes.
2. Rows are grouped by the hash: a task passes on one row for each hash that it met, whatever the
   size of the group. The smallest stable id stays.
3. Hashes can collide. The bytes of all texts of a group are compared by their smallest and largest,
   which tasks find before anything is moved, so a group is never gathered. Groups whose smallest
   and largest differ are told apart by the texts themselves.
4. Rows learn their group by a join. Groups of a thousandth of all rows or more, a thousand of them
   at most, are sent to the tasks, so no task gets all rows of a large group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import drop_folders, join_groups, keyed, release, saved

WHITE = "[\\x20\\x09-\\x0D]+"
SENT_GROUPS = 1 << 20  # 16 bytes each


def content_hash(text: Column) -> Column:
    """128 bits of a text."""
    return F.unhex(F.md5(text))


def _grouped(rows: DataFrame, *key: str) -> DataFrame:
    """For each key: the row that stays (``first``), its doc_id and the number of rows."""
    first = F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), F.col("rid"))), F.min("rid"))
    return rows.groupBy(*key).agg(first.alias("first"), F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))


def exact_duplicates(df: DataFrame, hash_of: Callable[[Column], Column] = content_hash) -> DataFrame:
    """Groups of equal texts among rows (doc_id, text); further columns are ignored.

    Texts are equal if they are identical after every run of space and the five control characters
    from tab to carriage return is one space. Returns for each row doc_id, keep_id (the smallest
    doc_id of its group), group_size, kept and text_sha256 (of the normalised text in UTF-8).

    A null text is empty, and empty texts equal each other. Exactly one row of a group is kept: the
    one with the smallest doc_id; rows without doc_id come last, so keep_id is null only where no row
    of the group has an id. Of repeated ids one row is kept. An empty table gives no rows. Whatever
    ``hash_of`` gives, the groups are right, as bytes are compared.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = keyed(df.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")), "text")
    rows = rows.withColumn("text", F.regexp_replace("text", WHITE, " "))
    hashed = rows.select("rid", "doc_id", hash_of(F.col("text")).alias("hash"), F.sha2("text", 256).alias("text_sha256"))
    hashed, _ = saved(hashed, "hashed")
    groups, _ = saved(_grouped(hashed, "hash"), "groups")
    # what can hold unequal texts: groups of two rows and more
    several = groups.where("n > 1").select("hash")
    texts = rows.select("rid", "doc_id", hash_of(F.col("text")).alias("hash"), "text")
    compared = texts
    if several.count() <= SENT_GROUPS:
        compared = texts.join(F.broadcast(several), "hash", "left_semi")
    ends = compared.groupBy("hash").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    unequal, folder = saved(ends.where("low <> high").select("hash"), "unequal")
    total = hashed.count()
    release(spark)
    columns = ["doc_id", "rid", "first", "keep_id", "n", "text_sha256"]
    if unequal.limit(1).count() == 0:
        drop_folders(spark, folder)
        found = join_groups(hashed, groups, "hash", total).select(columns)
    else:
        told = texts.join(unequal, "hash", "left_semi")
        parts = _grouped(told, "hash", "text").withColumn("key", F.struct("hash", "text")).drop("hash", "text")
        told = told.select("rid", "doc_id", F.struct("hash", "text").alias("key"), F.sha2("text", 256).alias("text_sha256"))
        clear = join_groups(hashed.join(unequal, "hash", "left_anti"), groups.join(unequal, "hash", "left_anti"), "hash", total)
        found = clear.select(columns).unionByName(join_groups(told, parts, "key", total).select(columns))
    return found.select("doc_id", "keep_id", F.col("n").alias("group_size"), (F.col("rid") == F.col("first")).alias("kept"), "text_sha256")
