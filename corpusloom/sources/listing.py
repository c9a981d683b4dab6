"""Probing many objects by the listings of their folders.

A probe for each object is a request for each object. Where a table names many objects of a folder,
one listing answers for all of them: the distinct names are counted by folder, a folder with enough
of them is listed once, by one task, and the listing is joined with the names. Only names that are
lone in their folder are probed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, InFlight
from corpusloom.session import pinned, scratch
from corpusloom.sources.objects import FETCH_FAILED, DefaultResolver, ObjectError, Resolver, _settle, object_exists

LEAST_NAMES = 2
HOT_SHARE = 1000
_ROWS = 1 << 16


def _names(resolve: Resolver, folder: str) -> list[str]:
    """The names of the objects right in a folder; one that is not there has none."""
    system, inner = resolve(folder)
    try:
        entries = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    except (OSError, pa.ArrowException) as error:
        raise ObjectError(f"{FETCH_FAILED}: {folder}: {error}") from error
    return [entry.base_name for entry in entries if entry.type == fs.FileType.File]


def _listed(folders: DataFrame, resolver: Resolver, max_in_flight: int, on_error: str) -> DataFrame:
    """(path, found) of all objects in the folders; path is NULL where a folder could not be listed."""
    names = _settle(_names, on_error)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with InFlight(max_in_flight) as flight:
            for batch in batches:
                asked = batch.column("folder").to_pylist()
                for folder, found in zip(asked, flight.map(lambda f: names(resolver, f), asked), strict=True):
                    # the folder itself is a row, so that one that was listed can be told from one that was not
                    paths = [folder] + [folder + name for name in found or ()]
                    for at in range(0, len(paths), _ROWS):
                        some = paths[at : at + _ROWS]
                        yield pa.record_batch([pa.array(some, pa.string()), pa.array([found is not None] * len(some), pa.bool_())], names=["path", "found"])

    return folders.mapInArrow(run, "path string, found boolean")


def objects_exist_by_listing(
    df: DataFrame,
    path_col: str,
    out: str = "found",
    resolver: Resolver | None = None,
    least: int = LEAST_NAMES,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    null_compat: bool = False,
) -> DataFrame:
    """Add ``out`` = whether the object that ``path_col`` names is there, by one listing for each folder.

    Folders of which at least ``least`` distinct names are asked are listed, other names probed.
    Answers are those of :func:`corpusloom.sources.objects.objects_exist`: NULL paths have none (false
    with ``null_compat``), wrong addresses and failed calls raise, or give NULL with ``on_error="null"``.
    A listing goes through one task, some 300 bytes for each object of the folder; where a folder holds
    far more than is asked for, raise ``least`` or use the probes. The calls are made now, and the
    answers are in the shared folder. A name that a thousandth of the rows share is sent to the rows.
    """
    if least < 1:
        raise ValueError(f"least must be positive, not {least}")
    resolve, spark = resolver or DefaultResolver(), df.sparkSession
    column = F.col(f"`{path_col}`")
    with scratch(spark) as keep:
        asked = df.where(column.isNotNull()).groupBy(column.alias("path")).agg(F.count("*").alias("n"))
        # what comes after the last slash is the name; an address without a slash has no folder
        asked = pinned(asked.withColumn("folder", F.regexp_extract("path", r"(?s)^([a-z0-9]+://[^/]*/(?:.*/)?)[^/]*$", 1)), "asked")
        folders = asked.where("folder <> ''").groupBy("folder").agg(F.count("*").alias("names")).where(F.col("names") >= least)
        folders = pinned(folders.select("folder"), "folders")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        listed = pinned(_listed(folders.repartition(parts, "folder"), resolve, max_in_flight, on_error), "listed")
        whole = listed.where("endswith(path, '/')").select(F.col("path").alias("folder"), F.col("found").alias("answered"))
        by_folder = asked.join(folders, "folder", "left_semi").join(whole, "folder").join(listed.withColumnRenamed("found", "there"), "path", "left")
        answers = by_folder.select(
            "path", "n", F.when(F.col("answered"), F.col("there").isNotNull() & ~F.endswith("path", F.lit("/"))).alias("answer")
        )
        lone = asked.join(folders, "folder", "left_anti").repartition(parts, "path")
        probed = object_exists("path", resolve, max_in_flight, on_error)
        answers = pinned(answers.unionByName(lone.select("path", "n", probed.alias("answer"))), "answers")
        keep(answers)
    total = answers.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(answers.where(F.col("n") * HOT_SHARE > total).select(F.col("path").alias("__path"), F.col("answer").alias("__hot")))
    rest = answers.where(F.col("n") * HOT_SHARE <= total).select(F.col("path").alias("__path"), F.col("answer").alias("__answer"))
    rows = df.drop(out).join(hot, column == F.col("__path"), "left")
    # rows whose name was sent are spread over all partitions by a key that no name has
    sent = F.col("__path").isNotNull() | column.isNull()
    found = rows.where(sent).withColumn(out, F.col("__hot")).drop("__path", "__hot")
    others = rows.where(~sent).drop("__path", "__hot").join(rest, column == F.col("__path"), "left").withColumn(out, F.col("__answer")).drop("__path", "__answer")
    result = found.unionByName(others)
    return result.withColumn(out, F.coalesce(out, F.lit(False))) if null_compat else result
