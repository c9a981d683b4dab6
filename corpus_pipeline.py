"""A training-data pipeline over documents; each stage is one of the operators in corpusloom.llm."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import LARGE_JOIN, keyed
from corpusloom.llm.decontamination import decontaminate
from corpusloom.llm.language_id import UNKNOWN, held_out, identify, train_languages
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.suffix_dedup import remove_repeats
from corpusloom.session import pinned, scratch


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised stay; those without letters, or without text, go."""
    model = train_languages(docs.where(~held_out()))
    names = []
    for name in ("predicted", "sure"):
        while name in docs.columns:
            name = f"_{name}"
        names.append(name)
    return identify(docs, model, *names).where(F.col(names[0]) != UNKNOWN).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the row with the smallest doc_id stays, also of rows with one id or without (these come last)."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*columns).alias("row"))
    rows = keyed(rows, "text", nulls_last=True)
    kept = near_duplicates(rows.select(F.col("rid").alias("doc_id"), "text")).where("kept").select(F.col("doc_id").alias("rid"))
    return rows.join(kept.hint(LARGE_JOIN), "rid", "left_semi").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that occurred before are cut out; documents of which nothing is left go.

    Bytes of a character that a cut divides go with it, and n_chars follows the text.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeats(docs, carry=others, as_text=True)
    rows = cut.where((F.size("removed") == 0) | (F.col("kept") != ""))
    rows = rows.select("doc_id", F.col("kept").alias("text"), *(F.col(f"carried.`{c}`") for c in others))
    if "n_chars" in others:
        rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    return rows.select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a passage of the benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids whose lengths are powers of two."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language identification", known_language),
    ("near duplicates", one_of_each_group),
    ("suffix-array deduplication", without_repeats),
    ("benchmark decontamination", without_benchmarks),
    ("packing", packed),
]

# the language model, near duplicates and tokenizers have no SQL form
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each reads what the one before wrote.

    What a stage writes for itself is dropped once its result is written, and that when the next one is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            before = docs = pinned(stage(spark, docs, sf_dir), name.replace(" ", "-"), source=before)
            keep(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
