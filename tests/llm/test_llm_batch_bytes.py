"""Texts go to Python in Arrow batches of bounded bytes."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, language_id, near_dedup, packing, suffix_dedup
from corpusloom.llm.common import BATCH_BYTES, BATCH_KEY, small_batches

OPERATORS = {
    "identify": (language_id, ["_predict"], lambda df: language_id.identify(df, language_id.Model({}, [], []))),
    "near_duplicates": (near_dedup, ["_features", "_confirm"], near_dedup.near_duplicates),
    "remove_repeats": (suffix_dedup, ["_runs", "_contexts", "_cut"], suffix_dedup.remove_repeats),
    "decontaminate": (decontamination, ["_overlaps"], lambda df: decontamination.decontaminate(df, df.select(F.col("doc_id").alias("item_id"), F.repeat(F.lit("other "), 20).alias("text")).limit(1))),
    "pack_documents": (packing, ["_pieces"], lambda df: packing.pack_documents(df, public_tokenizers.path("byte_bpe_50k.json"))),
}


@pytest.fixture
def unset(spark):
    before = spark.conf.get(BATCH_KEY, None)
    spark.conf.unset(BATCH_KEY)
    yield
    spark.conf.unset(BATCH_KEY)
    if before is not None:
        spark.conf.set(BATCH_KEY, before)


@pytest.fixture(scope="module")
def long_texts(spark):
    """Texts of 20 KB, 2 MB together, in one part."""
    word = lambda k: F.concat(F.lit("w"), ((k * 31 + F.col("id") * 7919) % 99991).cast("string"))
    return spark.range(1, 101, 1, 1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(3000)), word)).alias("text"))


def bounded(make):
    """What ``make`` makes, failing where a batch has more than the bound and one text."""

    def made(*args):
        inner = make(*args)

        def run(batches):
            def seen():
                for batch in batches:
                    assert batch.nbytes < BATCH_BYTES + 100_000, f"a batch of {batch.nbytes} bytes"
                    yield batch

            yield from inner(seen())

        return run

    return made


@pytest.mark.parametrize("name", OPERATORS)
def test_batches_of_long_texts_are_bounded(spark, unset, long_texts, monkeypatch, name):
    module, makers, operator = OPERATORS[name]
    for maker in makers:
        monkeypatch.setattr(module, maker, bounded(getattr(module, maker)))
    assert operator(long_texts).select("doc_id").distinct().count() == 100


def test_a_limit_of_the_session_stays(spark, unset):
    spark.conf.set(BATCH_KEY, "5m")
    small_batches(spark)
    assert spark.conf.get(BATCH_KEY) == "5m"
