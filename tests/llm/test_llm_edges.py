"""Nulls, empty and very long texts, repeated rows, empty tables and columns with clashing names."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import lm_scoring, near_dedup, suffix_dedup
from corpusloom.llm.decontamination import benchmark_overlaps, decontaminate
from corpusloom.llm.fingerprints import compare_with_next
from corpusloom.llm.html_content import extract_main_text
from corpusloom.llm.language_id import identify, train_languages
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.token_counts import count_tokens
from corpusloom.llm.warc import read_warc, write_warc

LONG = " ".join(f"wort{k % 9000} und" for k in range(120_000))
ROWS = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", None, 3), (4, "a", None, "s", 1), (None, "das ist ein Text", "de", "s", 16),
    (None, None, None, None, None), (5, "das ist ein Text", "de", "s", 16), (5, "das ist ein Text", "de", "s", 16), (6, LONG, "de", "s", len(LONG)), (7, LONG, "de", "s", len(LONG)),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def nasty(spark):
    """The rows with columns whose names the operators use inside."""
    names = ("rid", "spans", "places", "word", "hash", "node", "set_key", "bins", "n", "ids", "row", "target", "carried", "position", "n_bytes", "kept",
             "lang_pred", "lang_score", "predicted", "sure", "no_id", "block", "key", "part", "counts", "removed", "component_id")
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({name: F.lit(7) for name in names})


@pytest.fixture(scope="module")
def tests(spark):
    return spark.createDataFrame([(1, "das ist ein Text"), (2, None), (None, ""), (1, "das ist ein Text")], "item_id long, text string")


OPERATORS = {
    "packing": lambda df, tests: pack_documents(df, BYTE_BPE),
    "counts": lambda df, tests: count_tokens(df, WORD_BPE),
    "language": lambda df, tests: identify(df, train_languages(df)),
    "repeats": lambda df, tests: suffix_dedup.remove_repeats(df, carry=[c for c in df.columns if c not in ("doc_id", "text")]),
    "scores": lambda df, tests: lm_scoring.score_documents(df, tests.select(F.col("item_id").alias("doc_id"))),
    "overlaps": lambda df, tests: benchmark_overlaps(df, tests),
    "fingerprints": lambda df, tests: compare_with_next(df),
    "near": lambda df, tests: near_dedup.near_duplicates(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(nasty, tests, name):
    assert OPERATORS[name](nasty.limit(0), tests.limit(0)).collect() == []


def test_packing(nasty):
    rows = pack_documents(nasty, BYTE_BPE).collect()
    assert sorted(r.doc_id for r in rows if r.ids == [0] and r.start == 0 and r.doc_tokens == 1 and r.doc_id) == [1, 2]
    assert sum(r.start == 0 for r in rows) == len(ROWS)


def test_counts(nasty):
    rows = count_tokens(nasty, WORD_BPE).collect()
    assert len(rows) == len(ROWS) and all((r.n_bytes, r.n_tokens) == (0, 0) for r in rows if r.doc_id in (1, 2))


def test_language(nasty):
    rows = OPERATORS["language"](nasty, None).collect()
    assert sorted(r.doc_id for r in rows if r.lang_pred == "und" and r.doc_id) == [1, 2, 3]
    assert set(nasty.columns) == set(rows[0].asDict()) and all(r.rid == 7 for r in rows)


def test_repeats(nasty):
    rows = OPERATORS["repeats"](nasty, None).collect()
    assert len(rows) == len(ROWS) and all(r.carried.rid == 7 for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[7].kept == b"" and by[7].removed[0].stop == by[7].n_bytes
    assert by[1].kept == b"" and by[1].removed == [] and by[4].kept == b"a"


def test_scores(nasty, tests):
    rows = OPERATORS["scores"](nasty, tests).collect()
    assert len(rows) == len(ROWS) and all(r.score is None and r.n_tokens == 0 for r in rows if r.doc_id in (1, 2, 3))


def test_overlaps(nasty, tests):
    rows = benchmark_overlaps(nasty, tests).collect()
    assert [r.item_id for r in rows] == [1] * 6 and sorted((r.doc_id or 0) for r in rows) == [0, 0, 5, 5, 5, 5]
    clean = decontaminate(nasty, tests)
    assert clean.columns == nasty.columns and clean.count() == len(ROWS) - 3


def test_fingerprints(nasty):
    rows = compare_with_next(nasty).collect()
    assert len(rows) == len(ROWS)
    assert all(r.fingerprint == "" and r.n_chars == 0 for r in rows if r.doc_id in (1, 2))
    assert len({r.fingerprint for r in rows if r.doc_id == 5}) == 1
    (alone,) = compare_with_next(nasty.where("doc_id = 6")).collect()
    assert alone.near_next == 1.0


def test_near(nasty):
    rows = near_dedup.near_duplicates(nasty).collect()
    assert len(rows) == len(ROWS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by[7].component_id, by[7].kept, by[6].kept) == (6, False, True)
    assert all(by[k].component_id == k and by[k].n_shingles == 0 for k in (1, 2, 3))
    assert {(r.component_id, r.kept) for r in rows if r.doc_id is None} == {(5, False), (None, True)}


def test_pages(spark, tmp_path):
    rows = [(1, None, None), (None, "u", "<p>a"), (2, "u", ""), (3, "u", "<p>" + LONG), (3, "u", "<p>" + LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_id", F.lit(1)).withColumn("digest", F.lit(1))
    found = extract_main_text(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 1), (1, 0), (2, 0), (3, len(LONG)), (3, len(LONG))]
    write_warc(pages, f"file://{tmp_path}/a")
    back = read_warc(spark, f"file://{tmp_path}/a").collect()
    assert sorted(len(r.payload) for r in back) == sorted(len(h or "") for _, _, h in rows)
    write_warc(pages.limit(0), f"file://{tmp_path}/b")
    assert read_warc(spark, f"file://{tmp_path}/b").collect() == []
    assert extract_main_text(pages.limit(0)).collect() == []


def test_pipeline(spark, nasty, tests, tmp_path):
    tests.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = nasty
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == {4, 6}
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


def test_one_row_of_each_group_stays(spark, tmp_path):
    copies = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (9, "A b c d e f g"), (None, "x"), (None, "x"), (7, "x y")]
    docs = spark.createDataFrame(copies, "doc_id long, text string").withColumn("rid", F.lit(1))
    left = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == [(0, "x"), (3, "a b c d e f g"), (7, "x y")]


def test_scores_tell_rare_words_apart(spark):
    # the rare words have one length and kind
    filler = " ".join(f"f{k:04d} the of f{k:04d}" for k in range(1500))
    rows = [(1, "aaaab the aaaac aaaad"), (2, "aaaab the aaaac aaaad"), (3, "aaaax the aaaay aaaaz"), (4, filler)]
    targets = spark.createDataFrame([(1,)], "doc_id long")
    found = {r.doc_id: r.score for r in lm_scoring.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), targets).collect()}
    assert found[1] == pytest.approx(found[2], abs=1e-12) and found[2] < found[3] - 0.01
