"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import drop_folders, new_folder, saved, table
from corpusloom.llm.decontamination import benchmark_overlaps
from corpusloom.llm.exact_dedup import exact_duplicates
from corpusloom.llm.fingerprints import compare_with_next
from corpusloom.llm.html_content import extract_main_text
from corpusloom.llm.language_id import held_out, identify, train_languages
from corpusloom.llm.lm_scoring import score_documents
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.oracles import ORACLES  # noqa: F401 - part of this module's surface
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.spelling import spelling_variants
from corpusloom.llm.suffix_dedup import remove_repeats
from corpusloom.llm.token_counts import count_tokens
from corpusloom.llm.vector_codes import codebooks_digest, compress_vectors, with_label_errors
from corpusloom.llm.warc import page_of, read_warc, write_warc


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train_languages(rows.where("NOT held_out"))
    found = identify(rows.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    return found.select("doc_id", "n_bytes", n_removed.cast("long").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return score_documents(table(spark, sf_dir, "documents"), good)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), folder)
    records = read_warc(spark, folder).select(
        "record_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("n"), F.sha1("payload").alias("digest")
    )
    records, _ = saved(records, "records")
    drop_folders(spark, folder)
    responses = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("n").alias("other")).distinct()
    found = records.join(responses, "refers_to", "left")
    return found.select(
        page_of(F.col("record_id")).alias("page_id"),
        F.coalesce("n", "other").alias("payload_bytes"),
        F.coalesce("digest", "payload_digest").alias("payload_digest"),
        "record_type",
        page_of(F.col("refers_to")).alias("refers_to"),
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_next(table(spark, sf_dir, "documents"))
    edited = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return found.select("doc_id", "n_chars", edited, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress_vectors(table(spark, sf_dir, "embeddings"))
    digits = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x.cast("long")), 2, "0"))), "")
    return with_label_errors(coded.rows).select(
        F.col("key").alias("vec_id"), digits.alias("code"), "error", "label_error", F.lit(codebooks_digest(coded.codebooks)).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_decontamination": op6_decontamination,
    "op7_warc": op7_warc,
    "op8_html_extraction": op8_html_extraction,
    "op9_fingerprints": op9_fingerprints,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_vector_codes": op13_vector_codes,
}
