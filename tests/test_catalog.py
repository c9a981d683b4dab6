import inspect

from corpusloom import catalog
from corpusloom.catalog import COLUMNS, ENTRIES, functions_catalog
from corpusloom.functions import text, tokens, vectors
from corpusloom.operators import batches, embedding, html, language, ordered, scripts
from corpusloom.sources import arrays, http, lanes, ledger, listing, objects, ranges

# helpers and building blocks of the operators above them
INTERNAL = {
    "as_column", "fill_nulls", "identity", "java_pattern", "java_replacement", "register_sql",
    "vectors_of", "vectors_of_dims", "fake_udf", "counter_udf", "chunks_udf", "endpoint_column",
    "halves", "split_to_budget", "split_words", "batch_size_of", "dense_positions", "batch_bodies",
    "embed_udf", "fake_client", "html_elements", "is_kept", "pack_bounds", "chunk_bounds",
    "skip_pattern", "elements_udf", "pack_udf", "size_error", "mode_named", "letters_only", "language_of",
    "language_judge", "request_headers", "retryable_status", "post_once", "post_udf",
    "response_headers", "fetch_udf", "put_udf", "exists_udf", "fetch_text", "put_text",
    "object_exists", "split_path", "library_pattern", "payload_text", "payload_list", "depth_steps",
    "numbered_parts", "batch_arrays", "next_starts", "carry_table", "carried_on",
    "config_udf", "kept_sql", "row_sql", "rows_sql", "error_sql",
    "headers_column", "outcome_of", "ledger_answers", "drop_ledger", "only_ledger",
}


def test_rows(spark):
    frame = functions_catalog(spark)
    rows = frame.collect()
    assert frame.columns == list(COLUMNS) and len(rows) >= 16
    assert all(value for row in rows for value in row)
    assert set(catalog.SQL_NAMES) < {r.name for r in rows}
    assert {r.kind for r in rows} == {"scalar", "table"}
    assert len({r.name for r in rows}) == len(rows)
    assert [r.kind for r in rows if r.name == "extract_html"] == ["table"]
    found = spark.sql("SELECT count(*) FROM corpus_functions WHERE name = 'fetch_objects'").first()
    assert found[0] == 1


def test_what_needs_a_service_says_so(spark):
    outside = functions_catalog(spark).where(
        "module in ('arrays', 'http', 'lanes', 'ledger', 'listing', 'objects', 'ranges', 'embedding') and example not like '%-- requires%'"
    )
    assert {r.name for r in outside.collect()} == {
        "payloads_from_json", "payloads_from_file", "payloads_from_lines", "parse_path", "host_of",
    }


def test_no_operator_is_missing():
    modules = (text, tokens, vectors, batches, embedding, html, language, ordered, scripts, arrays, http, lanes, ledger, listing, objects, ranges)
    public = {
        name
        for module in modules
        for name, value in vars(module).items()
        if inspect.isfunction(value) and value.__module__ == module.__name__
        and not name.startswith("_") and name not in INTERNAL
    }
    assert public == {entry.name for entry in ENTRIES}
    assert all(getattr(catalog, entry.module) for entry in ENTRIES)
