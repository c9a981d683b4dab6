"""Sinks for streams: posting rows or batches and writing objects per micro-batch.

Column functions and :func:`corpusloom.operators.html.extract_html` keep no state, so they run
on streams as they are; only what reaches outside goes through ``foreachBatch``. The outcomes
of a micro-batch are written under its number, replacing what an interrupted attempt left, and
batches carry a key made of checkpoint, micro-batch and number, so a restart from the checkpoint
repeats the same keys. Rows carry the key that ``key_col`` names. With a ``ledger`` folder, answers
are entered there while a micro-batch runs (:mod:`corpusloom.sources.ledger`): when it is repeated, only
what has no answer yet is sent. The entries of a micro-batch go when a later one begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter

from corpusloom.session import scratch
from corpusloom.sources.http import post_batches, post_rows
from corpusloom.sources.ledger import post_rows_once, only_ledger
from corpusloom.sources.objects import write_objects


def per_batch(
    stream: DataFrame,
    step: Callable[[DataFrame, int], DataFrame],
    outcomes: str,
    checkpoint: str,
) -> DataStreamWriter:
    """A writer that stores ``step`` of every micro-batch in ``outcomes``, one folder each."""

    def store(rows: DataFrame, number: int) -> None:
        with scratch(rows.sparkSession):
            step(rows, number).write.mode("overwrite").parquet(f"{outcomes}/micro_batch={number}")

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def post_stream(
    stream: DataFrame,
    url: Column | str,
    body_col: str,
    outcomes: str,
    checkpoint: str,
    ledger: str | None = None,
    key_col: str | None = None,
    **options,
) -> DataStreamWriter:
    """POST one request per row; options as for :func:`corpusloom.sources.http.post_rows`.

    A ``ledger`` needs a ``key_col``; options are then those of
    :func:`corpusloom.sources.ledger.post_rows_once`.
    """
    if ledger and not key_col:
        raise ValueError("a ledger needs key_col")

    def step(rows: DataFrame, number: int) -> DataFrame:
        if not ledger:
            return post_rows(rows, url, body_col, once=False, key_col=key_col, **options)
        entries = only_ledger(rows.sparkSession, ledger, number)
        return post_rows_once(rows, url, body_col, key_col, entries, **options)

    return per_batch(stream, step, outcomes, checkpoint)


def post_batches_stream(
    stream: DataFrame,
    payload_col: str,
    order_by: list[str],
    url: str,
    batch_size: int | str,
    outcomes: str,
    checkpoint: str,
    ledger: str | None = None,
    **options,
) -> DataStreamWriter:
    """POST batches of payloads; batch numbers start at 0 in every micro-batch.

    With a ``ledger``, ``order_by`` must order all rows, so that a repeated micro-batch has the same batches.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:32]

    def step(rows: DataFrame, number: int) -> DataFrame:
        entries = only_ledger(rows.sparkSession, ledger, number) if ledger else None
        return post_batches(
            rows, payload_col, order_by, url, batch_size, run_id=f"{run}-{number}", ledger=entries, **options
        )

    return per_batch(stream, step, outcomes, checkpoint)


def write_objects_stream(
    stream: DataFrame,
    path_col: str,
    content_col: str,
    outcomes: str,
    checkpoint: str,
    **options,
) -> DataStreamWriter:
    """Write one object per row; the outcomes hold the addresses, not the contents."""
    return per_batch(
        stream,
        lambda rows, _: write_objects(rows, path_col, content_col, **options).drop(content_col),
        outcomes,
        checkpoint,
    )
