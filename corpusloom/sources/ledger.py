"""Posts that a ledger of answers keeps from being sent twice.

Every task enters the answers it got into a folder that all executors reach, while it goes on and
also when it fails. A repeated task, run or micro-batch leaves out the rows whose key is entered, by
an anti-join, and takes their answers from there. What is lost with a killed process are the answers
not yet entered: ``flush`` of them and the requests in flight, which the service sees again under
the same Idempotency-Key.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, InFlight, RetryPolicy
from corpusloom.session import pinned
from corpusloom.sources.http import ARROW_RESPONSE, HTTP_RETRY, NO_ANSWER, RESPONSE, Transport, UrlTransport, headers_column, outcome_of

FLUSH = 64
FLUSH_BYTES = 8 << 20
_ANSWERS = f"key string, response {RESPONSE.simpleString()}"
_ARROW_ANSWERS = pa.schema([("key", pa.string()), ("response", ARROW_RESPONSE)])


def _folder(spark: SparkSession, ledger: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def ledger_answers(spark: SparkSession, ledger: str) -> DataFrame:
    """(key, response): one answer for each key that is entered."""
    system, path = _folder(spark, ledger)
    system.mkdirs(path)
    rows = spark.read.schema(_ANSWERS).parquet(ledger)
    return rows.groupBy("key").agg(F.first("response").alias("response"))


def drop_ledger(spark: SparkSession, ledger: str) -> None:
    """Delete a ledger whose run is known to be complete."""
    system, path = _folder(spark, ledger)
    system.delete(path, True)


def only_ledger(spark: SparkSession, root: str, number: int) -> str:
    """The ledger of a micro-batch below ``root``; those of earlier ones, which are complete, are deleted."""
    system, path = _folder(spark, root)
    system.mkdirs(path)
    for entry in system.listStatus(path):
        name = entry.getPath().getName().removeprefix("micro_batch=")
        if name.isdigit() and int(name) < number:
            system.delete(entry.getPath(), True)
    return f"{root}/micro_batch={number}"


class _Entries:
    """Answers of a task on their way to the ledger; a file is seen whole or not at all."""

    def __init__(self, folder: str, flush: int) -> None:
        # on a file system that the address names, or that of the machine for a plain path
        self._system, self._folder = fs.FileSystem.from_uri(folder)
        self._flush, self._rows, self._held = flush, [], 0
        self._lock = threading.Lock()

    def add(self, key: str, response: dict | None) -> None:
        if response is None or response["status_code"] == NO_ANSWER:
            return
        with self._lock:
            self._rows.append({"key": key, "response": response})
            self._held += len(response["body"]) + len(response["headers"])
            if len(self._rows) >= self._flush or self._held >= FLUSH_BYTES:
                self._write()

    def close(self) -> None:
        with self._lock:
            self._write()

    def _write(self) -> None:
        if not self._rows:
            return
        name = uuid.uuid4().hex
        hidden, shown = (f"{self._folder}/{prefix}{name}.parquet" for prefix in (".", "answers-"))
        with self._system.open_output_stream(hidden) as stream:
            pq.write_table(pa.Table.from_pylist(self._rows, _ARROW_ANSWERS), stream)
        self._system.move(hidden, shown)
        self._rows, self._held = [], 0


def post_rows_once(
    df: DataFrame,
    url: Column | str,
    body_col: str,
    key_col: str,
    ledger: str,
    out: str = "response",
    headers: Column | dict[str, str] | str | None = None,
    transport: Transport | None = None,
    retry: RetryPolicy = HTTP_RETRY,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    tasks: int | None = None,
    unique: bool = False,
    flush: int = FLUSH,
) -> DataFrame:
    """Add ``out`` = the response to one POST for each key, now, leaving out keys in the ``ledger``.

    ``key_col`` names the request: rows with one key are one request (that of any of them), and go along as
    Idempotency-Key; NULL keys raise. ``unique`` says that no key is repeated, which spares a shuffle. An
    answer of any status is entered and final; a request that got none (``on_error`` as for
    :func:`corpusloom.sources.http.post_column`) is sent again by the next run. The ledger is a folder that
    the executors reach by the same address. NULL url or body sends nothing.
    """
    if on_error not in ("fail", "row", "null"):
        raise ValueError(f"on_error is fail, row or null, not {on_error!r}")
    if flush < 1:
        raise ValueError(f"flush must be positive, not {flush}")
    spark, headers = df.sparkSession, headers_column(headers)
    outcome = outcome_of(transport or UrlTransport(), retry, on_error)
    address = url if isinstance(url, Column) else F.lit(url)
    column = F.col(f"`{key_col}`").cast("string")
    key = F.when(column.isNotNull(), column).otherwise(F.raise_error(F.lit("a row to post once has no key")).cast("string"))
    # pinned, as the run itself adds to the ledger
    known = pinned(ledger_answers(spark, ledger), "known")
    requests = df.select(key.alias("key"), address.alias("url"), F.col(f"`{body_col}`").alias("body"), headers.alias("headers"))
    requests = requests.join(known, "key", "left_anti")
    if not unique:
        requests = requests.dropDuplicates(["key"])
    if tasks:
        requests = requests.repartition(tasks)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Entries(ledger, flush)

        def one(request: dict) -> dict:
            found = outcome((request["url"], request["body"], request["headers"], request["key"]))
            entries.add(request["key"], found)
            return {"key": request["key"], "response": found}

        try:
            with InFlight(max_in_flight) as flight:
                for batch in batches:
                    rows, held = [], 0
                    for row in flight.map(one, batch.to_pylist()):
                        rows.append(row)
                        held += len(row["response"]["body"]) if row["response"] else 0
                        if held > FLUSH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, _ARROW_ANSWERS)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, _ARROW_ANSWERS)
        finally:
            # after the requests in flight have come back
            entries.close()

    posted = pinned(requests.mapInArrow(post, _ANSWERS), "answers")
    answers = known.unionByName(posted).select(F.col("key").alias("__key"), F.col("response").alias("__response"))
    joined = df.drop(out).join(answers, column == F.col("__key"), "left")
    return joined.withColumn(out, F.col("__response")).drop("__key", "__response")
