"""Posts with a bound for each host that holds for the whole job.

A host has so many lanes as it may have requests at once. Every row belongs to one lane of its
host, all rows of a lane lie in one task, and a lane sends one request after the other; so the bound
holds however many tasks run. The rows of a busy host are dealt over its lanes, which lie in
different tasks as far as hashing separates them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.retry import DEFAULT_IN_FLIGHT, InFlight, RetryPolicy
from corpusloom.session import pinned
from corpusloom.sources.http import ARROW_RESPONSE, HTTP_RETRY, RESPONSE, Transport, UrlTransport, headers_column, outcome_of

PER_HOST = 4
# rows of a task whose lanes run side by side before their answers go on
ROUND_ROWS = 1024
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#]*)"


def host_of(url: Column | str) -> Column:
    """Host and port of an address in lower case; '' where there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def _lanes_udf(transport: Transport, retry: RetryPolicy, max_in_flight: int, on_error: str):
    """The Arrow function of (url, body, headers JSON, key, host, lane)."""
    outcome = outcome_of(transport, retry, on_error)

    def in_turn(rows: list[tuple[int, tuple]]) -> list[tuple[int, dict | None]]:
        return [(number, outcome(row)) for number, row in rows]

    def post(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        with InFlight(max_in_flight) as flight:
            for columns in batches:
                for at in range(0, len(columns[0]), ROUND_ROWS) or (0,):
                    rows = list(zip(*(c.slice(at, ROUND_ROWS).to_pylist() for c in columns)))
                    lanes: dict[tuple, list] = {}
                    for number, row in enumerate(rows):
                        lanes.setdefault(row[4:], []).append((number, row[:4]))
                    answers: list[dict | None] = [None] * len(rows)
                    # the longest first, so that short lanes fill what is left of the round
                    for found in flight.map(in_turn, sorted(lanes.values(), key=len, reverse=True)):
                        for number, answer in found:
                            answers[number] = answer
                    yield pa.array(answers, ARROW_RESPONSE)

    return F.arrow_udf(post, RESPONSE).asNondeterministic()


def post_by_host(
    df: DataFrame,
    url: Column | str,
    body_col: str,
    per_host: int = PER_HOST,
    out: str = "response",
    headers: Column | dict[str, str] | str | None = None,
    transport: Transport | None = None,
    retry: RetryPolicy = HTTP_RETRY,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    tasks: int | None = None,
    key_col: str | None = None,
) -> DataFrame:
    """Add ``out`` = the response to one POST per row, now; no host has more than ``per_host`` requests at once.

    Other arguments as for :func:`corpusloom.sources.http.post_column`; ``max_in_flight`` bounds a task over
    all hosts. Rows move to the task of their lane, so select the columns to keep before; ``tasks``
    is by default what ``spark.sql.shuffle.partitions`` says. Waits between retries hold the lane. A task
    that Spark repeats starts after the lost one, unless speculative execution is on: a second copy of
    a task beside the first one would double its lanes, and is refused.
    """
    if per_host < 1:
        raise ValueError(f"per_host must be positive, not {per_host}")
    if on_error not in ("fail", "row", "null"):
        raise ValueError(f"on_error is fail, row or null, not {on_error!r}")
    spark = df.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false").lower() == "true":
        raise ValueError("spark.speculation must be off: copies of a task would exceed the bound of a host")
    address = url if isinstance(url, Column) else F.lit(url)
    mark = F.col(f"`{key_col}`").cast("string") if key_col else F.lit(None).cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != out])
    rows = df.select(
        row.alias("row"), address.alias("url"), F.col(f"`{body_col}`").alias("body"),
        headers_column(headers).alias("headers"), mark.alias("key"),
        F.coalesce(host_of(address), F.lit("")).alias("host"),
        F.pmod(F.monotonically_increasing_id(), F.lit(per_host)).alias("lane"),
    )
    parts = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    post = _lanes_udf(transport or UrlTransport(), retry, max_in_flight, on_error)
    posted = rows.repartition(parts, "host", "lane").withColumn("answer", post("url", "body", "headers", "key", "host", "lane"))
    return pinned(posted.select("row.*", F.col("answer").alias(out)), "posted")
