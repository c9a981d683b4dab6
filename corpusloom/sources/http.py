"""Posting rows and batches to HTTP services.

Requests are made inside the tasks that hold the rows, up to ``max_in_flight`` at a time per
task, so the load on a service is that number times the tasks running at once (``tasks``
lowers the latter).

Spark computes a column again whenever a later step reads it twice (a sort samples its input
first) and runs a task again after a failure. So the operators on tables post at once and pin
the outcomes (``once``). A row's ``Idempotency-Key`` comes from a column that tells rows apart
(``key_col``); a batch's from its run and number. Without a key column none is sent, since rows
with equal bodies are different requests.
"""

from __future__ import annotations

import http.client
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from corpusloom.functions.retry import CONNECT_ERRORS, DEFAULT_IN_FLIGHT, InFlight, RetryPolicy
from corpusloom.functions.text import as_column, fill_nulls
from corpusloom.operators.batches import batch_arrays, batch_size_of
from corpusloom.session import pinned, scratch
from corpusloom.sources.arrays import INVALID, payload_text

RESPONSE = StructType(
    [
        StructField("status_code", IntegerType()),
        StructField("body", StringType()),
        StructField("headers", StringType()),
    ]
)
ARROW_RESPONSE = pa.struct(
    [("status_code", pa.int32()), ("body", pa.string()), ("headers", pa.string())]
)

# Waits of 0.1, 0.2 and 0.4 seconds; the status of a batch that got no answer.
HTTP_RETRY = RetryPolicy(retries=3, first_wait=0.1)
NO_ANSWER = -1


@dataclass(frozen=True)
class Request:
    url: str
    body: str
    headers: dict[str, str] = field(default_factory=dict)
    attempt: int = 0


@dataclass(frozen=True)
class Response:
    status_code: int
    body: str = ""
    headers: tuple[tuple[str, str], ...] = ()


# A transport sends one request; a ConnectionError or TimeoutError may be retried.
Transport = Callable[[Request], Response]


class PostError(Exception):
    """No response: the request could not be sent."""


MAX_REDIRECTS = 10
_SAME_REQUEST = (307, 308)
_AS_GET = (301, 302, 303)
# headers that another host must not see, and those that describe a body
_PRIVATE = ("authorization", "cookie", "proxy-authorization")
_OF_BODY = ("content-type", "content-length", "idempotency-key")


def _place(url: str) -> tuple:
    """Scheme, host and port of an address."""
    parts = urlsplit(url)
    return parts.scheme, parts.hostname, parts.port or {"http": 80, "https": 443}.get(parts.scheme)


def _without(headers: dict[str, str], names: tuple[str, ...]) -> dict[str, str]:
    return {name: value for name, value in headers.items() if name.lower() not in names}


class UrlTransport:
    """The standard library's HTTP client: kept connections per thread, redirects followed.

    A redirect to another scheme, host or port goes without credentials, one that becomes a GET
    without what describes the body.
    """

    def __init__(self, timeout: float = 30.0, max_redirects: int = MAX_REDIRECTS) -> None:
        self.timeout = timeout
        self.max_redirects = max_redirects
        self._local = threading.local()

    def __call__(self, request: Request) -> Response:
        method, url, body, headers = "POST", request.url, request.body.encode(), request.headers
        for _ in range(self.max_redirects + 1):
            response = self._send(method, url, body, headers)
            target = next((v for n, v in response.headers if n.lower() == "location"), None)
            if target is None or response.status_code not in _SAME_REQUEST + _AS_GET:
                return response
            before, url = url, urljoin(url, target)
            if _place(before) != _place(url):
                headers = _without(headers, _PRIVATE)
            if response.status_code in _AS_GET:
                method, body, headers = "GET", b"", _without(headers, _OF_BODY)
        raise PostError(f"error sending request for url ({request.url}): too many redirects")

    def _send(self, method: str, url: str, body: bytes, headers: dict[str, str]) -> Response:
        pool = self._local.__dict__.setdefault("pool", {})
        parts = urlsplit(url)
        if parts.scheme not in ("http", "https") or not parts.hostname:
            raise ValueError("not an HTTP address")
        secure = parts.scheme == "https"
        kind = http.client.HTTPSConnection if secure else http.client.HTTPConnection
        key = (parts.scheme, parts.netloc)
        connection = pool.get(key) or kind(parts.hostname, parts.port, timeout=self.timeout)
        pool[key] = connection
        target = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
        try:
            connection.request(method, target, body if method == "POST" else None, headers)
            answer = connection.getresponse()
            text = answer.read().decode("utf-8", "replace")
        except Exception as error:
            pool.pop(key).close()
            if isinstance(error, OSError) and not isinstance(error, CONNECT_ERRORS):
                raise ConnectionError(str(error)) from error  # unknown host, no route
            raise
        return Response(answer.status, text, tuple(answer.getheaders()))

    def __getstate__(self) -> dict:
        return {"timeout": self.timeout, "max_redirects": self.max_redirects}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)


def request_headers(headers: dict[str, str] | str | None, key: str | None = None) -> dict[str, str]:
    """The headers to send: a JSON object's string values, plus defaults the user left out."""
    sent = {}
    if isinstance(headers, str):
        try:
            headers = json.loads(headers) if headers else {}
        except json.JSONDecodeError as error:
            raise ValueError(f"Invalid headers JSON: {error}") from error
    if isinstance(headers, dict):
        sent = {name: value for name, value in headers.items() if isinstance(value, str)}
    given = {name.lower() for name in sent}
    if "content-type" not in given:
        sent["Content-Type"] = "application/json"
    if key is not None and "idempotency-key" not in given:
        sent["Idempotency-Key"] = key
    return sent


def retryable_status(status: int) -> bool:
    return status == 429 or 500 <= status <= 599


def post_once(
    transport: Transport,
    url: str,
    body: str,
    headers: dict[str, str] | str | None,
    retry: RetryPolicy = HTTP_RETRY,
    sleep: Callable[[float], None] = time.sleep,
    key: str | None = None,
) -> Response:
    """One POST with its retries: the last bad response is returned, the last error raised."""
    sent = request_headers(headers, key)
    for attempt in range(retry.retries + 1):
        last = attempt == retry.retries
        try:
            response = transport(Request(url, body, sent, attempt))
        except CONNECT_ERRORS as error:
            if last or not retry.retry_connect:
                raise PostError(f"error sending request for url ({url}): {error}") from error
        except Exception as error:
            raise PostError(f"error sending request for url ({url}): {error}") from error
        else:
            if last or not retryable_status(response.status_code):
                return response
        sleep(retry.wait(attempt))
    raise AssertionError("unreachable")


# answers held before they go on as one array
HELD_BYTES = 8 << 20


def outcome_of(transport: Transport, retry: RetryPolicy, on_error: str) -> Callable:
    """The call that turns (url, body, headers JSON, key) into what :func:`post_column` gives for a row."""

    def outcome(request: tuple[str | None, str | None, str | None, str | None]) -> dict | None:
        url, body, headers, key = request
        if url is None or body is None:
            return None
        try:
            answer = post_once(transport, url, body, headers, retry, key=key)
        except (PostError, ValueError) as error:
            if on_error == "fail":
                raise
            if on_error == "null":
                return None
            return {"status_code": NO_ANSWER, "body": str(error), "headers": ""}
        return {
            "status_code": answer.status_code,
            "body": answer.body,
            "headers": "\n".join(f"{name}: {value}" for name, value in answer.headers),
        }

    return outcome


def post_udf(transport: Transport, retry: RetryPolicy, max_in_flight: int, on_error: str):
    """The Arrow function of (url, body, headers JSON, key)."""
    outcome = outcome_of(transport, retry, on_error)

    def post(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        with InFlight(max_in_flight) as flight:
            for columns in batches:
                rows, held = [], 0
                for row in flight.map(outcome, zip(*(c.to_pylist() for c in columns))):
                    rows.append(row)
                    held += len(row["body"]) + len(row["headers"]) if row else 0
                    if held > HELD_BYTES:
                        yield pa.array(rows, ARROW_RESPONSE)
                        rows, held = [], 0
                if rows or not len(columns[0]):
                    yield pa.array(rows, ARROW_RESPONSE)

    return F.arrow_udf(post, RESPONSE).asNondeterministic()


def headers_column(headers: Column | dict[str, str] | str | None) -> Column:
    """A column of header texts; wrong headers for all rows fail here, before any request."""
    if isinstance(headers, Column):
        return headers
    request_headers(headers)
    return F.lit(json.dumps(headers) if isinstance(headers, dict) else headers).cast("string")


def post_column(
    url: Column | str,
    body: Column,
    headers: Column | dict[str, str] | str | None = None,
    transport: Transport | None = None,
    retry: RetryPolicy = HTTP_RETRY,
    max_in_flight: int = DEFAULT_IN_FLIGHT,
    on_error: str = "fail",
    null_compat: bool = False,
    key: Column | None = None,
) -> Column:
    """struct(status_code, body, headers) of one POST per row.

    A ``str`` url is the address of all rows; ``headers`` is a dict or JSON text for all rows,
    or a column of JSON texts; ``key`` becomes the row's Idempotency-Key. HTTP error statuses are data. Where no answer comes, the query
    fails (``on_error="fail"``), the row has status -1 and the reason (``"row"``) or NULL
    (``"null"``). NULL url or body sends nothing.
    """
    if on_error not in ("fail", "row", "null"):
        raise ValueError(f"on_error is fail, row or null, not {on_error!r}")
    headers = headers_column(headers)
    address = url if isinstance(url, Column) else F.lit(url)
    mark = F.lit(None).cast("string") if key is None else key.cast("string")
    post = post_udf(transport or UrlTransport(), retry, max_in_flight, on_error)
    result = post(address, body, headers, mark)
    empty = F.struct(
        F.lit(0).alias("status_code"), F.lit("").alias("body"), F.lit("").alias("headers")
    )
    return fill_nulls(result, empty, null_compat)


def post_rows(
    df: DataFrame,
    url: Column | str,
    body_col: str,
    out: str = "response",
    tasks: int | None = None,
    once: bool = True,
    key_col: str | None = None,
    **options,
) -> DataFrame:
    """Add ``out`` = the response to one POST per row; options as for :func:`post_column`.

    ``key_col`` names a column that tells rows apart; it goes along as Idempotency-Key, so that
    a service can see when a task is repeated. ``tasks`` deals the rows anew to so many tasks.
    With ``once`` the requests are made now and the rows come from the shared folder;
    without it they are made whenever the result is computed. Select the columns to keep
    before. To post a transformed text, apply
    :func:`corpusloom.operators.scripts.transform_text` first.
    """
    if tasks:
        df = df.repartition(tasks)
    key = F.col(f"`{key_col}`") if key_col else None
    posted = df.withColumn(out, post_column(url, as_column(body_col), key=key, **options))
    return pinned(posted, "posted") if once else posted


def response_headers(headers: Column | str) -> Column:
    """The header text of a response as a map of names in lower case; values of one name are joined by ``, ``."""
    lines = F.filter(F.split(as_column(headers), "\n"), lambda line: line != "")
    pairs = F.transform(
        lines,
        lambda line: F.struct(
            F.lower(F.substring_index(line, ":", 1)).alias("name"),
            F.trim(F.regexp_replace(line, "^[^:]*:", "")).alias("value"),
        ),
    )
    return F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform(pairs, lambda p: p.getField("name"))),
            lambda name: F.struct(
                name.alias("key"),
                F.array_join(
                    F.transform(
                        F.filter(pairs, lambda p: p.getField("name") == name),
                        lambda p: p.getField("value"),
                    ),
                    ", ",
                ).alias("value"),
            ),
        )
    )


def post_batches(
    df: DataFrame,
    payload_col: str,
    order_by: list[str],
    url: str,
    batch_size: int | str,
    headers: dict[str, str] | str | None = None,
    tasks: int | None = None,
    run_id: str | None = None,
    unique: bool = False,
    ledger: str | None = None,
    **options,
) -> DataFrame:
    """POST ``batch_size`` payloads at a time as one JSON array of strings, now.

    A batch's Idempotency-Key is ``run_id`` (by default a new one) and its number. With a ``ledger``
    (see :mod:`corpusloom.sources.ledger`) and the same ``run_id`` and rows, batches that were
    answered before a run broke off are not sent again; ``order_by`` must then order all rows.

    (batch_id, row_count, status_code, response_body), one row per batch in the order given by
    ``order_by``; a batch that got no answer is a row with status -1 and the reason.
    """
    size = batch_size_of(batch_size)
    request_headers(headers)
    run = run_id or uuid.uuid4().hex
    with scratch(df.sparkSession) as keep:
        bodies = batch_bodies(df, payload_col, order_by, size, unique)
        bodies = bodies.withColumn("key", F.concat_ws("-", F.lit(run), "batch_id"))
        if ledger:
            from corpusloom.sources.ledger import post_rows_once

            bodies = pinned(bodies, "bodies")
            posted = post_rows_once(
                bodies, url, "body", "key", ledger, headers=headers, on_error="row", tasks=tasks,
                unique=True, **options,
            )
        else:
            posted = post_rows(
                bodies, url, "body", headers=headers, on_error="row", tasks=tasks, once=False,
                key_col="key", **options,
            )
        outcomes = pinned(
            posted.select(
                "batch_id",
                "row_count",
                F.col("response.status_code").alias("status_code"),
                F.col("response.body").alias("response_body"),
            ),
            "outcomes",
        )
        keep(outcomes)
    return outcomes


def batch_bodies(
    df: DataFrame, payload_col: str, order_by: list[str], batch_size: int | str, unique: bool = False
) -> DataFrame:
    """(batch_id, row_count, body): the JSON arrays that :func:`post_batches` sends.

    A group holds ``batch_size`` rows at most, whatever the keys of the data. ``unique`` as for
    :func:`corpusloom.operators.batches.dense_positions`.
    """
    arrays = batch_arrays(df, payload_col, order_by, batch_size, unique)
    return arrays.select(
        "batch_id", F.size("payloads").alias("row_count"), F.to_json("payloads").alias("body")
    )


def payload_list(payloads: str) -> list[str]:
    """The payloads of a JSON array given as text."""
    try:
        values = json.loads(payloads)
    except json.JSONDecodeError as error:
        raise ValueError(f"{INVALID}: {error}") from error
    if not isinstance(values, list):
        raise ValueError("Payloads must be a JSON array")
    return [payload_text(value) for value in values]


def payloads_from_json(spark: SparkSession, payloads: str) -> DataFrame:
    """(position, payload) of a JSON array given as text; other values keep their JSON form."""
    return spark.createDataFrame(list(enumerate(payload_list(payloads))), "position long, payload string")


def payloads_from_lines(spark: SparkSession, path: str) -> DataFrame:
    """(position, payload) of files with one payload a line, read in parallel.

    A payload is sent as the line stands. Positions follow the files and lines in the order Spark
    splits them and have gaps between splits.
    """
    lines = spark.read.text(path)
    return lines.select(F.monotonically_increasing_id().alias("position"), F.col("value").alias("payload"))
