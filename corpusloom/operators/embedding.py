"""Embeddings from a service, through a client the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from corpusloom.functions.retry import (
    CALL_TEXTS,
    EMBED_RETRY,
    Clients,
    InFlight,
    RetryPolicy,
    ask_all,
    rows_by_endpoint,
)
from corpusloom.functions.text import as_column, fill_nulls
from corpusloom.functions.tokens import endpoint_column
from corpusloom.functions.vectors import vectors_of
from corpusloom.session import pinned

# A client turns a list of texts into as many vectors; a factory makes one for an endpoint
# inside each task.
Client = Callable[[list[str]], list[list[float]]]
ClientFactory = Callable[[str], Client]

# Fixed value: embedding calls in flight at once.
EMBED_IN_FLIGHT = 4
CALL_SIZE = CALL_TEXTS
# A text is hot when it has more rows than half a shuffle partition should, or than the bytes to
# broadcast allow.
BROADCAST_BYTES = 64 << 20


def fake_client(dim: int) -> ClientFactory:
    """A client that answers with the deterministic stand-in vectors."""

    def make(endpoint: str) -> Client:
        return lambda texts: vectors_of(pa.array(texts, pa.string()), dim).to_pylist()

    return make


def embed_udf(
    client: ClientFactory,
    retry: RetryPolicy = EMBED_RETRY,
    max_in_flight: int = EMBED_IN_FLIGHT,
    call_size: int = CALL_SIZE,
):
    """The Arrow function of (text, endpoint)."""

    @F.arrow_udf(ArrayType(DoubleType()))
    def vectors(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        clients = Clients(client)
        with InFlight(max_in_flight) as flight:
            for batch in batches:
                texts, endpoints = (column.to_pylist() for column in batch)
                result: list[list[float] | None] = [None] * len(texts)
                for endpoint, rows in rows_by_endpoint(texts, endpoints).items():
                    distinct = list(dict.fromkeys(texts[row] for row in rows))
                    answers = ask_all(flight, clients[endpoint], distinct, retry, call_size)
                    found = dict(zip(distinct, answers, strict=True))
                    for row in rows:
                        result[row] = found[texts[row]]
                yield pa.array(result, pa.list_(pa.float64()))

    return vectors.asNondeterministic()


def embed(
    text: Column | str,
    client: ClientFactory,
    endpoint: Column | str | None = None,
    null_compat: bool = False,
    **options,
) -> Column:
    """One vector per text. Equal texts in an Arrow batch are sent once; no shuffle.

    An error that the retries do not cure fails the query. ``options`` are those of
    :func:`embed_udf`.
    """
    result = embed_udf(client, **options)(as_column(text), endpoint_column(endpoint))
    return fill_nulls(result, F.array().cast("array<double>"), null_compat)


def embed_column(
    df: DataFrame,
    text_col: str,
    client: ClientFactory,
    out: str = "embedding",
    dedupe: str = "batch",
    **options,
) -> DataFrame:
    """Add ``out`` = the embedding of ``text_col``.

    ``dedupe="batch"`` embeds where the rows are. ``dedupe="global"`` sends every distinct text
    of the whole table once and joins the vectors back on a digest, for services that cost more
    than a shuffle. The rows are computed once and pinned, so a text that would come out otherwise
    a second time keeps its row. Texts with so many copies that they would fill a shuffle
    partition get their vectors by broadcast and are not shuffled at all.
    """
    if dedupe == "batch":
        return df.withColumn(out, embed(F.col(f"`{text_col}`"), client, **options))
    if dedupe != "global":
        raise ValueError(f"dedupe is batch or global, not {dedupe!r}")
    return _embed_distinct(df, text_col, client, out, **options)


def _embed_distinct(
    df: DataFrame, text_col: str, client: ClientFactory, out: str, **options
) -> DataFrame:
    text = F.col(f"`{text_col}`")
    keyed = pinned(df.drop(out).withColumn("__digest", F.sha2(text, 256)), "texts")
    copies = keyed.where("__digest IS NOT NULL").groupBy("__digest").agg(
        F.first(text).alias("__text"), F.count(F.lit(1)).alias("__n")
    )
    # written once, so that no later step or repeated task asks the service again
    vectors = pinned(
        copies.select(
            "__digest",
            "__n",
            embed(F.col("__text"), client, **options).alias(out),
            F.lit(True).alias("__found"),
        ),
        "vectors",
    )
    total, longest = vectors.agg(F.sum("__n"), F.max(F.size(out))).first()
    # fewer than 1 / share texts can each hold more than that share of the rows
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / (2 * parts), ((longest or 0) * 8 + 100) / BROADCAST_BYTES)
    is_hot = F.col("__n") > (total or 0) * share
    hot = F.broadcast(vectors.where(is_hot).drop("__n"))
    rest = vectors.where(~is_hot).drop("__n")

    known = F.col("__found") | F.col("__digest").isNull()
    at_once = keyed.join(hot, "__digest", "left").where(known)
    others = keyed.where("__digest IS NOT NULL").join(hot.select("__digest"), "__digest", "left_anti")
    joined = others.join(rest, "__digest", "left")
    checked = F.when(F.col("__found"), F.col(out)).otherwise(
        F.raise_error(F.lit("a text has no embedding")).cast("array<double>")
    )
    result = at_once.unionByName(joined.withColumn(out, checked))
    return result.drop("__digest", "__found")
