import os
import time
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.session import new_folder
from corpusloom.sources.http import Response
from corpusloom.sources.lanes import host_of, post_by_host
from corpusloom.sources.ledger import drop_ledger, ledger_answers, post_rows_once
from corpusloom.streaming.sinks import post_batches_stream, post_stream
from test_streaming import run, stream_of

URL = "http://service.example/post"


class MachineLost(BaseException):
    """No error of the request."""


class Service:
    """Notes every key it is sent; breaks off at one body while ``broken`` is there."""

    def __init__(self, folder, fatal="", error=RuntimeError):
        os.makedirs(f"{folder}/sent", exist_ok=True)
        self.folder, self.fatal, self.error = str(folder), fatal, error
        if fatal:
            open(f"{folder}/broken", "w").close()

    def __call__(self, request):
        key = request.headers["Idempotency-Key"]
        if self.fatal and self.fatal in request.body and os.path.exists(f"{self.folder}/broken"):
            raise self.error("the machine is lost")
        with open(f"{self.folder}/sent/{uuid.uuid4().hex}", "w") as file:
            file.write(key)
        return Response(404 if request.body.endswith("7") else 200, request.body.upper())

    def mend(self):
        os.remove(f"{self.folder}/broken")

    def sent(self):
        return Counter(open(f"{self.folder}/sent/{name}").read() for name in os.listdir(f"{self.folder}/sent"))


@pytest.fixture
def rows(spark):
    return spark.range(0, 200, numPartitions=4).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("b"), "id").alias("body"))


@pytest.mark.parametrize("flush", [1, 64])
def test_a_run_that_breaks_off_goes_on(spark, rows, tmp_path, flush):
    service, ledger = Service(tmp_path, "b133"), new_folder(spark, "ledger")
    with pytest.raises(Exception, match="machine is lost"):
        post_rows_once(rows, URL, "body", "key", ledger, transport=service, max_in_flight=4, flush=flush)
    before = service.sent()
    assert 0 < len(before) < 200
    service.mend()
    found = post_rows_once(rows, URL, "body", "key", ledger, transport=service, flush=flush)
    assert found.where("response.body = upper(body)").count() == 200
    assert found.where("response.status_code = 404").count() == 20
    assert len(service.sent()) == 200 and set(service.sent().values()) == {1}
    assert ledger_answers(spark, ledger).count() == 200
    drop_ledger(spark, ledger)


def test_keys_repeated_and_missing(spark, rows, tmp_path):
    service, ledger = Service(tmp_path), new_folder(spark, "ledger")
    found = post_rows_once(rows.union(rows), URL, "body", "key", ledger, transport=service)
    assert found.count() == 400 and found.where("response IS NULL").count() == 0
    assert len(service.sent()) == 200 and set(service.sent().values()) == {1}
    missing = rows.limit(3).withColumn("key", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="has no key"):
        post_rows_once(missing, URL, "body", "key", new_folder(spark, "ledger"), transport=service).collect()
    assert post_rows_once(rows.limit(0), URL, "body", "key", ledger, transport=service).count() == 0
    with pytest.raises(ValueError, match="flush"):
        post_rows_once(rows, URL, "body", "key", ledger, flush=0)


def test_what_got_no_answer_is_sent_again(spark, rows, tmp_path):
    service, ledger = Service(tmp_path, "b13"), new_folder(spark, "ledger")
    first = post_rows_once(rows, URL, "body", "key", ledger, transport=service, on_error="row")
    assert first.where("response.status_code = -1").count() == 11
    service.mend()
    second = post_rows_once(rows, URL, "body", "key", ledger, transport=service, on_error="row")
    assert second.where("response.status_code = -1").count() == 0
    assert len(service.sent()) == 200 and set(service.sent().values()) == {1}


def test_a_stream_that_breaks_off_midway(spark, sf_dir, tmp_path):
    events = stream_of(spark, sf_dir, "events").select("event_id", F.col("event_id").cast("string").alias("body"))
    service, ledger = Service(tmp_path / "service", '"500"', MachineLost), str(tmp_path / "ledger")

    def writer():
        return post_batches_stream(
            events, "body", ["event_id"], URL, 10, f"{tmp_path}/out", f"{tmp_path}/cp", ledger,
            transport=service, max_in_flight=2, tasks=2,
        )

    with pytest.raises(Exception, match="machine is lost"):
        writer().trigger(availableNow=True).start().awaitTermination(120)
    service.mend()
    before = len(service.sent())
    run(writer())
    sent = service.sent()
    assert len(sent) == 100 and set(sent.values()) == {1} and 0 < before < 100
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 100 and out.agg(F.sum("row_count")).first()[0] == 1000


def test_rows_of_a_stream_with_a_ledger(spark, sf_dir, tmp_path):
    events = stream_of(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), "event_type")
    service = Service(tmp_path / "service")
    run(post_stream(events, URL, "event_type", f"{tmp_path}/out", f"{tmp_path}/cp", f"{tmp_path}/ledger", "key", transport=service))
    assert set(service.sent().values()) == {1} and len(service.sent()) == 1000
    with pytest.raises(ValueError, match="key_col"):
        post_stream(events, URL, "event_type", "out", "cp", "ledger")


class Busy:
    """Answers with the most requests that any host had at once, its own included."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self, request):
        host = request.url.split("/")[2]
        os.makedirs(f"{self.folder}/{host}", exist_ok=True)
        mark = f"{self.folder}/{host}/{uuid.uuid4().hex}"
        open(mark, "w").close()
        time.sleep(0.01)
        most = len(os.listdir(f"{self.folder}/{host}"))
        os.remove(mark)
        return Response(200, str(most))


@pytest.mark.parametrize("per_host", [1, 3])
def test_a_bound_for_each_host(spark, tmp_path, per_host):
    urls = spark.range(0, 240, numPartitions=4).select(
        "id", F.when(F.col("id") % 3 < 2, F.lit("http://User@Busy.example:80/x")).otherwise(F.concat(F.lit("https://h"), F.col("id") % 5, F.lit(".example?q"))).alias("url")
    )
    urls = urls.withColumn("url", F.replace("url", F.lit("User@Busy"), F.lit("busy")))
    found = post_by_host(urls, F.col("url"), "url", per_host=per_host, transport=Busy(tmp_path), tasks=4)
    most = {r.host: r.most for r in found.groupBy(host_of("url").alias("host")).agg(F.max(F.col("response.body").cast("int")).alias("most")).collect()}
    assert found.count() == 240 and len(most) == 6
    assert max(most.values()) <= per_host
    if per_host > 1:
        assert most["busy.example:80"] > 1


def test_lanes_of_other_rows(spark):
    rows = spark.createDataFrame([(1, None, "b"), (2, "no address", "b"), (3, "http://U:p@Host.Example:8/p", None)], "host int, url string, lane string")
    found = post_by_host(rows, F.col("url"), "lane", transport=lambda r: Response(200, "x"), tasks=2)
    assert {r.host: r.response and r.response.body for r in found.collect()} == {1: None, 2: "x", 3: None}
    assert [r.h for r in rows.select(host_of("url").alias("h")).collect()] == [None, "", "host.example:8"]
    with pytest.raises(ValueError, match="per_host"):
        post_by_host(rows, "http://a/", "lane", per_host=0)
