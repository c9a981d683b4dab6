import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.retry import RetryPolicy
from corpusloom.operators.scripts import ScriptError, transform_text
from corpusloom.sources.arrays import payloads_from_file
from corpusloom.sources.http import (
    HTTP_RETRY,
    PostError,
    Request,
    Response,
    UrlTransport,
    payloads_from_json,
    payloads_from_lines,
    post_batches,
    post_once,
    post_rows,
    request_headers,
    response_headers,
)

URL = "http://service.example/post"
NO_WAIT = RetryPolicy(3, 0.0)


class Scripted:
    """Answers in turn; an exception is raised."""

    def __init__(self, *answers):
        self.answers, self.requests = list(answers), []

    def __call__(self, request):
        self.requests.append(request)
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer if isinstance(answer, Response) else Response(answer, f"body {answer}")


@pytest.mark.parametrize(
    "answers, status, waits",
    [
        ([200], 200, []),
        ([404], 404, []),
        ([429, 200], 200, [0.1]),
        ([500, 503, 201], 201, [0.1, 0.2]),
        ([500, 500, 500, 502], 502, [0.1, 0.2, 0.4]),
        ([ConnectionError("no"), TimeoutError("slow"), 200], 200, [0.1, 0.2]),
    ],
)
def test_retries(answers, status, waits):
    slept, transport = [], Scripted(*answers)
    answer = post_once(transport, URL, "x", None, HTTP_RETRY, slept.append)
    assert answer.status_code == status
    assert slept == pytest.approx(waits)
    assert [r.attempt for r in transport.requests] == list(range(len(answers)))
    assert not any("Idempotency-Key" in r.headers for r in transport.requests)


def test_no_connection_raises_after_the_retries():
    slept, transport = [], Scripted(*[ConnectionRefusedError("refused")] * 4)
    with pytest.raises(PostError, match="error sending request"):
        post_once(transport, URL, "x", None, HTTP_RETRY, slept.append)
    assert len(slept) == 3


def test_other_errors_are_not_retried():
    slept, transport = [], Scripted(ValueError("bad url"))
    with pytest.raises(PostError):
        post_once(transport, URL, "x", None, HTTP_RETRY, slept.append)
    assert slept == []


def test_request_headers():
    plain = {"Content-Type": "application/json", "Idempotency-Key": "k"}
    assert request_headers(None) == {"Content-Type": "application/json"}
    assert request_headers(None, "k") == request_headers("", "k") == plain
    assert request_headers('["a"]', "k") == plain
    assert request_headers('{"A": "1", "B": 2}', "k") == {"A": "1", **plain}
    own = request_headers({"content-type": "text/plain", "idempotency-key": "mine"}, "k")
    assert own == {"content-type": "text/plain", "idempotency-key": "mine"}
    with pytest.raises(ValueError, match="Invalid headers JSON"):
        request_headers("not valid json", "k")


def echo(request: Request) -> Response:
    if "down" in request.body:
        raise ConnectionError("refused")
    return Response(200, request.body.upper(), (("A", request.headers.get("X", "")), ("B", "2")))


@pytest.fixture
def df(spark):
    rows = [(1, "up", '{"X": "one"}'), (2, None, None), (3, "down", None)]
    return spark.createDataFrame(rows, "id int, body string, headers string")


def responses(frame):
    return [r["response"] for r in frame.orderBy("id").collect()]


def test_rows(df):
    up = responses(post_rows(df.where("id < 3"), URL, "body", headers=F.col("headers"), transport=echo))
    assert up[0].asDict() == {"status_code": 200, "body": "UP", "headers": "A: one\nB: 2"}
    assert up[1] is None
    filled = post_rows(df.where("id = 2"), URL, "body", transport=echo, null_compat=True)
    assert responses(filled)[0].asDict() == {"status_code": 0, "body": "", "headers": ""}
    parsed = post_rows(df.where("id = 1"), URL, "body", transport=echo).select(
        response_headers("response.headers")
    )
    assert parsed.first()[0] == {"a": "", "b": "2"}


def test_errors(df):
    with pytest.raises(Exception, match="error sending request"):
        post_rows(df, URL, "body", transport=echo, retry=NO_WAIT).collect()
    as_row = responses(post_rows(df, URL, "body", transport=echo, retry=NO_WAIT, on_error="row"))
    assert as_row[2].status_code == -1 and "refused" in as_row[2].body
    assert responses(post_rows(df, URL, "body", transport=echo, retry=NO_WAIT, on_error="null"))[2] is None
    with pytest.raises(ValueError, match="on_error"):
        post_rows(df, URL, "body", on_error="skip")
    with pytest.raises(ValueError, match="Invalid headers JSON"):
        post_rows(df, URL, "body", headers="not valid json")


def test_a_wrong_script_fails_before_any_request(df):
    with pytest.raises(ScriptError, match="Script compilation error"):
        post_rows(transform_text(df, "body", "invalid syntax +++"), URL, "body", transport=echo)


def test_many_rows_keep_their_answers(spark):
    df = spark.range(0, 2000, numPartitions=3).select("id", F.col("id").cast("string").alias("body"))
    rows = post_rows(df, URL, "body", transport=echo, max_in_flight=4, tasks=2).collect()
    assert all(r.response.body == str(r.id) for r in rows) and len(rows) == 2000


def answer_batch(request: Request) -> Response:
    payloads = json.loads(request.body)
    assert all(isinstance(p, str) for p in payloads)
    if "bad" in payloads:
        raise ConnectionError("refused")
    return Response(500 if "broken" in payloads else 200, "|".join(payloads))


def test_batches(spark):
    rows = list(enumerate(["a", "b", "bad", "c", "broken"]))
    df = spark.createDataFrame(rows, "id int, payload string").repartition(3)
    posted = post_batches(df, "payload", ["id"], URL, "2", "", transport=answer_batch, retry=NO_WAIT)
    got = [tuple(r) for r in posted.orderBy("batch_id").collect()]
    assert posted.columns == ["batch_id", "row_count", "status_code", "response_body"]
    assert got[0] == (0, 2, 200, "a|b")
    assert got[1][:3] == (1, 2, -1) and "refused" in got[1][3]
    assert got[2] == (2, 1, 500, "broken")
    with pytest.raises(ValueError, match="greater than 0"):
        post_batches(df, "payload", ["id"], URL, "0")


def test_the_standard_transport_without_a_service():
    # nothing listens here, so the request fails before it is sent
    with pytest.raises(PostError, match="error sending request"):
        post_once(UrlTransport(timeout=2), "http://127.0.0.1:59999/post", "{}", None, NO_WAIT)


class FakeConnection:
    """Stands in for the standard library's connection; no port is opened."""

    sent: list = []
    headers: list = []
    answers: list = []

    def __init__(self, host, port=None, timeout=None):
        self.place = (host, port)

    def request(self, method, target, body, headers):
        self.sent.append((self.place, method, target, body))
        self.headers.append(headers)

    def getresponse(self):
        status, headers, text = self.answers.pop(0)

        class Answer:
            def read(self):
                return text.encode()

            def getheaders(self):
                return headers

        answer = Answer()
        answer.status = status
        return answer

    def close(self):
        pass


@pytest.mark.parametrize(
    "status, method, body", [(307, "POST", b"x"), (308, "POST", b"x"), (302, "GET", None)]
)
def test_redirects(monkeypatch, status, method, body):
    monkeypatch.setattr("corpusloom.sources.http.http.client.HTTPConnection", FakeConnection)
    FakeConnection.sent, FakeConnection.answers = [], [
        (status, [("Location", "/new?a=1")], ""), (200, [("X", "1")], "done"),
    ]
    answer = UrlTransport()(Request("http://host:81/old", "x"))
    assert (answer.status_code, answer.body, answer.headers) == (200, "done", (("X", "1"),))
    assert FakeConnection.sent == [
        (("host", 81), "POST", "/old", b"x"), (("host", 81), method, "/new?a=1", body),
    ]


@pytest.mark.parametrize("target, kept", [("/b", True), ("http://other/b", False), ("http://host:82/b", False), ("https://host/b", False)])
def test_credentials_stay_with_the_host(monkeypatch, target, kept):
    for kind in ("HTTPConnection", "HTTPSConnection"):
        monkeypatch.setattr(f"corpusloom.sources.http.http.client.{kind}", FakeConnection)
    FakeConnection.headers, FakeConnection.answers = [], [(307, [("location", target)], ""), (200, [], "")]
    sent = {"Authorization": "a", "cookie": "c", "X": "1", "Idempotency-Key": "k"}
    UrlTransport()(Request("http://host/a", "x", sent))
    assert FakeConnection.headers[1] == (sent if kept else {"X": "1", "Idempotency-Key": "k"})
    FakeConnection.headers, FakeConnection.answers = [], [(303, [("location", "/b")], ""), (200, [], "")]
    UrlTransport(max_redirects=1)(Request("http://host/a", "x", {**sent, "Content-Type": "t"}))
    assert FakeConnection.headers[1] == {"Authorization": "a", "cookie": "c", "X": "1"}


def key_of(request: Request) -> Response:
    return Response(200, request.headers.get("Idempotency-Key", ""), (("Set-Cookie", "a=1"), ("set-cookie", "b: 2"), ("X", "")))


def test_keys_tell_rows_and_batches_apart(spark):
    df = spark.createDataFrame([(i, "same") for i in range(6)], "id int, body string")
    keys = [r.response.body for r in post_rows(df, URL, "body", transport=key_of, key_col="id").collect()]
    assert sorted(keys) == [str(i) for i in range(6)]
    assert {r.response.body for r in post_rows(df, URL, "body", transport=key_of).collect()} == {""}
    runs = [post_batches(df, "body", ["id"], URL, 2, transport=key_of, run_id=run) for run in ("r", "r", None)]
    first, again, other = ([r.response_body for r in run.orderBy("batch_id").collect()] for run in runs)
    assert first == again == ["r-0", "r-1", "r-2"] and len(set(other) - set(first)) == 3


def test_repeated_response_headers(spark):
    df = spark.createDataFrame([(1, "x")], "id int, body string")
    posted = post_rows(df, URL, "body", transport=key_of).select(response_headers("response.headers"))
    assert posted.first()[0] == {"set-cookie": "a=1, b: 2", "x": ""}


def test_payload_texts(spark, tmp_path):
    wanted = ["a", '{"a":2,"b":1}', "null", "1.0"]
    text = '["a", {"b": 1, "a": 2}, null, 1.0]'
    assert [r.payload for r in payloads_from_json(spark, text).collect()] == wanted
    (tmp_path / "p.json").write_text(text)
    assert [r.payload for r in payloads_from_file(spark, f"{tmp_path}/p.json").orderBy("position").collect()] == wanted
    for bad, said in (("", "Invalid payloads JSON"), ("{}", "must be a JSON array"), ("[1", "Invalid payloads JSON")):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match=said):
            payloads_from_file(spark, f"{tmp_path}/bad.json").collect()
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines/a.txt").write_text("x\n[1]\n")
    assert [r.payload for r in payloads_from_lines(spark, f"{tmp_path}/lines").orderBy("position").collect()] == ["x", "[1]"]


def test_endless_redirects(monkeypatch):
    monkeypatch.setattr("corpusloom.sources.http.http.client.HTTPConnection", FakeConnection)
    FakeConnection.sent, FakeConnection.answers = [], [(307, [("Location", "/")], "")] * 20
    with pytest.raises(PostError, match="too many redirects"):
        UrlTransport()(Request("http://host/", "x"))


def test_an_address_that_is_none():
    with pytest.raises(PostError, match="error sending request"):
        post_once(UrlTransport(), "not-a-url", "{}", None, NO_WAIT)
