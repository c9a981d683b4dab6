import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.markup import words_in
from corpusloom.functions.retry import NO_RETRY, Clients, RetryPolicy, TransientError
from corpusloom.functions.tokens import (
    chunk_documents,
    chunk_text,
    halves,
    split_to_budget,
    split_words,
    token_count,
)


def count_words(texts):
    return [len(t.split()) for t in texts]


@pytest.mark.parametrize(
    "text, left, right",
    [
        ("One two. Three four. Five", "One two. Three four.", "Five"),
        ("Early. then no more ends here", "Early.", "then no more ends here"),
        ("no ends in here at all", "no ends in here", "at all"),
        ("aaaaaaaa", "aaaa", "aaaa"),
        ("only the last one ends.", "only the last one ends.", ""),
        ("aé", "a", "é"),
        ("éa", "é", "a"),  # the middle falls into the two bytes of é
        ("ééé", "éé", "é"),
        ("What?No space", "What?", "No space"),
        ("", "", ""),
    ],
)
def test_split_rule(text, left, right):
    assert tuple(part.decode() for part in halves(text.encode())) == (left, right)


def test_pieces_keep_order_and_budget():
    text = " ".join(f"Sentence number {i} ends here." for i in range(200))
    (pieces,) = split_to_budget([text], 30, count_words)
    assert " ".join(p for p, _ in pieces) == text
    assert all(n <= 30 for _, n in pieces)


def test_a_piece_that_cannot_be_split_stays_whole():
    text = "many words without an end until the very last one."
    assert split_to_budget([text], 3, count_words) == [[(text, 10)]]
    (strict,) = split_to_budget([text], 3, count_words, strict=True)
    assert all(n <= 3 for _, n in strict) and " ".join(p for p, _ in strict) == text


def test_nothing_and_empty():
    assert split_to_budget([None, ""], 5, count_words) == [None, [("", 0)]]


def test_one_call_per_level():
    calls = []

    def counter(texts):
        calls.append(len(texts))
        return count_words(texts)

    split_to_budget(["word " * 64, "word " * 64], 8, counter)
    assert len(calls) <= 6 and calls[0] == 2


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!?é日\n", max_size=120), st.integers(0, 12), st.booleans())
def test_pieces_make_up_the_text(text, budget, strict):
    (pieces,) = split_to_budget([text], budget, count_words, strict)
    position = 0
    for piece, tokens in pieces:
        at = text.index(piece, position)
        # only single spaces are dropped at cuts
        assert text[position:at] in ("", " ")
        position = at + len(piece)
        assert tokens == len(piece.split())
        if strict and tokens > budget:
            assert len(piece) <= 2 or len(piece.encode()) <= 4
    assert text[position:] in ("", " ")


@settings(max_examples=300, deadline=None)
@given(
    st.text(alphabet="ab .!?é日\n\t\u00a0\u3000\u2009\x1c\x85", max_size=150),
    st.integers(0, 12),
    st.booleans(),
)
def test_words_are_split_like_any_tokens(text, budget, strict):
    (expected,) = split_to_budget([text], budget, lambda texts: [words_in(t) for t in texts], strict)
    assert split_words(text, budget, strict) == expected


def test_chunks_in_spark(spark):
    df = spark.createDataFrame([(1, "One two. Three four. Five six."), (2, None), (3, "")], "k int, text string")
    rows = chunk_documents(df, "text", ["k"], 2).orderBy("k", "chunk_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 0, "One two. Three four.", 4), (1, 1, "Five six.", 2), (3, 0, "", 0),
    ]
    strict = chunk_documents(df, "text", ["k"], 2, strict_budget=True).orderBy("k", "chunk_id")
    assert [r["text"] for r in strict.collect()] == ["One two.", "Three four.", "Five six.", ""]
    lists = [r[1] for r in df.select("k", chunk_text("text", -1)).orderBy("k").collect()]
    assert lists == [["One two. Three four. Five six."], None, [""]]
    assert df.where("k = 2").select(chunk_text("text", 1, null_compat=True)).first()[0] == []


def test_token_counts(spark):
    df = spark.createDataFrame([("two words",), (None,), ("",)], "text string")
    assert [r[0] for r in df.select(token_count("text")).collect()] == [2, None, 0]
    assert [r[0] for r in df.select(token_count("text", "regex:o")).collect()] == [2, None, 0]
    assert [r[0] for r in df.select(token_count("text", null_compat=True)).collect()] == [2, 0, 0]
    by_client = token_count("text", lambda endpoint: lambda texts: [len(t) for t in texts])
    assert [r[0] for r in df.select(by_client).collect()] == [9, None, 0]
    assert df.select(token_count("text")).dtypes[0][1] == "bigint"
    with pytest.raises(ValueError, match="unknown tokenizer"):
        token_count("text", "letters")


def test_retry_policy():
    waits, answers = [], [TransientError("busy"), ConnectionError("gone"), 7]

    def ask():
        answer = answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    assert RetryPolicy(2, 1.0).call(ask, sleep=waits.append) == 7
    assert waits == [1.0, 2.0]
    answers = [ConnectionError("gone"), 7]
    with pytest.raises(ConnectionError):
        RetryPolicy(2, 1.0, retry_connect=False).call(ask, sleep=waits.append)
    answers = [TransientError("busy")]
    with pytest.raises(TransientError):
        NO_RETRY.call(ask, sleep=waits.append)
    answers = [KeyError("other"), 7]
    with pytest.raises(KeyError):
        RetryPolicy(2, 1.0).call(ask, sleep=waits.append)


def test_a_failing_counter_fails_the_query(spark):
    def unreachable(texts):
        raise ConnectionError("Failed to connect")

    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(Exception, match="Failed to connect"):
        df.select(chunk_text("text", 5, lambda endpoint: unreachable)).collect()


def test_endpoints_and_budgets_per_row(spark):
    def counter(endpoint):
        # one service counts words, the other characters
        return count_words if endpoint == "words" else lambda texts: [len(t) for t in texts]

    rows = [(1, "One two. Three.", "words", 2), (2, "One two. Three.", "other", 7), (3, "a b", None, 9)]
    df = spark.createDataFrame(rows + [(4, "a b", "words", None)], "k int, text string, e string, n int")
    counts = df.select("k", token_count("text", counter, F.col("e")).alias("x")).orderBy("k")
    assert [r.x for r in counts.collect()] == [3, 15, 3, 2]
    chunks = chunk_text("text", F.col("n"), counter, F.col("e"))
    assert [r.x for r in df.select("k", chunks.alias("x")).orderBy("k").collect()] == [
        ["One two.", "Three."], ["One two.", "Three."], ["a b"], None,
    ]
    asked = []
    clients = Clients(lambda endpoint: asked.append(endpoint))
    clients[None], clients["x"], clients[None]
    assert asked == ["http://localhost:50051", "x"]
