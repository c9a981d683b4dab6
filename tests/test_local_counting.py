"""Local tokenizers count in the task itself."""

from __future__ import annotations

import pyarrow as pa

from corpusloom.functions import tokens


def test_local_tokenizers_are_not_sent_through_threads(monkeypatch):
    def threads(*_):
        raise AssertionError("a local counter was called through threads")

    monkeypatch.setattr(tokens, "ask_all", threads)
    split = tokens.chunks_udf("regex:[[:alpha:]]+|[0-9]", counted=True).func
    columns = pa.array(["one two. three 4", None]), pa.array([2, 2], pa.int32()), pa.array([None, None], pa.string())
    (found,) = split(iter([columns]))
    assert found.to_pylist() == [[{"text": "one two.", "n_tokens": 2}, {"text": "three 4", "n_tokens": 2}], None]


def test_counts_are_those_of_all_matches():
    for pattern, text in ((r"(a)(b)?|\d", "ab a1"), (r"x*", "axb"), (r"\w+$", "a b")):
        factory, _ = tokens._local_counter("regex:" + pattern)
        found = sum(1 for _ in tokens.library_pattern(pattern).finditer(text))
        assert factory(None)([text]) == [found], pattern
