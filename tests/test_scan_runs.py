"""Pages are scanned a few at a time, whatever an Arrow batch holds."""

from __future__ import annotations

import pyarrow as pa

from corpusloom.functions.text import _runs_of_texts
from corpusloom.operators import html


def test_a_batch_of_pages_is_scanned_in_runs(monkeypatch):
    pages = pa.array([f"<h1>t{k}</h1><p>{'word ' * 200}</p>" if k % 7 else None for k in range(50)] + [""])
    monkeypatch.setattr(html, "SCAN_BYTES", 5000)
    assert all(len(run) == 1 or sum(len(p or "") for p in run.to_pylist()) <= 5000 for run in _runs_of_texts(pages, 5000))
    scan = html.elements_udf().func
    found = list(scan(iter([pages, pages.slice(0, 0)])))
    assert len(found) > 8
    rows = [row for part in found for row in part.to_pylist()]
    assert len(rows) == 51
    for k, row in enumerate(rows[:50]):
        assert row is None if k % 7 == 0 else [e["text"] for e in row][0] == f"t{k}"
    assert rows[50] == []
