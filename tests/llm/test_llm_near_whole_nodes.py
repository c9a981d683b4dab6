"""Near duplicates in nodes that stay whole: every link is found, also far from the node's first class."""

from __future__ import annotations

import numpy as np

from corpusloom.llm import near_dedup
from corpusloom.llm.near_dedup import COORDINATES, _candidates


def test_loose_classes_of_whole_nodes_meet_all_classes(spark, monkeypatch):
    # all classes share 40 of 64 values of which the trees see enough to keep them together; a few pairs share more
    rng = np.random.default_rng(5)
    n = 240
    values = rng.integers(0, 1 << 16, (n, COORDINATES)).astype(np.uint16)
    values[:, :30] = values[0, :30]
    for k in range(0, n, 2):
        values[k + 1, :44] = values[k, :44]
    rows = [(bytes([k]) * 16, 100, values[k].tobytes()) for k in range(n)]
    classes = spark.createDataFrame(rows, "set_key binary, n_shingles long, minwise binary")
    # the root's children are whole nodes: nothing branches beyond the first level
    monkeypatch.setattr(near_dedup, "DEEPEST", 1)
    for chunk, piece in ((512, 2048), (16, 50)):
        monkeypatch.setattr(near_dedup, "CHUNK", chunk)
        monkeypatch.setattr(near_dedup, "PIECE", piece)
        folders: list[str] = []
        links = {frozenset((bytes(r.a), bytes(r.b))) for r in _candidates(classes, 80, 16, 3, folders).collect()}
        root = {r[0]: r[0] for r in rows}

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for link in links:
            a, b = (*link, *link)[:2]
            root[max(top(a), top(b))] = min(top(a), top(b))
        assert [k for k in range(0, n, 2) if top(bytes([k]) * 16) != top(bytes([k + 1]) * 16)] == []
        # and no class is a candidate of one that does not look alike
        assert len({top(r[0]) for r in rows}) == n // 2
