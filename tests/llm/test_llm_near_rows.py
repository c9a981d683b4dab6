"""Near duplicates: classes that meet by chance are not moved, and settled components take no further round."""

from __future__ import annotations

import numpy as np

from corpusloom.llm import common, near_dedup
from corpusloom.llm.near_dedup import COORDINATES, _candidates


def counting(monkeypatch, module):
    seen = []
    keep = module.saved

    def saved(df, label):
        out, folder = keep(df, label)
        seen.append((label, out.count()))
        return out, folder

    monkeypatch.setattr(module, "saved", saved)
    return seen


def test_chance_meetings_are_not_compared(spark, monkeypatch):
    # of 64 values a coordinate, most classes share one with another by chance, and hardly any share two
    values = np.random.default_rng(3).integers(0, 64, (100, COORDINATES)).astype(np.uint16)
    values[1] = values[0]
    rows = [(bytes([k]) * 16, 100, values[k].tobytes()) for k in range(100)]
    classes = spark.createDataFrame(rows, "set_key binary, n_shingles long, minwise binary")
    seen = counting(monkeypatch, near_dedup)
    links = {frozenset((bytes(r.a), bytes(r.b))) for r in _candidates(classes, 80, 16, 3, []).collect()}
    assert links == {frozenset((bytes([0]) * 16, bytes([1]) * 16))}
    assert sum(n for label, n in seen if label == "sized") < 500


def test_settled_components_take_no_further_round(spark, monkeypatch):
    seen = counting(monkeypatch, common)
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (6, 6), (5, 4), (9, 7), (9, 8), (9, 4)], "a long, b long")
    found, _ = common.components(edges)
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 4), (8, 4), (9, 4)]
    assert len(seen) == 2


def test_long_paths_settle(spark):
    order = np.random.default_rng(1).permutation(60).tolist()
    edges = spark.createDataFrame(list(zip(order[:-1], order[1:], strict=True)) + [(100, 101)], "a long, b long")
    found, _ = common.components(edges)
    assert sorted(map(tuple, found.collect())) == [(k, 0) for k in range(60)] + [(100, 100), (101, 100)]
