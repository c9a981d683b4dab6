"""Near duplicates: a class of a large group goes on with a few links, not with one for each tree, and stars give right components."""

from __future__ import annotations

import numpy as np
import pytest

from corpusloom.llm import common
from corpusloom.llm.near_dedup import COORDINATES, _candidates


def near_group(n):
    """Classes that share nine of ten values with one text; their keys have no order in it."""
    rng = np.random.default_rng(11)
    values = np.repeat(rng.integers(0, 1 << 16, (1, COORDINATES)), n, axis=0)
    changed = rng.random((n, COORDINATES)) < 0.05
    values[changed] = rng.integers(0, 1 << 16, changed.sum())
    return [(rng.bytes(16), 100, v.astype(np.uint16).tobytes()) for v in values]


@pytest.mark.parametrize("n", [150, 600])
def test_classes_of_a_large_group_have_few_links(spark, n):
    rows = near_group(n)
    classes = spark.createDataFrame(rows, "set_key binary, n_shingles long, minwise binary")
    links = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in _candidates(classes, 80, 16, 3, []).where("a <> b").collect()}
    root = {k: k for k, *_ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    assert len({top(k) for k in root}) == 1
    assert len(links) < 4 * n


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    rng = np.random.default_rng(seed)
    links = rng.integers(0, 400, (300, 2)).tolist()
    links += [[7, k] for k in range(500, 540)] + [[a, b] for a in range(600, 612) for b in range(600, 612)]
    root = {k: k for link in links for k in link}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    found, _ = common.components(spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.root for r in found.collect()}
    linked = {k for a, b in links if a != b for k in (a, b)}
    assert got == {k: top(k) for k in linked}


def test_links_are_not_doubled_in_a_round(spark, monkeypatch):
    plans = []
    keep = common.saved

    def saved(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(common, "saved", saved)
    common.components(spark.createDataFrame([(k, 0) for k in range(1, 20)], "a long, b long"))
    assert plans and not any("Generate" in p for p in plans)
