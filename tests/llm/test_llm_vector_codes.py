"""Codes of vectors against plain Lloyd rounds over all points and entries."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import vector_codes
from corpusloom.llm.vector_codes import assign, books_of, codebooks_digest, compress_vectors, with_label_errors


def nearest(points, entries):
    distance = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    return distance.argmin(axis=1), distance.min(axis=1)


def plain(rows, parts, entries, rounds, scale):
    """rows: (key, vector, label), all of them good, in the order in which codebooks begin."""
    values = np.array([[math.floor(scale * x) for x in v] for _, v, _ in rows], np.int64)
    codes, errors, books = [], np.zeros(len(rows), np.int64), []
    for part in np.split(values, parts, axis=1):
        book = part[:entries].copy()
        for _ in range(rounds):
            own, _ = nearest(part, book)
            for e in set(own.tolist()):
                total = part[own == e].sum(axis=0)
                book[e] = [int(t) // int((own == e).sum()) for t in total]
        own, distance = nearest(part, book)
        codes.append(own)
        errors += distance
        books.append(book)
    return np.array(codes).T.tolist(), errors.tolist(), np.array(books)


@pytest.mark.parametrize("leaf", [1, 4, 16])
@pytest.mark.parametrize("spread", [3, 40, 4000])
def test_assignment(monkeypatch, leaf, spread):
    monkeypatch.setattr(vector_codes, "LEAF", leaf)
    random = np.random.default_rng(spread + leaf)
    for rows, entries in ((1, 1), (5, 3), (200, 16), (97, 7)):
        centres = random.integers(-spread, spread, (3, entries, 4))
        points = centres[:, random.integers(0, entries, rows)] + random.integers(-2, 3, (3, rows, 4))
        order, borders = vector_codes._ordered(points, leaf)
        trees = vector_codes._boxes(np.take_along_axis(points, order[:, :, None], axis=1), borders)
        found = assign(trees, books_of(centres))
        got = np.full((3, rows), -1)
        for level, part, node, entry in found.nodes:
            for p, k, e in zip(part, node, entry, strict=True):
                got[p, borders[level][k] : borders[level][k + 1]] = e
        got[found.part, found.row] = found.entry
        for p in range(3):
            assert (got[p] == nearest(trees.points[p], centres[p])[0]).all()
        if spread == 4000 and rows > 50 and leaf > 1:
            assert found.nodes and any(len(x[1]) for x in found.nodes)  # whole nodes are assigned where points lie apart


NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(3)
    rows = [(k * 3 % 601, random.normal(size=16).tolist(), ["x", None, "y"][k % 3]) for k in range(300)]
    rows += [(900, rows[5][1], "x"), (900, rows[6][1], "x"), (None, rows[7][1], None), (0, rows[0][1], "y")]
    bad = [(-5, None, "x"), (-4, [], "x"), (-3, [NAN] + [0.0] * 15, "x"), (-2, [None] + [0.0] * 15, "x"), (-1, [-INF] + [0.0] * 15, None)]
    return rows, bad


def test_codes(spark, vectors, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 50)
    rows, bad = vectors
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label string").repartition(3)
    df = df.withColumns({c: F.lit(7) for c in ("key", "vector", "size", "points", "code", "error", "of", "n")})
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, errors, books = plain(rows, 4, 9, 3, 100)
    coded = compress_vectors(df, parts=4, entries=9, rounds=3, scale=100)
    assert (coded.codebooks == books).all()
    totals = {}
    for (_, _, label), error in zip(rows, errors, strict=True):
        totals[label] = totals.get(label, 0) + error
    wanted = [(key, label, code, error, totals[label]) for (key, _, label), code, error in zip(rows, codes, errors, strict=True)]
    got = [(r.key, r.label, r.code, r.error, r.label_error) for r in with_label_errors(coded.rows).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_few_rows_equal_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>, label int"
    one = compress_vectors(spark.createDataFrame([(5, [0.5] * 8, 1)], schema))
    assert [(r.key, r.code, r.error) for r in one.rows.collect()] == [(5, [0] * 8, 0)] and one.codebooks.tolist() == [[[2048]]] * 8
    same = compress_vectors(spark.createDataFrame([(k, [0.25] * 16, None) for k in range(40)], schema))
    assert {(tuple(r.code), r.error) for r in same.rows.collect()} == {((0,) * 8, 0)}
    none = compress_vectors(spark.createDataFrame([(1, None, 1)], schema))
    assert with_label_errors(none.rows).collect() == [] and len(codebooks_digest(none.codebooks)) == 64


def test_wrong_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    for rows in ([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 9, 1)], [(1, [1e9] * 8, 1)]):
        with pytest.raises(ValueError):
            compress_vectors(spark.createDataFrame(rows, schema))
