"""Overlaps of texts that repeat themselves, and test items of a few words."""

import itertools
import random
import time

import numpy as np
import pytest

from corpusloom.llm import decontamination
from corpusloom.llm.decontamination import benchmark_overlaps, best_stretch, decontaminate, longest_stretch, too_short


def by_one_shift_each(own, test, agree, min_words):
    best = None
    for shift in range(1 - len(test), len(own)):
        low, high = max(0, -shift), min(len(test), len(own) - shift)
        same = test[low:high] == own[shift + low : shift + high]
        b, e = longest_stretch(same.astype(float), agree)
        if e - b >= min(min_words, len(test)):
            hit = (e - b, int(same[b:e].sum()), shift + low + b)
            best = hit if best is None else max(best, hit)
    return best


@pytest.mark.parametrize("compared", [7, 1 << 20])
def test_the_best_of_all_shifts(monkeypatch, compared):
    monkeypatch.setattr(decontamination, "_COMPARED", compared)
    rng = random.Random(2)
    for _ in range(400):
        own, test = (np.array(rng.choices(range(rng.choice((1, 2, 3, 9))), k=rng.randint(1, 40)), np.uint64) for _ in range(2))
        least, agree = rng.choice((1, 3, 13)), rng.choice((0.5, 0.8, 1.0))
        shifts = np.arange(1 - len(test), len(own))
        assert best_stretch(own, test, shifts, agree, least) == by_one_shift_each(own, test, agree, least)


@pytest.mark.parametrize("expanded", [5, 1 << 20])
def test_repeating_texts(spark, monkeypatch, expanded):
    monkeypatch.setattr(decontamination, "_EXPANDED", expanded)
    rng = random.Random(4)
    items = [(1, "a " * 30), (2, "a b " * 12), (3, "x y z " * 9 + "end"), (4, "a"), (5, " ".join("w%d" % k for k in range(40)))]
    docs = [(k, " ".join(rng.choices(["a", "b"], weights=[9, 1], k=80))) for k in range(8)]
    docs += [(10, "a b " * 50), (11, "z x y " * 20), (12, "a"), (13, None), (14, ""), (15, "q " * 100), (16, "w39 " + items[4][1])]
    found = benchmark_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = {}
    for (d, text), (i, item) in itertools.product(docs, items):
        hit = by_one_shift_each(np.array((text or "").split()), np.array(item.split()), 0.8, 13) if (text or "").split() else None
        if hit:
            wanted[d, i] = hit
    assert {(r.doc_id, r.item_id): (r.n_words, r.n_equal, r.first_word) for r in found} == wanted


def test_a_long_line_of_one_word(spark):
    rows = [(1, "word " * 200_000), (2, "one two " * 100_000)]
    items = spark.createDataFrame([(1, "word " * 400), (2, "one two " * 200)], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.monotonic()
    found = benchmark_overlaps(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.n_words, r.n_equal) for r in found} == {(1, 1, 400, 400), (2, 2, 400, 400)}
    assert time.monotonic() - start < 60


def test_items_of_a_few_words_condemn_nothing(spark):
    docs = spark.createDataFrame([(1, "the quick fox jumps over it"), (2, "the end"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "The\tquick"), (3, None), (4, " "), (5, "quick fox jumps over it")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate(docs, items).collect()) == [2, 3]
    assert sorted(r.doc_id for r in decontaminate(docs, items.where("item_id < 5")).collect()) == [1, 2, 3]
    assert [r.doc_id for r in decontaminate(docs, items, least_item=1).collect()] == [3]
    assert sorted(map(tuple, too_short(items).collect())) == [(1, 1), (2, 2), (3, 0), (4, 0)]
    assert {r.item_id for r in benchmark_overlaps(docs, items).collect()} == {1, 2, 5}
