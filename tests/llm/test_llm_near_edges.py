"""Near duplicates on small and odd tables, and at other thresholds, against all pairs."""

import random

import pytest

from corpusloom.llm import near_dedup
from corpusloom.llm.near_dedup import alike, near_duplicates, trees_for


def components(rows, shingle, percent):
    sets = {}
    for doc, text in rows:
        words = text.lower().split()
        sets[doc] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc: (find(doc), len(sets[doc])) for doc in sets}


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.component_id, r.n_shingles) for r in near_duplicates(df, **options).collect()}


WORDS = [f"w{k}" for k in range(100)]
TABLES = {
    "one inside another": [(1, " ".join(WORDS)), (2, " ".join(WORDS[:40]))],
    "short": [(1, "a"), (2, "a b c d e"), (3, "q r s t u v w x y z a b c d e f")],
    "one row": [(1, "a b c")],
    "nothing in common": [(k, " ".join(f"{k}x{i}" for i in range(30))) for k in range(40)],
}


@pytest.mark.parametrize("name", TABLES)
@pytest.mark.parametrize("shingle", [2, 5])
def test_tables_without_near_pairs(spark, name, shingle):
    assert got(spark, TABLES[name], shingle=shingle) == components(TABLES[name], shingle, 80)


@pytest.mark.parametrize("percent", [50, 65, 90, 100])
def test_other_thresholds(spark, percent):
    rng = random.Random(percent)
    rows = []
    for family in range(12):
        base = [f"{family}v{k}" for k in range(120)]
        for _ in range(4):
            words = list(base)
            for _ in range(rng.randint(0, 25)):
                words[rng.randrange(120)] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(words[: rng.randint(70, 120)])))
    assert got(spark, rows, shingle=2, percent=percent) == components(rows, 2, percent)


def test_large_nodes_branch_on(spark, monkeypatch):
    # one template of half of each text, so that nodes are large, and pairs of near copies within it
    monkeypatch.setattr(near_dedup, "PIECE", 40)
    rng = random.Random(4)
    template = [f"t{k}" for k in range(60)]
    rows = []
    for pair in range(150):
        own = [f"{pair}p{k}" for k in range(50)]
        for _ in range(2):
            words = template + list(own)
            words[rng.randrange(60, 110)] = f"y{rng.random()}"
            rows.append((len(rows), " ".join(words)))
    assert got(spark, rows, shingle=2) == components(rows, 2, 80)


def test_thresholds():
    assert (alike(80), trees_for(80, 3)) == (36, 16)
    assert alike(50) < 36 and trees_for(50, 3) > 60
    with pytest.raises(ValueError):
        near_duplicates(None, percent=40)
