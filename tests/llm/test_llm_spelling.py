"""Spelling variants against a comparison by deleted letters."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import queries, spelling
from corpusloom.llm.spelling import LOWER, UPPER, neighbours, spelling_variants

CASE = str.maketrans(UPPER, LOWER)


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(CASE)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_near(words):
    """Words within one edit share a string with one letter deleted, or one is that string."""
    buckets = defaultdict(set)
    for w in words:
        buckets[w].add(w)
        for i in range(len(w)):
            buckets[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for own in buckets.values():
        for a in own:
            near[a].update(b for b in own if a != b and b not in near[a] and within_one(a, b))
    return near


def brute(rows):
    words = brute_words(rows)
    near, form = brute_near(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(out)


def got(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def test_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    found = queries.op11_spelling_variants(spark, sf_dir)
    assert dict(found.dtypes) == {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint", "root": "string"}
    wanted = brute(rows)
    assert got(found) == wanted and any(w[3] for w in wanted)


def pairs_of(df):
    return {(r.word, r.near) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_dense_vocabularies(spark, letters):
    # all places of all edits, and many words below every node
    rng = random.Random(5)
    words = {"".join(rng.choices(letters, k=rng.randint(5, 8))) for _ in range(400)}
    df = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    assert pairs_of(neighbours(df)) == {(a, b) for a, own in brute_near(words).items() for b in own}


def test_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CARRIED", 20)
    rng = random.Random(6)
    words = {"a" * k for k in range(60, 70)}
    for size in (5, 31, 33, 65, 300):
        word = "".join(rng.choices("abcé", k=size))
        words.add(word)
        for _ in range(8):
            at = rng.randrange(size)
            words |= {word[:at] + word[at + 1 :], word[:at] + "z" + word[at + 1 :], word[:at] + "z" + word[at:]}
    long = "ab" * 1_500
    words |= {long, long[:-1], "z" + long[1:]}
    words = {w for w in words if len(w) >= 5}
    df = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    near = brute_near({w for w in words if len(w) < 999})
    wanted = {(a, b) for a, own in near.items() for b in own}
    wanted |= {(long, long[:-1]), (long[:-1], long), (long, "z" + long[1:]), ("z" + long[1:], long)}
    assert pairs_of(neighbours(df)) == wanted


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Colour colour COLOUR kolour"), (3, "kolour kolour Überg überg überg überg"), (3, "kolour kolour"), (4, "colour " * 9 + "x" * 900 + " ab1cde")]
    rows += [(k, "x" * 900 + " ×÷×÷× ābcdefg bcdefh kolor") for k in range(5, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("doc", "run", "h", "word", "n", "id", "node", "rest")})
    assert got(spelling_variants(df.repartition(2))) == brute(rows)
    assert spelling_variants(df.limit(0)).collect() == []
