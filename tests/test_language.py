import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import language
from corpusloom.operators.language import (
    _counted,
    _code_points,
    _codes,
    _Block,
    _Profiles,
    _trigram_counts,
    detect_language,
    is_english,
    train_language_profiles,
)


def naive_judge(profiles, text):
    """The same rules, one trigram at a time."""
    grams = [text[i : i + 3] for i in range(len(text) - 2)]
    counts = Counter(grams)
    ranked = sorted(counts, key=lambda g: (-counts[g], g))[:600]
    place = {g: i for i, g in enumerate(ranked)}
    scores = {}
    for lang, gram, rank in profiles:
        gain = 300 - min(abs(place[gram] - rank), 300) if gram in place else 0
        scores[lang] = scores.get(lang, 0) + gain
    best, second = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:2]
    if best[1] == 0:
        return None, 0.0, False
    if second[1] == 0:
        return best[0], 1.0, True
    confidence = min(1.0, (best[1] - second[1]) / second[1] / (12 / len(counts) + 0.05))
    return best[0], confidence, confidence > 0.9


@pytest.fixture(scope="module")
def profiles(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return train_language_profiles(docs.where("doc_id % 2 = 0"), "text", "lang").cache()


def test_profiles_hold_the_most_frequent_trigrams(spark, sf_dir, profiles):
    rows = profiles.collect()
    assert {r.lang for r in rows} == {"en", "fr", "de", "es"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 0 and lang = 'en'")
    counts = Counter()
    for (text,) in docs.select(language.letters_only(F.col("text"))).collect():
        counts.update(text[i : i + 3] for i in range(len(text) - 2))
    wanted = sorted(counts, key=lambda g: (-counts[g], g))[:300]
    got = [r.trigram for r in sorted((r for r in rows if r.lang == "en"), key=lambda r: r["rank"])]
    assert got == wanted


def test_held_out_documents(spark, sf_dir, profiles):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 2 = 1")
    found = detect_language(docs, "text", profiles)
    right, total = found.agg(
        F.sum((F.col("lang") == F.col("detected_lang")).cast("int")), F.count("*")
    ).first()
    assert right / total > 0.98


def test_judging_agrees_with_the_plain_rules(profiles):
    rows = [tuple(r) for r in profiles.select("lang", "trigram", "rank").collect()]
    known, rng = _Profiles([_Block(rows)]), random.Random(3)
    grams = [g for _, g, _ in rows]
    for size in (1, 2, 5, 40, 400):
        text = " " + "".join(rng.choice(grams) for _ in range(size)) + " "
        lang, confidence, reliable = known.judge(text)
        expected = naive_judge(rows, text)
        assert (lang, reliable) == (expected[0], expected[2])
        assert confidence == pytest.approx(expected[1])


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " the quick brown fox jumps over the lazy dog " * 5
    whole = [part.tolist() for part in _counted(_code_points(text))]
    monkeypatch.setattr(language, "COUNTED_AT_ONCE", 7)
    assert [part.tolist() for part in _counted(_code_points(text))] == whole


def test_texts_do_not_run_into_each_other():
    batch = _trigram_counts("x", [" ab ", " c ", " d e "]).to_pydict()
    assert dict(zip(batch["trigram"], batch["n"])) == {
        " ab": 1, "ab ": 1, " c ": 1, " d ": 1, "d e": 1, " e ": 1,
    }


def test_codes_sort_like_text():
    grams = ["abc", "ab\U0001f600", "zzz", "éab", "a b", "日本語"]
    codes = {g: int(_codes(_code_points(g))[0]) for g in grams}
    assert sorted(grams) == sorted(grams, key=codes.get)


def test_english_or_not(spark, profiles):
    long_text = "the of and to in is on for that with are as this by be at or from " * 3
    df = spark.createDataFrame([(1, long_text), (2, None), (3, "12345 !!"), (4, "")], "k int, text string")
    got = [r[1] for r in df.select("k", is_english("text", profiles)).orderBy("k").collect()]
    assert got[1:] == [None, False, False]
    filled = df.where("k = 2").select(is_english("text", profiles, null_compat=True)).first()[0]
    assert filled is False
    row = detect_language(df.where("k = 3"), "text", profiles).first()
    assert (row.detected_lang, row.confidence, row.reliable) == (None, 0.0, False)


def test_blocks_of_languages_give_one_result(spark, sf_dir, profiles, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12345 !!")], "doc_id long, text string")
    docs = docs.unionByName(odd)
    english = docs.select("doc_id", is_english("text", profiles).alias("e"))
    wanted = sorted(map(tuple, detect_language(docs, "text", profiles).collect()))
    turns = sorted(map(tuple, english.collect()))
    for size in (1, 3):
        monkeypatch.setattr(language, "BLOCK_LANGUAGES", size)
        assert sorted(map(tuple, detect_language(docs, "text", profiles).collect())) == wanted
        again = docs.select("doc_id", is_english("text", profiles).alias("e"))
        assert sorted(map(tuple, again.collect())) == turns


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_many_languages_agree_with_the_plain_rules(size):
    """Equal profiles under several names, so that ties and skipped blocks occur."""
    rng = random.Random(5)
    grams = [a + b + c for a in "abcd" for b in "abcd" for c in "abcd"]
    rows = []
    for number in range(40):
        order = random.Random(number % 13).sample(grams, 30)
        rows += [(f"l{number:02}", gram, rank) for rank, gram in enumerate(order)]
    names = sorted({lang for lang, _, _ in rows}, key=lambda n: n[::-1])  # not in order over blocks
    parts = [names[at : at + size] for at in range(0, len(names), size)]
    known = _Profiles([_Block([r for r in rows if r[0] in part]) for part in parts])
    for length in (3, 4, 9, 60):
        for _ in range(20):
            text = "".join(rng.choice("abcd") for _ in range(length))
            lang, confidence, reliable = known.judge(text)
            expected = naive_judge(rows, text)
            assert (lang, reliable) == (expected[0], expected[2])
            assert confidence == pytest.approx(expected[1])


def test_a_block_out_of_reach_is_skipped():
    block = _Block([("x", "abc", 0), ("y", "abd", 1)])
    ranked = _codes(_code_points("abcd"))
    assert block.best(ranked, 301) == [] and block.best(ranked, 300) == [(-300, "x")]
    assert _Profiles([]).judge(" abc ") == (None, 0.0, False)


def test_detection_is_narrow(spark, sf_dir, profiles):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plan = detect_language(docs, "text", profiles)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
