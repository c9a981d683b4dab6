"""Token counts of all scripts: the words are the library's, and few stretches are left to it."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm.token_counts import Splitter, count_tokens, whole_words

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "It’s “quoted” — don't… 5½ €20 №7", "Ὀδυσσεύς ΟΔΟΣ σοφός Σ", "Съешь ещё этих мягких булок ЁЖ", "日本語のテキスト、全部。中文字符１２３", "שלום עולם", "नमस्ते दुनिया", "한국어 문장",
    "한 각", "İstanbul ISPARTA ıı", "été café", "a b c　d", "👩‍👩‍👧 ❤️ 🙂🙂", "Å K K", "x <|endoftext|> y<|startoftext|>z <| |>", "﻿bom ​zero",
    "ﬁne ﬂy ſ", "\x1c\x1d a\x00b \x85c", "مرحبا بالعالم ٣٤٥", "'S ’s 'ſ ʼs", "́lone", "½ⅷⅧ", "ǅ ǆ Ǆ", "ẞ ß",
]


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def wanted(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def counted(library, text, splitter=Splitter(PATH)):
    words, stretches = splitter.split(text)
    return sum(wanted(library, w) for w in words) + sum(wanted(library, s) for s in stretches)


def test_texts_of_many_scripts(spark, library):
    rows = list(enumerate(TEXTS + [" ".join(TEXTS), "".join(TEXTS)]))
    for r in count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect():
        assert r.n_tokens == wanted(library, rows[r.doc_id][1]), rows[r.doc_id][1]


def test_every_character(library):
    """Each between letters, digits and signs, as one text of a stretch each."""
    rest = [chr(n) for n in [*range(0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F000, 0x1FB00), *range(0x20000, 0x30000, 499)]]
    for at in range(0, len(rest), 997):
        some = rest[at : at + 997]
        text = " ".join(f"ab{c}cd 1{c}2 !{c}? {c}{c}" for c in some)
        assert counted(library, text) == wanted(library, text), hex(ord(some[0]))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    library = LIBRARY
    assert counted(library, text) == wanted(library, text)


def test_mixtures(library):
    rng = random.Random(5)
    signs = sorted(set("".join(TEXTS)))
    for _ in range(500):
        text = "".join(rng.choices(signs, k=30))
        assert counted(library, text) == wanted(library, text), text


def test_what_is_left_to_the_library():
    splitter = Splitter(PATH)
    for text in ("“Ça” — it’s", "ΟΔΟΣ и ёж", "日本語、中文。", "مرحبا ٣", "a b"):
        assert splitter.split(text)[1] == [], text
    assert splitter.split("plain “x” café more <|a|> end") == (["plain", "“", "x", "”", "more", "end"], ["café", "<|a|>"])


def test_all_strings_are_tried(library):
    whole = whole_words(PATH)
    assert any(not w.isascii() and w.isalpha() for w in whole) and {"’", "…"} & whole
    assert all(wanted(library, w) == 1 for w in random.Random(1).sample(sorted(whole), 2000))
