"""Token counts with a shortcut for words that are one token.

Which vocabulary strings encode alone as one token is proved once, on the driver, by encoding each
of them. A text is then split like the tokenizer splits it; words found in that set count one, and
only other words are merged, each distinct one once per slice. Characters beyond plain Latin are
treated as the file itself was seen to treat each of them alone; only stretches between white space
that hold special strings, marks or other characters that act on their neighbours are left to the library.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import slices, texts_of
from corpusloom.llm.packing import byte_letters

TOKEN_LIMIT = 2048
KNOWN_WORDS = 1 << 18

# The normalizer and the split pattern of the word-end BPE files that the shortcut reads.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Letters that are composed, that every lower-casing treats alike, and nothing but which (with ASCII) a plain text has.
_LATIN = "À-ÖØ-öø-įıĲ-ƺ"
_LOWER = "a-zß-öø-ƺ"
_OTHER = re.compile(rf"[^\t\n\r -~{_LATIN}]|<\|")
_PLAIN = frozenset(c for c in map(chr, range(0x250)) if not _OTHER.match(c))
_ANY_WORDS = regex.compile(PATTERN)
_GAPS = re.compile(r"[\t\n\r ]+")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^\s0-9{_LOWER}]+")


@lru_cache(maxsize=2)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def library_counter(path: str) -> Callable[[list[str]], list[int]]:
    """Counts as the file's own library gives them."""
    library = _library(path)
    if path.endswith(".json"):
        return lambda texts: [len(x.ids) for x in library.encode_batch_fast(texts, add_special_tokens=False)]
    return lambda texts: [len(x) for x in library.encode(texts, num_threads=1)]


def whole_words(path: str) -> frozenset[str]:
    """The words that the file encodes alone as one token; empty if the shortcut can't read its kind."""
    if not path.endswith(".json"):
        return frozenset()
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", ())]
    splits = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())]
    suffix = spec["model"].get("end_of_word_suffix")
    if steps != NORMALIZERS or splits[:1] != [PATTERN] or not suffix:
        return frozenset()
    letters, words = byte_letters(), []
    for token, number in spec["model"]["vocab"].items():
        if token.endswith(suffix) and len(token) > len(suffix):
            words.append((bytes(letters[c] for c in token.removesuffix(suffix)).decode("utf-8", "replace"), number))
    found = _library(path).encode_batch_fast([w for w, _ in words], add_special_tokens=False)
    return frozenset(w for (w, number), x in zip(words, found, strict=True) if x.ids == [number])


class Splitter:
    """Texts to words as a word-end BPE file splits them; what acts across characters stays whole."""

    # what the file's own split makes of a character between two letters, and of two of them
    KINDS = {(1, 1): r"\p{L}", (3, 2): r"\p{N}", (2, 0): r"\s", (3, 1): r"[^\s\p{L}\p{N}]"}

    def __init__(self, path: str) -> None:
        library = _library(path)
        self._normal, self._pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self._seen: set[str] = set()
        self._whole: set[str] = set()  # characters whose stretch goes to the library
        self._written: dict[int, str] = {}

    def _judge(self, c: str) -> None:
        self._seen.add(c)
        normal = self._normal(c)
        # marks and parts of syllables compose with others; format characters may do anything
        alone = unicodedata.category(c)[0] not in "MC" and not any(a <= c <= b for a, b in ("\u1100\u11ff", "\ua960\ua97f", "\ud7b0\ud7ff"))
        if alone and len(normal) == 1 and normal == self._normal(normal) == normal.lower():
            kind = self.KINDS.get((len(self._pieces(f"a{normal}a")), len(self._pieces(normal * 2))))
            if kind and regex.fullmatch(kind, normal):
                self._written[ord(c)] = normal
                return
        self._whole.add(c)

    def split(self, text: str) -> tuple[list[str], list[str]]:
        """The words of a text, and stretches of it that only the library can count."""
        if not _OTHER.search(text):
            return _WORDS.findall(text.lower()), []
        odd = set(text).difference(_PLAIN)
        for c in odd.difference(self._seen):
            self._judge(c)
        whole = odd.intersection(self._whole)
        stretches: list[str] = []
        if whole or "<|" in text:
            held = re.compile("|".join(["<\\|", *map(re.escape, sorted(whole))]))
            parts: tuple[list[str], list[str]] = [], stretches
            for part in _GAPS.split(text):
                parts[held.search(part) is not None].append(part)
            text = " ".join(parts[0])
        return _ANY_WORDS.findall(text.translate(self._written).lower()), stretches


def _counts(path: str, proved: Broadcast, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, whole = library_counter(path), proved.value
        known = dict.fromkeys(whole, 1)
        splitter = Splitter(path) if whole else None
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts = texts_of(part.column("text")).to_pylist()
                if splitter:
                    split = [splitter.split(t) for t in texts]
                    rest = list(set(chain.from_iterable(w for w, _ in split)).difference(known))
                    known.update(zip(rest, count(rest), strict=True))
                    odd = list(set(chain.from_iterable(s for _, s in split)))
                    others = dict(zip(odd, count(odd), strict=True))
                    out = [sum(map(known.__getitem__, w)) + sum(map(others.__getitem__, s)) for w, s in split]
                else:
                    out = [count([t])[0] for t in texts]
                if len(known) > len(whole) + KNOWN_WORDS:
                    known = dict.fromkeys(whole, 1)
                sizes = [len(t.encode()) for t in texts]
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(out, pa.int64()), pa.array([n > limit for n in out], pa.bool_())]
                yield pa.record_batch(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def count_tokens(df: DataFrame, tokenizer: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Tokens of every whole text of (doc_id, text), as the file's library counts them without added tokens.

    Returns doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``). ``tokenizer`` is
    the path of a tokenizers (.json) or sentencepiece (.model) file that all executors can read. Stretches
    between white space that hold special strings, combining marks or format characters, and all texts
    for files of another kind than word-end BPE, are counted by the library itself.

    A null or empty text has 0 bytes and 0 tokens. Each row is returned, also where ids are missing or
    repeated. An empty table gives no rows. Further columns are ignored. There is no shuffle.
    """
    proved = df.sparkSession.sparkContext.broadcast(whole_words(tokenizer))
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_counts(tokenizer, proved, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
