"""Language identification from trigram profiles learned on a corpus.

Rank-order profiles after Cavnar and Trenkle, "N-Gram-Based Text Categorization" (1994).
Training is a distributed count; detection is narrow. The profiles travel as inverted indexes of some
hundred languages each, and a text skips those whose best language could not be among its best two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from corpusloom.functions.text import as_column, fill_nulls

# Fixed by the method: ranks from 600 on can earn nothing, so leaving them out loses nothing.
PROFILE_SIZE = 300
DOCUMENT_SIZE = 600
RELIABLE_ABOVE = 0.9
# from this rank on a profile trigram can earn nothing either
LAST_RANK = DOCUMENT_SIZE + PROFILE_SIZE
# languages in one index: at most a few megabytes are sent at once
BLOCK_LANGUAGES = 500
# characters whose trigrams a task sorts together
COUNTED_AT_ONCE = 1 << 21
_POINT = (1 << 21) - 1

RESULT = StructType(
    [
        StructField("lang", StringType()),
        StructField("confidence", DoubleType()),
        StructField("reliable", BooleanType()),
    ]
)


def letters_only(text: Column) -> Column:
    """Lower case, every run of non-letters one space, a space at both ends."""
    spaced = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.btrim(spaced), F.lit(" "))


def _codes(points: np.ndarray) -> np.ndarray:
    """One integer per trigram, in the order of the trigrams as text."""
    points = points.astype(np.int64)
    return (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _counted(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of a text, sorted, and their counts.

    A long text is counted in parts that overlap by two characters.
    """
    parts = [
        np.unique(_codes(points[at : at + COUNTED_AT_ONCE + 2]), return_counts=True)
        for at in range(0, len(points) - 2, COUNTED_AT_ONCE)
    ]
    if len(parts) == 1:
        return parts[0]
    codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.zeros(len(codes), dtype=np.int64)
    np.add.at(counts, place, np.concatenate([n for _, n in parts]))
    return codes, counts


def _trigram_counts(lang: str, texts: list[str]) -> pa.RecordBatch:
    """Trigrams of several texts of one language with their counts.

    The texts are counted as one: where they meet there are two spaces, which no text has
    inside, so trigrams over a border are known by them.
    """
    codes, counts = _counted(_code_points("".join(texts)))
    first, second, third = codes >> 42, (codes >> 21) & _POINT, codes & _POINT
    space = ord(" ")
    inside = (second != space) | ((first != space) & (third != space))
    trigrams = [
        chr(a) + chr(b) + chr(c)
        for a, b, c in zip(*(part[inside].tolist() for part in (first, second, third)))
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(trigrams), pa.string()),
            pa.array(trigrams, pa.string()),
            pa.array(counts[inside].astype(np.int64)),
        ],
        names=["lang", "trigram", "n"],
    )


def _count_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per (lang, trigram) of some millions of characters at a time."""
    waiting: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if len(text) < 3:
                continue
            waiting.setdefault(lang, []).append(text)
            size += len(text)
            if size >= COUNTED_AT_ONCE:
                yield from (_trigram_counts(*item) for item in waiting.items())
                waiting, size = {}, 0
    yield from (_trigram_counts(*item) for item in waiting.items())


def train_language_profiles(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, trigram, rank): the 300 most frequent trigrams of every language, rank from 0.

    Trigrams are counted where they are read; only counts per (lang, trigram) are shuffled,
    and each task passes on no more than its first 300 per language to the ranking.
    """
    lang, text = F.col(f"`{lang_col}`"), F.col(f"`{text_col}`")
    texts = df.where(lang.isNotNull() & text.isNotNull()).select(
        lang.alias("lang"), letters_only(text).alias("text")
    )
    counted = texts.mapInArrow(_count_in_task, "lang string, trigram string, n long")
    counts = counted.groupBy("lang", "trigram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "trigram")
    return (
        counts.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= PROFILE_SIZE)
        .select("lang", "trigram", (F.col("place") - 1).alias("rank"))
    )


# a trigram of one language in eight has a row of ranks over all languages instead of postings
DENSE = 8
_ABSENT = 1 << 14
# so many gains of at most 300 add up within 16 bits
_ADDED_AT_ONCE = 100


class _Block:
    """The profile trigrams of some languages as an inverted index."""

    def __init__(self, rows: list[tuple[str, str, int]]) -> None:
        self.languages = sorted({lang for lang, _, _ in rows})
        index = {lang: i for i, lang in enumerate(self.languages)}
        codes = np.array([_codes(_code_points(t))[0] for _, t, _ in rows], dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, starts = np.unique(codes[order], return_index=True)
        self.starts = np.append(starts, len(rows))
        self.langs = np.array([index[lang] for lang, _, _ in rows], dtype=np.int32)[order]
        self.ranks = np.array([rank for _, _, rank in rows], dtype=np.int16)[order]
        sizes = np.diff(self.starts)
        dense = sizes * DENSE >= len(self.languages)
        self.row = np.where(dense, np.cumsum(dense) - 1, -1)
        self.table = np.full((int(dense.sum()), len(self.languages)), _ABSENT, dtype=np.int16)
        in_table = np.repeat(dense, sizes)
        self.table[np.repeat(self.row, sizes)[in_table], self.langs[in_table]] = self.ranks[in_table]

    def best(self, ranked: np.ndarray, needed: int) -> list[tuple[int, str]]:
        """The best two languages for a document's ranked trigrams, as (-score, language).

        Nothing where no language of the block can reach ``needed``.
        """
        at = np.minimum(np.searchsorted(self.codes, ranked), len(self.codes) - 1)
        places = np.flatnonzero(self.codes[at] == ranked)
        if not len(places) or PROFILE_SIZE * len(places) < needed:
            return []
        scores = np.zeros(len(self.languages), dtype=np.int64)
        row = self.row[at[places]]
        dense, rare = row >= 0, row < 0
        if dense.any():
            gains = self._gains(self.table[row[dense]], places[dense, np.newaxis])
            for start in range(0, len(gains), _ADDED_AT_ONCE):
                scores += gains[start : start + _ADDED_AT_ONCE].sum(axis=0, dtype=np.int16)
        if rare.any():
            first = self.starts[at[places[rare]]]
            sizes = self.starts[at[places[rare]] + 1] - first
            # the postings of these trigrams, one run after another
            ends = np.cumsum(sizes)
            postings = np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)
            gains = self._gains(self.ranks[postings], np.repeat(places[rare], sizes))
            scores += np.bincount(
                self.langs[postings], weights=gains, minlength=len(scores)
            ).astype(np.int64)
        found = []
        for _ in range(min(2, len(scores))):
            top = int(np.argmax(scores))
            if scores[top] > 0:
                found.append((-int(scores[top]), self.languages[top]))
            scores[top] = 0
        return found


    @staticmethod
    def _gains(ranks: np.ndarray, places: np.ndarray) -> np.ndarray:
        """What trigrams at these places earn; made in place of the ranks."""
        ranks -= places.astype(np.int16)
        np.abs(ranks, out=ranks)
        np.minimum(ranks, PROFILE_SIZE, out=ranks)
        return np.subtract(PROFILE_SIZE, ranks, out=ranks)


class _Profiles:
    """Profiles in blocks, for lookup of a document's ranked trigrams."""

    def __init__(self, blocks: list[_Block]) -> None:
        self.blocks = blocks

    def judge(self, text: str) -> tuple[str | None, float, bool]:
        """The best language, how clear the choice is, and whether it can be relied on."""
        points = _code_points(text)
        if len(points) < 3:
            return None, 0.0, False
        trigrams, counts = _counted(points)
        ranked = trigrams[np.argsort(-counts, kind="stable")[:DOCUMENT_SIZE]]
        best: list[tuple[int, str]] = []
        for block in self.blocks:
            needed = -best[1][0] if len(best) > 1 else 1
            best = sorted(best + block.best(ranked, needed))[:2]
        if not best:
            return None, 0.0, False
        if len(best) == 1:
            confidence = 1.0
        else:
            first, second = -best[0][0], -best[1][0]
            wanted = 12.0 / len(trigrams) + 0.05
            confidence = min(1.0, (first - second) / second / wanted)
        return best[0][1], confidence, confidence > RELIABLE_ABOVE


def _profile_blocks(profiles: DataFrame) -> Iterator[_Block]:
    """The profiles in blocks of languages; the driver holds one block and one part at a time."""
    known = profiles.where(F.col("lang").isNotNull() & (F.col("rank") < LAST_RANK))
    # the ranking left the languages together: no further shuffle
    grouped = known.groupBy("lang").agg(F.collect_list(F.struct("trigram", "rank")).alias("rows"))
    waiting: list[tuple[str, str, int]] = []
    languages = 0
    for lang, rows in grouped.toLocalIterator():
        waiting += [(lang, trigram, rank) for trigram, rank in rows]
        languages += 1
        if languages == BLOCK_LANGUAGES:
            yield _Block(waiting)
            waiting, languages = [], 0
    if waiting:
        yield _Block(waiting)


def language_judge(profiles: DataFrame):
    """The Arrow function behind :func:`language_of`, for texts of letters and single spaces."""
    context = profiles.sparkSession.sparkContext
    sent = [context.broadcast(block) for block in _profile_blocks(profiles)]

    @F.arrow_udf(RESULT)
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _Profiles([block.value for block in sent])
        kind = pa.struct(
            [("lang", pa.string()), ("confidence", pa.float64()), ("reliable", pa.bool_())]
        )
        names = kind.names
        for batch in batches:
            judged = [
                None if text is None else dict(zip(names, known.judge(text)))
                for text in batch.to_pylist()
            ]
            yield pa.array(judged, kind)

    return detect


def language_of(text: Column | str, profiles: DataFrame) -> Column:
    """struct(lang, confidence, reliable) per text; NULL for NULL.

    ``profiles`` is read once and sent in blocks of 500 languages (300 rows each, at most 900), some 7 MB
    of memory for each thousand languages in a task; a trigram is in a language's profile once. The
    text is neither shuffled nor exploded.
    """
    return language_judge(profiles)(letters_only(as_column(text)))


def detect_language(df: DataFrame, text_col: str, profiles: DataFrame) -> DataFrame:
    """Add detected_lang, confidence and reliable, for any number of languages.

    See :func:`language_of`; of languages with one score the first in code-point order is taken.
    """
    judged = df.withColumn("__language", language_of(F.col(f"`{text_col}`"), profiles))
    return judged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("__language.lang").alias("detected_lang"),
        F.col("__language.confidence").alias("confidence"),
        F.col("__language.reliable").alias("reliable"),
    )


def is_english(
    text: Column | str, profiles: DataFrame, english: str = "en", null_compat: bool = False
) -> Column:
    """True where the text is reliably English, NULL for NULL."""
    judged = language_of(text, profiles)
    found = (judged.lang == english) & judged.reliable
    known = F.when(judged.isNotNull(), F.coalesce(found, F.lit(False)))
    return fill_nulls(known, False, null_compat)
