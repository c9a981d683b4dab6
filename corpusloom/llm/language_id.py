"""Language identification: the family first, then the languages in it one against another.

Texts are counted in hashed runs of two to four bytes (letters lower-cased, everything else a space).
Linear support vector machines, one for every pair of families and one for every pair of languages of
a family, vote; the family with most votes is taken, then the language in it. They are trained on the
driver on a bounded sample of labelled rows, ``SAMPLE_ROWS`` texts at most, as many of each language,
chosen by the hash of the text. Prediction is a sum of weights over the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import buffers
from corpusloom.llm.common import slices, small_batches, texts_of

MACHINES = 4096
SAMPLE_ROWS = 1024
FEATURES = 1 << 14
UNKNOWN = "und"

# Families of common language codes; any other language is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nl no nb nn sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "austronesian": "id jv ms tl",
}
FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages.split()}


class Machine(NamedTuple):
    """A linear support vector machine between two names; ``slope`` and ``shift`` turn its margin into a probability."""

    left: str
    right: str
    weights: np.ndarray
    slope: float
    shift: float


class Model(NamedTuple):
    families: dict[str, list[str]]
    between: list[Machine]
    within: list[Machine]


def grams(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The feature of each run of bytes, and the number of runs before each text."""
    before, after, between = (pa.scalar(x, pa.large_string()) for x in (" ", "  ", ""))
    padded = pc.binary_join_element_wise(before, texts, after, between)
    raw, offsets = buffers(padded)
    letter = (((raw | 32) >= 97) & ((raw | 32) <= 122)) | (raw >= 128)
    plain = np.where(letter, np.where(raw < 128, raw | 32, raw), 32).astype(np.uint32)
    if len(plain) < 4:
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    two = plain[:-1] | plain[1:] << 8
    three = two[:-1] | plain[2:] << 16
    four = three[:-1] | plain[3:] << 24
    starts = np.zeros(len(plain), bool)
    starts[: len(four)] = (two[: len(four)] & 0xFFFF) != 0x2020
    # the last three places of a text would run into the next
    for k in (1, 2, 3):
        starts[np.maximum(offsets[1:] - k, 0)] = False
    at = np.flatnonzero(starts)
    out = np.empty((len(at), 3), np.int64)
    for k, run in enumerate((two, three, four)):
        hashed = (run[at] ^ np.uint32(0x9E3779B9 + k)) * np.uint32(0x85EBCA6B)
        hashed ^= hashed >> np.uint32(15)
        out[:, k] = (hashed * np.uint32(0xC2B2AE35)) >> np.uint32(18)
    return out.ravel(), np.searchsorted(at, offsets) * 3


def train_machine(left: str, right: str, x: np.ndarray, rows: np.ndarray, side: np.ndarray, rounds: int = 12, cost: float = 10.0) -> Machine:
    """Dual coordinate descent for the squared hinge loss on some rows of ``x``; ``side`` is 1 for left and -1 for right."""
    weights, alpha = np.zeros(x.shape[1], np.float32), np.zeros(len(rows))
    diagonal = np.einsum("ij,ij->i", x, x)[rows] + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            own = x[rows[i]]
            slope = side[i] * (own @ weights) - 1 + 0.5 / cost * alpha[i]
            after = max(alpha[i] - slope / diagonal[i], 0.0)
            if after != alpha[i]:
                weights += np.float32((after - alpha[i]) * side[i]) * own
                moved = max(moved, abs(after - alpha[i]))
                alpha[i] = after
        if moved < 1e-3:
            break
    margin, slope, shift = (x @ weights)[rows].astype(np.float64), 4.0, 0.0
    wanted = (side > 0).astype(float)
    for _ in range(30):  # Newton steps of a damped logistic fit
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        error, spread = wanted - p, p * (1 - p)
        a, b, c = (spread * margin**2).sum() + 0.05, (spread * margin).sum(), spread.sum() + 0.05
        ga, gb = (error * margin).sum() - 0.05 * (slope - 4.0), error.sum() - 0.05 * shift
        slope, shift = slope + (c * ga - b * gb) / (a * c - b * b), shift + (a * gb - b * ga) / (a * c - b * b)
    return Machine(left, right, weights.astype(np.float32), float(slope), float(shift))


def _sampled_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            feature, first = grams(texts_of(part.column("text")))
            found = [np.unique(feature[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
            lists = [pa.array([x[k].astype(np.int32) for x in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.record_batch([part.column("lang"), part.column("hash"), *lists], names=["lang", "hash", "feature", "n"])


def train_languages(df: DataFrame, sample_rows: int = SAMPLE_ROWS, families: dict[str, str] | None = None) -> Model:
    """Learn from rows (text, lang); rows without text or lang are left out. ``families`` names the family of a language.

    A language without family is one of its own. There is a machine for each pair of families and of
    languages in one; more than ``MACHINES`` (64 KB each, they are sent to all tasks) raise a ValueError.
    """
    small_batches(df.sparkSession)
    family_of = FAMILY_OF if families is None else families
    rows = df.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    known = rows.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    languages = max(1, rows.select("lang").distinct().count())
    many = max(1, sample_rows // languages)
    # of a common language each of 64 tasks passes on the first texts by hash, then these are ranked
    dealt = Window.partitionBy("lang", F.pmod("hash", F.lit(64))).orderBy("hash")
    first = known.withColumn("rank", F.row_number().over(dealt)).where(F.col("rank") <= many)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("rank") <= many)
    chosen = [r.hash for r in ranked.select("hash").collect()]
    texts = rows.where(F.col("hash").isin(chosen)).groupBy("lang", "hash").agg(F.first("text").alias("text"))
    found = texts.mapInArrow(_sampled_counts, "lang string, hash long, feature array<int>, n array<int>").toArrow()
    found = found.sort_by([("lang", "ascending"), ("hash", "ascending")]).combine_chunks()
    found = found.filter(pc.greater(pc.list_value_length(found.column("feature")), 0))
    lang = np.array(found.column("lang").to_pylist(), dtype=object)
    x = np.zeros((len(lang), FEATURES), np.float32)
    for k in range(len(lang)):
        counts = found.column("n")[k].values.to_numpy()
        x[k, found.column("feature")[k].values.to_numpy()] = counts / counts.sum()
    # shares of runs are small numbers: bring them to length one on average, and the weights back below
    scale = np.float32(1 / max(1e-9, float(np.sqrt(np.einsum("ij,ij->i", x, x)).mean()))) if len(x) else np.float32(1)
    x *= scale
    family = np.array([family_of.get(name, name) for name in lang], dtype=object)
    names = {f: sorted(set(lang[family == f])) for f in sorted(set(family))}

    pairs = sum(len(own) * (len(own) - 1) // 2 for own in (names, *names.values()))
    if pairs > MACHINES:
        raise ValueError(f"{pairs} pairs of languages or families need a machine each; name families so that there are at most {MACHINES}")

    def machines(label: np.ndarray, values: list[str]) -> list[Machine]:
        out = []
        for a, b in combinations(values, 2):
            own = np.flatnonzero((label == a) | (label == b))
            trained = train_machine(a, b, x, own, np.where(label[own] == a, 1.0, -1.0))
            out.append(trained._replace(weights=trained.weights * scale))
        return out

    return Model(names, machines(family, list(names)), [m for f in names for m in machines(lang, names[f])])


def _vote(rows: int, names: list[str], machines: list[Machine], margins: dict[tuple[str, str], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The name with most votes in each row (ties: the larger sum of probabilities) and its least probability."""
    wins = np.zeros((rows, len(names)))
    least = np.ones((rows, len(names)))
    at = {n: k for k, n in enumerate(names)}
    for m in machines:
        if m.left in at and m.right in at:
            p = 1 / (1 + np.exp(-np.clip(m.slope * margins[m.left, m.right] + m.shift, -30, 30)))
            for name, own in ((m.left, p), (m.right, 1 - p)):
                wins[:, at[name]] += (own > 0.5) + own * 1e-3
                least[:, at[name]] = np.minimum(least[:, at[name]], own)
    best = wins.argmax(axis=1)
    return best, least[np.arange(rows), best]


def _predict(sent: Broadcast, pred: str, level: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        names = list(model.families)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = texts_of(part.column("text"))
                feature, first = grams(texts)
                many, filled = np.maximum(np.diff(first), 1), np.flatnonzero(np.diff(first))
                margins = {}
                for m in [*model.between, *model.within]:
                    sums = np.zeros(len(texts))
                    if len(filled):
                        sums[filled] = np.add.reduceat(m.weights[feature], first[filled])
                    margins[m.left, m.right] = sums / many
                lettered = pc.match_substring_regex(texts, r"[A-Za-z]").to_pylist()
                lang, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                if names:
                    family, sure = _vote(len(texts), names, model.between, margins)
                    for k, name in enumerate(names):
                        best, p = _vote(len(texts), model.families[name], model.within, margins)
                        own = family == k
                        lang[own] = np.array(model.families[name], dtype=object)[best[own]]
                        score[own] = (sure * p)[own]
                    for k, text in enumerate(texts):
                        if not lettered[k] and not any(c.isalpha() for c in text.as_py()):
                            lang[k], score[k] = UNKNOWN, 0.0
                yield pa.record_batch([*part.columns, pa.array(lang.tolist(), pa.string()), pa.array(score)], names=[*part.schema.names, pred, level])

    return run


def identify(df: DataFrame, model: Model, pred: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """Add lang_pred and lang_score (0 to 1) to rows with ``text``; every other column passes as it is.

    ``pred`` and ``score`` give the two columns other names; columns that have these names already are
    replaced. lang_pred is a learned language, or ``und`` with score 0 where the text is null or has no letters,
    or where nothing was learned. Prediction looks at the text alone. An empty table gives no rows.
    """
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    df = df.drop(pred, score)
    fields = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(df.columns, df.schema.fields, strict=True))
    return df.mapInArrow(_predict(sent, pred, score), f"{fields}, `{pred}` string, `{score}` double")


def held_out() -> Column:
    """Whether a document is kept back from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
