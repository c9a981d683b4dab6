"""Spelling variants by walking a trie relationally: states joined with a table of edges, level by level.

1. Runs of letters become words by expressions alone and are counted; a task passes on one row a word.
2. The vocabulary makes two tries, of the words and of the reversed words. A node is the hash of its
   prefix and its depth; the edges (node, label, child) are a table that no task holds.
3. Words within one edit share either their first half or their last half. So the walk of a word
   begins in the middle: the way there is its own and needs no join. From every later place the state
   (word, position, node, edits) makes its one edit: it replaces the next letter, by a join with the
   edges of its node, or deletes it. A letter inserted is a letter deleted from the other word.
4. States whose edit is made must follow the rest of their word. Each level is one join on (node,
   label), which has at most one match. From a node at a depth that 16, 256 or 4,096 divides, a state
   with so many letters left takes an edge over all of them, so levels grow with the logarithm of the
   longest word. States that end on a word become neighbours, after a check of the words themselves.
5. Forms and roots are joins of the neighbours; a chain of forms is halved in every round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bytewords import mix
from corpusloom.llm.common import drop_folders, release, saved

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIVISOR = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
STRIDES = (4096, 256, 16)
CARRIED = 64  # letters; the rest of a longer word is looked up when an edit is made
FACTOR = 0x9E3779B97F4A7C15
BACK = pow(FACTOR, -1, 1 << 64)
_SEEDS = (np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179))  # of the words, and of the reversed words


def word_counts(df: DataFrame) -> DataFrame:
    """The words of all whole texts (doc_id, text) and their numbers, as (word, n).

    Words are maximal runs of letters, A-Z as a-z. A run whose crc32 together with its doc_id is
    divisible by 97 loses a letter. A null text has none; a missing doc_id counts as an empty one.
    """
    runs = F.explode(F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("run")
    rows = df.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), runs)
    hashed = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", hashed.alias("h"))
    at = F.expr("cast(h % char_length(run) as int)")
    without = F.concat(F.substring("run", F.lit(1), at), F.expr("substring(run, cast(h % char_length(run) as int) + 2)"))
    word = F.when(F.col("h") % DIVISOR == 0, without).otherwise(F.col("run"))
    words = rows.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def _series(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), np.uint64(base))
    out[0] = 1
    return np.cumprod(out)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each of the sizes, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Spelled:
    """The letters of a batch of words, one after the other, in one direction, and the hashes of all prefixes."""

    def __init__(self, words: list[str], backwards: bool):
        self.words = [w[::-1] for w in words] if backwards else words
        self.raw = np.frombuffer("".join(self.words).encode("latin-1"), np.uint8)
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.seed = _SEEDS[backwards]
        most = int(self.size.max(initial=0))
        place = _runs(self.size)
        terms = (self.raw.astype(np.uint64) + np.uint64(1)) * _series(FACTOR, most + 1)[place]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        self.back = _series(BACK, most + 1)

    def nodes(self, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node of the first ``depth`` letters of each ``word``."""
        total = self.sums[self.first[word] + depth] - self.sums[self.first[word]]
        return mix(mix(total ^ self.seed) + depth.astype(np.uint64))

    def labels(self, word: np.ndarray, at: np.ndarray, stride: int) -> np.ndarray:
        """The label of ``stride`` letters from ``at`` on: a letter is its number, more are a hash beyond all letters."""
        begin = self.first[word] + at
        if stride == 1:
            return self.raw[begin].astype(np.int64)
        total = (self.sums[begin + stride] - self.sums[begin]) * self.back[at]
        return (mix(total + np.uint64(stride)) | np.uint64(1 << 20)).view(np.int64)


def label_of(rest: str) -> int:
    """The label of all letters of ``rest``, as :meth:`Spelled.labels` gives it."""
    return int(Spelled([rest], False).labels(np.zeros(1, np.int64), np.zeros(1, np.int64), len(rest))[0])


_EDGES = "node long, label long, child long"
_STARTS = "id long, backwards boolean, position int, node long, label long, rest string, deletes boolean"
_IDS = "id long, last long, word string, n long"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of both tries that a walk can meet, and those over many letters."""
    for batch in batches:
        for part in _small_runs(batch):
            for backwards in (False, True):
                spelled = Spelled(part.column("word").to_pylist(), backwards)
                for stride in (1, *STRIDES):
                    # no walk begins above the middle of the shortest word
                    low = LEAST_LENGTH // 2 if stride == 1 else stride
                    number = np.maximum((spelled.size - low) // stride, 0)
                    word, at = np.repeat(np.arange(len(number)), number), low + stride * _runs(number)
                    columns = (spelled.nodes(word, at).view(np.int64), spelled.labels(word, at, stride), spelled.nodes(word, at + stride).view(np.int64))
                    if len(at):
                        yield pa.record_batch([pa.array(x) for x in columns], names=["node", "label", "child"])


def _small_runs(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose words have about ``limit`` letters together, one row at least."""
    start = total = 0
    for k, word in enumerate(batch.column("word").to_pylist()):
        if total + len(word) > limit and k > start:
            yield batch.slice(start, k - start)
            start, total = k, 0
        total += len(word)
    if batch.num_rows > start:
        yield batch.slice(start)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words with the nodes at which they end in both tries; the first is the id of the word."""
    for batch in batches:
        for part in _small_runs(batch):
            words = part.column("word").to_pylist()
            ends = []
            for backwards in (False, True):
                spelled = Spelled(words, backwards)
                ends.append(pa.array(spelled.nodes(np.arange(len(words)), spelled.size).view(np.int64)))
            yield pa.record_batch([*ends, part.column("word"), part.column("n")], names=["id", "last", "word", "n"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before their edit: every word at every place from its middle on, in both directions.

    A letter deleted from a run of equal letters is the last of the run.
    """
    for batch in batches:
        for part in _small_runs(batch, 1 << 14):
            words = part.column("word").to_pylist()
            own = None
            for backwards in (False, True):
                spelled = Spelled(words, backwards)
                own = spelled.nodes(np.arange(len(words)), spelled.size).view(np.int64) if own is None else own
                middle = spelled.size // 2
                word = np.repeat(np.arange(len(words)), spelled.size - middle)
                at = middle[word] + _runs(spelled.size - middle)
                letter = spelled.labels(word, at, 1)
                last = at == spelled.size[word] - 1
                after = np.where(last, -1, spelled.raw[np.minimum(spelled.first[word] + at + 1, len(spelled.raw) - 1)])
                deletes = (after != letter) & (spelled.size[word] > LEAST_LENGTH)
                rests = [spelled.words[w][p + 1 :] if len(words[w]) <= CARRIED else None for w, p in zip(word.tolist(), at.tolist(), strict=True)]
                columns = [own[word], np.full(len(word), backwards), at.astype(np.int32), spelled.nodes(word, at).view(np.int64), letter]
                yield pa.record_batch([*map(pa.array, columns), pa.array(rests, pa.string()), pa.array(deletes)], names=[c.split()[0] for c in _STARTS.split(", ")])


def _next(rest: Column, depth: Column) -> Column:
    """How many letters the next edge takes."""
    out = F.when(rest == "", 0)
    for stride in STRIDES:
        out = out.when((depth % stride == 0) & (F.char_length(rest) >= stride), stride)
    return out.otherwise(1).cast("int")


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The label of the next edge of each state, and what is left after it."""
    for batch in batches:
        rest, stride = batch.column("rest").to_pylist(), batch.column("stride").to_pylist()
        label = [ord(r[0]) if s == 1 else label_of(r[:s]) for r, s in zip(rest, stride, strict=True)]
        columns = [batch.column("id"), batch.column("node"), batch.column("depth"), pa.array([r[s:] for r, s in zip(rest, stride, strict=True)], pa.string()), batch.column("stride"), pa.array(label, pa.int64())]
        yield pa.record_batch(columns, names=["id", "node", "depth", "rest", "stride", "label"])


def _edited(words: DataFrame, edges: DataFrame) -> DataFrame:
    """The states (id, node, depth, rest) after their one edit."""
    starts = words.select("word").mapInArrow(_starts, _STARTS)
    letters = edges.where(F.col("label") < 256).withColumnsRenamed({"node": "from", "label": "letter"})
    met = starts.join(letters, (F.col("node") == F.col("from")) & (F.col("label") != F.col("letter")))
    replaced = met.select("id", "backwards", "position", F.col("child").alias("node"), (F.col("position") + 1).alias("depth"), "rest")
    deleted = starts.where("deletes").select("id", "backwards", "position", "node", F.col("position").alias("depth"), "rest")
    states = replaced.unionByName(deleted)
    # words too long to carry their rest from every place
    long = words.where(F.char_length("word") > CARRIED).select("id", F.col("word").alias("whole"))
    states = states.join(long, "id", "left")
    spelled = F.when(F.col("backwards"), F.reverse("whole")).otherwise(F.col("whole"))
    looked_up = spelled.substr(F.col("position") + 2, F.char_length("whole"))
    return states.select("id", "node", "depth", F.coalesce("rest", looked_up).alias("rest"))


def neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, n, near, near_n) of words (word, n) that differ by one letter more, less or other; both ways round."""
    spark = words.sparkSession
    words, kept = saved(words.mapInArrow(_ids, _IDS), "vocabulary")
    edges, at = saved(words.select("word").mapInArrow(_edges, _EDGES).distinct(), "edges")
    release(spark)
    folders, ended = [at], []
    states = _edited(words, edges)
    while True:
        states, folder = saved(states.withColumn("stride", _next(F.col("rest"), F.col("depth"))), "frontier")
        release(spark)
        folders.append(folder)
        ended.append(states.where("stride = 0").select("id", "node"))
        going = states.where("stride > 0")
        if going.limit(1).count() == 0:
            break
        # a letter needs no Python
        single = going.where("stride = 1").withColumn("label", F.ascii("rest").cast("long")).withColumn("rest", F.expr("substring(rest, 2)"))
        many = going.where("stride > 1").mapInArrow(_labelled, "id long, node long, depth int, rest string, stride int, label long")
        taken = single.unionByName(many).join(edges, ["node", "label"])
        states = taken.select("id", F.col("child").alias("node"), (F.col("depth") + F.col("stride")).cast("int").alias("depth"), "rest")
    arrived = ended[0]
    for more in ended[1:]:
        arrived = arrived.unionByName(more)
    ends = words.select(F.col("id").alias("node"), F.col("id").alias("near_id")).unionByName(words.select(F.col("last").alias("node"), F.col("id").alias("near_id")))
    found = arrived.join(ends, "node").where("id <> near_id").select("id", "near_id").distinct()
    # each pair the other way round as well: a letter less here is a letter more there
    found = found.unionByName(found.select(F.col("near_id").alias("id"), F.col("id").alias("near_id"))).distinct()
    own = words.select("id", "word", "n")
    other = words.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = found.join(own, "id").join(other, "near_id").where(F.levenshtein("word", "near", 1) == 1)
    out, _ = saved(pairs.select("word", "n", "near", "near_n"), "neighbours")
    drop_folders(spark, kept, *folders)
    return out


def spelling_variants(df: DataFrame) -> DataFrame:
    """The words of all whole texts (doc_id, text), their forms and the roots that forms lead to.

    Words are those of :func:`word_counts` with at least 5 letters that occur at least 3 times (n). A
    word's near words differ from it by one letter more, less or other. Its form is the near word with
    the largest number (ties: the first in code-point order) if that is twice its own at least. Returns
    word, n, n_near, form, form_n and root: the last word that forms lead to, the word itself if none.

    A null or empty text has no words; a missing doc_id counts as empty text in the hash; rows with
    equal doc_id are counted each. An empty table gives no rows. Further columns are ignored. Words of
    any length are compared whole.
    """
    spark = df.sparkSession
    words, _ = saved(word_counts(df), "words")
    pairs = neighbours(words)
    # numbers are smallest where they are largest, so that ties go to the first word
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"), F.first("n").alias("own"))
    clear = -F.col("best.less") >= 2 * F.col("own")
    best, _ = saved(best.select("word", "n_near", F.when(clear, F.col("best.near")).alias("form"), F.when(clear, -F.col("best.less")).alias("form_n")), "forms")
    # numbers double along a chain, so it ends; each round doubles how far a root looks
    roots, folder = saved(best.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        looked = roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        after, fresh = saved(looked, "roots")
        drop_folders(spark, folder)
        roots, folder = after.select("word", "root"), fresh
        if after.where("moved").limit(1).count() == 0:
            break
    found = words.join(best, "word", "left").join(roots, "word", "left")
    return found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
