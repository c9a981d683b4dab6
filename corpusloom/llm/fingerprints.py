"""Document fingerprints by one-permutation MinHash, with DataFrame functions alone.

The hashes of a text's shingles (five words) are made once. The top bits of a hash name its bin, and
each of the 128 bins keeps its smallest hash. An empty bin takes the value of another: it probes bins
in an order that only its own number decides until it meets a filled one (optimal densification), so
two texts fill it alike as far as they are alike. The low eight bits of each bin are the fingerprint.
Equal bins are counted and corrected for the 1 in 256 that agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import LARGE_JOIN, dense_positions, keyed, release, saved

BINS = 128
BIN_BITS = 7
KEPT_BITS = 8
PROBES = 8
SHINGLE = 5
_REST = 64 - BIN_BITS  # bits of a hash below its bin
_EMPTY = (1 << _REST) - 1


def _bin(value: Column) -> Column:
    return F.shiftright(value, _REST)


def with_bins(df: DataFrame, column: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint of a text column as an array of bytes; empty for a text without words."""
    # every step is a column of its own: an expression inside a lambda would be evaluated for each element
    words, shingles, sorted_, least = (f"__{out}_{x}" for x in ("words", "shingles", "sorted", "least"))
    parts = F.array_remove(F.split(F.lower(F.coalesce(column, F.lit(""))), "[\\x20\\x09-\\x0D]+"), "")
    df = df.withColumn(words, F.transform(parts, lambda w: F.xxhash64(w)))
    hashes, count = F.col(words), F.size(words)
    run = F.transform(F.sequence(F.lit(0), count - shingle), lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(shingle))))
    few = F.when(count > 0, F.array(F.xxhash64(hashes, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(shingles, F.when(count >= shingle, run).otherwise(few))
    # one value that stands for "empty" closes each bin, so every bin has a smallest value
    closing = F.array(*(F.lit(((j - BINS // 2 + 1) << _REST) - 1).cast("long") for j in range(BINS)))
    df = df.withColumn(sorted_, F.sort_array(F.concat(shingles, closing)))
    values = F.col(sorted_)
    df = df.withColumn(least, F.filter(values, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(values, i - 1)))))
    bins = F.col(least)

    def filled(k: Column) -> Column:
        value = F.get(bins, k)
        return F.when(value.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, value)

    def borrowed(j: Column) -> Column:
        probes = [filled(F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(PROBES)]
        start, step = F.pmod(F.xxhash64(j, F.lit(-1)), F.lit(BINS)), F.pmod(F.xxhash64(j, F.lit(-2)), F.lit(BINS // 2)) * 2 + 1
        # an odd step visits every bin
        order = F.filter(F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda t: filled(F.pmod(start + t * step, F.lit(BINS)).cast("int"))), lambda x: x.isNotNull())
        return F.coalesce(*probes, F.get(order, F.lit(0)))

    whole = F.transform(bins, lambda x, j: F.coalesce(F.when(x.bitwiseAND(F.lit(_EMPTY)) != _EMPTY, x), borrowed(j)))
    low = F.transform(whole, lambda x: x.bitwiseAND(F.lit((1 << KEPT_BITS) - 1)).cast("short"))
    df = df.withColumn(out, F.when(F.size(shingles) > 0, low).otherwise(F.array().cast("array<smallint>")))
    return df.drop(words, shingles, sorted_, least)


def packed(bins: Column) -> Column:
    """A fingerprint as a string of hexadecimal digits, two for each bin."""
    return F.array_join(F.transform(bins, lambda x: F.substring(F.hex(x.cast("long") + 256), 2, 2)), "")


def likeness(left: Column, right: Column) -> Column:
    """The estimated Jaccard similarity of two fingerprints, 0 to 1: 1 for two without words, 0 for one."""
    equal = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda x: x))
    chance = 1.0 / (1 << KEPT_BITS)
    estimate = F.greatest(F.lit(0.0), (equal / BINS - chance) / (1 - chance))
    both = (F.size(left) == 0).cast("int") + (F.size(right) == 0).cast("int")
    return F.when(both == 2, 1.0).when(both == 1, 0.0).otherwise(estimate)


def compare_with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of (doc_id, text), of edited texts, and how near they are.

    The edited text has its last quarter (of code points, rounded down) replaced by as many from the
    start of the next document in the order of doc_id, or all of that if it is shorter; the first
    document follows the last. Returns doc_id, n_chars, edited (the text), fingerprint,
    edited_fingerprint, near_edited and near_next, the likeness to the edited text's fingerprint and
    to the next document's.

    A null text is empty; a text without words has the empty fingerprint. Missing or repeated ids are
    ordered by (doc_id, text), null first. A single document is its own next. An empty table gives no
    rows. Further columns are ignored.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = keyed(rows, "text")
    own, _ = saved(with_bins(rows.withColumn("n_chars", F.char_length("text").cast("long")), "text", "bins").drop("text"), "fingerprints")
    total = own.count()
    placed = dense_positions(own.select("rid", "n_chars"), ["rid"])
    after = placed.select(F.col("rid").alias("next_rid"), F.pmod(F.col("position") - 1, F.lit(max(total, 1))).alias("position"))
    chain = placed.join(after, "position").select("rid", "next_rid", F.expr("int(n_chars div 4)").alias("need"))
    chain, _ = saved(chain, "chain")
    release(df.sparkSession)
    facts = chain.join(own, "rid").join(own.select(F.col("rid").alias("next_rid"), F.col("bins").alias("next_bins")), "next_rid")
    texts = rows.select("rid", "text")
    wanted = chain.select(F.col("rid").alias("for_rid"), F.col("next_rid").alias("rid"), "need")
    heads = texts.join(wanted.hint(LARGE_JOIN), "rid").select(F.col("for_rid").alias("rid"), F.expr("substring(text, 1, need)").alias("head"))
    joined = texts.join(facts.hint(LARGE_JOIN), "rid").join(heads.hint(LARGE_JOIN), "rid")
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - need))"), "head")
    joined = with_bins(joined.withColumn("edited", edited).drop("text", "head"), "edited", "edited_bins")
    return joined.select(
        "doc_id",
        "n_chars",
        "edited",
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )
