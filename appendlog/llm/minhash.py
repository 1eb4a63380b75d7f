"""One-permutation MinHash fingerprints, in DataFrame functions only.

The word shingles of a text are hashed once; the top bits of a hash name its
bin and each bin keeps its least hash.  Empty bins take the hash of a
non-empty one by optimal densification: bin b probes bins given by a hash of
(b, attempt) until it meets a non-empty one.  A fingerprint packs the low
``BITS`` bits of a hash of (kept hash, bin) of every bin (one hex digit each),
so a value that several bins borrow gives each of them a digit of its own and
chance agreement stays 1 in 2^``BITS`` for sets of a single shingle too;
likeness counts equal digits and corrects for that chance.

Shingles have five words (runs without ASCII white space); a shorter text is
one shingle.  Texts without words have the fingerprint ``""``: likeness 1 to
each other, 0 to all else.  Nulls count as empty.  Rows with equal keys are
ordered by text; texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appendlog.llm.common import bucket_of, let, range_bounds

BINS = 128
BITS = 4
WORDS = 5
#: Probes tried first, and at most, before the nearest non-empty bin is taken.
PROBES = (8, 1024)
BUCKET_BYTES = 8 << 20


def _hashes(w: Column, size: int) -> Column:
    """64-bit hashes of the shingles of a word array (one for a short array)."""
    n = F.size(w)
    runs = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, size)]))
    return F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.slice(runs, 1, F.greatest(n - (size - 1), F.lit(1))))


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - (BINS - 1).bit_length()).cast("int")


def _least(hashes: Column) -> Column:
    """bin -> its least hash, for the non-empty bins."""
    def first(z: Column) -> Column:
        return F.filter(z, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(z, i - 1))))

    return let(let(F.sort_array(hashes), first), lambda f: F.map_from_arrays(F.transform(f, _bin), f))


def _probe(dense: Column, b: Column, attempts: range) -> Column:
    tried = F.transform(F.sequence(F.lit(attempts[0]), F.lit(attempts[-1])), lambda t: F.get(dense, F.pmod(F.xxhash64(b, t), F.lit(BINS)).cast("int")))
    return F.get(F.filter(tried, lambda v: v.isNotNull()), 0)


def _nearest(dense: Column, b: Column) -> Column:
    turned = F.concat(F.slice(dense, b + 1, F.lit(BINS)), dense)
    return F.get(F.filter(turned, lambda v: v.isNotNull()), 0)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as column ``out``."""
    keep = [F.col(c) for c in df.columns if c != out]
    bins = F.sequence(F.lit(0), F.lit(BINS - 1))
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[ \t-\r]+"), "")
    df = df.select(*keep, words.alias("__w"))
    df = df.select(*keep, _hashes(F.col("__w"), WORDS).alias("__h"))
    df = df.select(*keep, _least(F.col("__h")).alias("__m"))
    df = df.select(*keep, F.when(F.size("__m") > 0, F.transform(bins, lambda b: F.try_element_at("__m", b))).alias("__d"))
    dense = F.col("__d")
    filled = F.transform(dense, lambda v, b: F.coalesce(
        v, _probe(dense, b, range(PROBES[0])), _probe(dense, b, range(*PROBES)), _nearest(dense, b)))
    low = F.lit((1 << BITS) - 1).cast("bigint")
    digits = F.array_join(F.transform(filled, lambda v, b: F.lower(F.hex(F.xxhash64(v, b).bitwiseAND(low)))), "")
    return df.select(*keep, F.coalesce(digits, F.lit("")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints (0 to 1)."""
    same = F.aggregate(F.sequence(F.lit(1), F.lit(BINS)), F.lit(0), lambda n, i: n + F.when(
        F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)), 1).otherwise(0))
    chance = 1.0 / (1 << BITS)
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance)))


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with the following row (ascending ``key``; the first after the
    last) as the struct ``next`` of ``key, text, fingerprint``.

    Rows fall into key ranges by bounds sampled from the keys; the first row of
    each range is dealt to the range before it too, so every range finds its
    rows' successors by itself and texts move in one shuffle.
    """
    bounds = range_bounds(df, key, text, BUCKET_BYTES)
    n, low = len(bounds) + 1, df.agg(F.min(key)).first()[0]
    home = bucket_of(F.col(key), bounds)
    starts = F.array(*[F.lit(b).cast("bigint") for b in [*bounds, low]])
    opens = F.array_contains(starts, F.col(key)) | (F.col(key).isNull() if low is None else F.lit(False))
    copies = F.when(opens, F.array(F.struct(home.alias("at"), F.lit(0).alias("copy")),
                                   F.struct(F.pmod(home - 1, F.lit(n)).alias("at"), F.lit(1).alias("copy"))))
    df = df.withColumn("__to", F.explode(F.coalesce(copies, F.array(F.struct(home.alias("at"), F.lit(0).alias("copy"))))))
    # twice as many partitions as buckets: few meet in one task
    df = df.repartition(2 * n, "__to.at") if n > 1 else df
    order = Window.partitionBy("__to.at").orderBy("__to.copy", key, text)
    own = F.struct(F.col(key).alias("key"), F.col(text).alias("text"), F.col("fingerprint"))
    return df.withColumn("next", F.lead(own).over(order)).where("__to.copy = 0").drop("__to")


def compare_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (its last half replaced by
    the next document's beginning) and their likenesses."""
    rows = df.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(with_fingerprint(rows, "text", "fingerprint"), "doc_id", "text")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "fingerprint",
                       F.col("next.fingerprint").alias("next_fingerprint"),
                       F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                                F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"))
    rows = with_fingerprint(rows.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
