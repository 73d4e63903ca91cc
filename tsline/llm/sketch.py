"""Document fingerprints by a threshold-scaled sketch (native DataFrame operations only).

A text's sketch keeps every 64-bit shingle hash below a fixed fraction of the
hash range, so its size follows the text, sketches of parts merge by union, and
containment can be estimated between texts of very unequal length. A short text,
with fewer than ``LEAST`` hashes below the fraction, keeps its ``LEAST`` smallest
ones, all of them if it has no more; estimates then compare two sketches below
the lower of the bounds up to which they are complete.

Defined cases: a text of fewer words than a shingle has its whole word sequence
as one shingle; null counts as empty; only a text without words has an empty
sketch; two empty sketches have likeness 1, an empty and a filled one 0; the
likeness of equal texts is always 1; a containment that no kept hash can tell is
null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.llm.shared import GAP, fresh, require, write_scratch

SHINGLE = 5
FRACTION = 1 / 8
LEAST = 32
_TOP = (1 << 63) - 1


def words(text):
    """Lower-case words of a string column; no words for null, empty or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def shingle_hashes(words_col: str, k: int = SHINGLE):
    """Hashes of all k-word shingles of an array column (which must already be projected)."""
    w = F.col(words_col)
    starts = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
    return F.when(F.size(w) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def _bound(fraction: float) -> int:
    return min(-(1 << 63) + int(fraction * (1 << 64)), _TOP)


def keep_low(hashes, fraction: float = FRACTION, least: int = LEAST):
    """Sorted distinct hashes below ``fraction`` of the signed 64-bit range, or the ``least`` smallest if those are more."""
    low = F.array_distinct(F.filter(hashes, lambda h: h <= F.lit(_bound(fraction))))
    return F.when(F.size(low) >= least, F.sort_array(low)).otherwise(
        F.slice(F.sort_array(F.array_distinct(hashes)), 1, least))


def complete_to(sketch, fraction: float = FRACTION, least: int = LEAST):
    """The greatest hash up to which a sketch holds all hashes of its text."""
    return F.when(F.size(sketch) < least, F.lit(_TOP)).otherwise(
        F.greatest(F.lit(_bound(fraction)), F.get(sketch, F.lit(least - 1))))


def with_sketch(df: DataFrame, text: str, out: str, k: int = SHINGLE, fraction: float = FRACTION,
                least: int = LEAST) -> DataFrame:
    """``df`` with the sketch of ``text`` as ``out``: map-only, no shuffle."""
    cut, hashes = fresh(df, "cut", "hashes")
    return (df.withColumn(cut, words(F.col(text))).withColumn(hashes, shingle_hashes(cut, k))
            .withColumn(out, keep_low(F.col(hashes), fraction, least)).drop(cut, hashes))


def _both(a, b, fraction: float, least: int):
    top = F.least(complete_to(a, fraction, least), complete_to(b, fraction, least))
    return F.filter(a, lambda h: h <= top), F.filter(b, lambda h: h <= top)


def likeness(a, b, fraction: float = FRACTION, least: int = LEAST):
    """Estimated Jaccard similarity of the texts behind two sketches."""
    x, y = _both(a, b, fraction, least)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def containment(part, whole, fraction: float = FRACTION, least: int = LEAST):
    """Estimated share of the first text's shingles that the second has; an empty part counts as held."""
    x, y = _both(part, whole, fraction, least)
    return F.when(F.size(part) == 0, F.lit(1.0)).when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x))


def merged(sketches, fraction: float = FRACTION, least: int = LEAST):
    """Sketch of several texts together, from an array of their sketches."""
    return keep_low(F.flatten(sketches), fraction, least)


def as_string(sketch):
    """Fixed-width hexadecimal text of a sketch."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _previous(ids: DataFrame) -> DataFrame:
    """``ids(key, id, n, times)`` with the row before it in descending id order, in a ring.

    Rows are range-partitioned and numbered once (written, so a retry cannot
    renumber them); each partition needs only the last row of the one before,
    and that table has one row per partition.
    """
    laid = (ids.repartitionByRange(F.col("id").desc_nulls_last(), F.col("key"))
            .sortWithinPartitions(F.col("id").desc_nulls_last(), "key")
            .select("key", "n", "times", F.monotonically_increasing_id().alias("pos")))
    laid = write_scratch(laid, "sketch-order").withColumn("part", F.shiftright("pos", 33))
    inside = Window.partitionBy("part").orderBy("pos")
    ends = laid.groupBy("part").agg(F.max(F.struct("pos", "key", "n", "times")).alias("end"))
    ring = Window.orderBy("part")
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("end").over(ring),
                                          F.last("end").over(everything)).alias("end"))
    laid = laid.withColumn("before", F.lag(F.struct("key", "n", "times")).over(inside)).join(ends, "part")
    return laid.select("key", *[F.coalesce(F.col(f"before.{c}"), F.col(f"end.{c}")).alias(f"prev_{c}")
                                for c in ("key", "n", "times")])


def fingerprints(docs: DataFrame, k: int = SHINGLE, fraction: float = FRACTION, least: int = LEAST) -> DataFrame:
    """Sketches of every text, of its edited form, and of the next document, with likeness.

    The edited text has its last ``floor(n / 3)`` code points replaced by as
    many first ones of the next document in descending ``doc_id`` order (all of
    a shorter one; after the last comes the first; a single document follows
    itself). Null ids come last; rows of one id are documents of their own, in
    the order of their texts' digests; rows equal in id and text are one
    document, given as often as they come. Extra columns are not carried.
    Returns ``doc_id, n_chars, text, edited, sketch, edited_sketch, next_sketch``.

    One shuffle of texts and their sketches by document serves both sides of the
    join (the same exchange is reused); to the document before travel only as many
    code points as it needs, and the sketch.
    """
    require(docs, "doc_id", "text")
    full = F.coalesce("text", F.lit(""))
    texts = docs.select(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(full))
                        .alias("key"), "doc_id", full.alias("text"))
    ids = texts.groupBy("key").agg(F.first("doc_id").alias("id"), F.max(F.length("text")).alias("n"),
                                   F.count(F.lit(1)).alias("times"))
    before = write_scratch(_previous(ids), "sketch-ring")
    one = with_sketch(texts, "text", "sketch", k, fraction, least).groupBy("key").agg(
        F.first(F.struct("doc_id", "text", "sketch")).alias("d")).select("key", "d.*")
    sent = one.join(before, "key").select(
        F.col("prev_key").alias("key"), F.col("sketch").alias("next_sketch"), F.col("prev_times").alias("times"),
        F.expr("substring(text, 1, cast(floor(prev_n / 3) as int))").alias("next"))
    met = one.join(sent, "key").withColumn("n_chars", F.length("text").cast("long"))
    met = met.withColumn("edited", F.concat(
        F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 3) as int))"), F.col("next")))
    met = with_sketch(met, "edited", "edited_sketch", k, fraction, least)
    out = met.select("doc_id", "n_chars", "text", "edited", "sketch", "edited_sketch", "next_sketch", "times")
    return out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times")
