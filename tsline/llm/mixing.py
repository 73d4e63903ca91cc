"""Mixing sources to target weights (native DataFrame operations only).

Words are summed per source, a target per source is derived from weights, and
every document is emitted ``floor(rate)`` times plus one copy more with the
probability ``rate - floor(rate)``, drawn from a hash of its id and a seed, so
reruns and retried tasks agree.

Defined cases: null or empty text has size 0 and is emitted by its source's
rate like any other row; null sources form one source, ranked last; a source
without words has target 0 and rate 0; an empty table gives an empty result;
repeated rows are rows of their own and share their id's draw; ties do not
arise, since sources are distinct; columns of the input named like an output
column (``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``copy``)
are replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.llm.shared import fresh, require, word_count, write_scratch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2.0


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   ceiling: float = CEILING) -> DataFrame:
    """``sizes(source, source_size)`` with ``target`` and ``rate``.

    Weights repeat over the sources in code point order, null last. Resharing
    the excess of capped sources by weight until none is above its ceiling ends
    at one level L with ``target = min(ceiling * size, L * weight)``. L is found
    in one pass over the sources sorted by ``ceiling * size / weight``. The
    windows below see one row per source, never documents.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("_rank", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("_w", pick).withColumn("_cap", F.col("source_size") * F.lit(float(ceiling)))
        .withColumn("_ratio", F.col("_cap") / F.col("_w")))
    order = Window.orderBy("_ratio", "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_ratio", "_rank").rowsBetween(Window.unboundedPreceding,
                                                               Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share))
              - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
             / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
    leveled = ranked.withColumn("_level", level)
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"),
                         F.struct("_ratio", "_rank", "_level"))).over(everything)
    target = F.least(F.col("_cap"), F.coalesce(first["_level"] * F.col("_w"), F.col("_cap")))
    return (leveled.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .select("source", "source_size", "target", "rate"))


def draw(key, seed: str):
    """A number in [0, 1) from the first 32 bits of a digest of the key and the seed."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
             ceiling: float = CEILING, seed: str = "mix") -> DataFrame:
    """Every document with ``size, source_size, target, rate, copies``.

    The table of sources is written first; Spark broadcasts it only where its
    written size is under the session's broadcast threshold, else it joins by
    shuffle with adaptive skew splitting.
    """
    require(docs, "doc_id", "text", "source")
    own = ("size", "source_size", "target", "rate", "copies", "copy")
    docs = docs.drop(*own)
    sizes = docs.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    targets = write_scratch(source_targets(sizes, weights, share, ceiling), "mix-targets")
    of, = fresh(docs, "of")
    right = targets.withColumnRenamed("source", of)
    joined = docs.join(right, docs["source"].eqNullSafe(right[of])).drop(of)
    whole = F.floor("rate")
    copies = whole + F.when(draw(F.col("doc_id"), seed) < F.col("rate") - whole, 1).otherwise(0)
    return (joined.withColumn("size", word_count(F.col("text")))
            .withColumn("copies", copies.cast("long")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture: each document ``copies`` times, numbered by ``copy`` from 0."""
    planned = plan_mix(docs, **options).where("copies > 0")
    return planned.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.col("copies") - 1)))
