"""Line dedup by site-relative frequency (native DataFrame operations only).

For every host, the number of its pages that contain a line is divided by the
host's page total; lines above the ratio are boilerplate and are dropped from
that host's pages.

Defined cases: lines are compared without leading or trailing spaces, tabs and
carriage returns; blank lines are never counted nor dropped; a line repeated in
a page counts once for it and is dropped at each place; null text stays null
and empty text empty, both count as pages; null hosts form one host; a page may
lose all its lines and is then kept with an empty text; repeated rows are pages
of their own; a line exactly at the ratio stays; an empty table gives an empty
result. ``n_lines`` and ``n_dropped`` replace input columns of these names; all
other columns are kept, whatever their names.

The ratio is one page in a hundred, for lines on three pages or more: below it,
lines begin to be dropped that only copies of one document hold; the README has
the figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.llm.shared import fresh, require, write_scratch

RATIO = 0.01
MIN_PAGES = 3
_EDGE = " \t\r"


def _digest(line):
    return F.md5(F.btrim(line, F.lit(_EDGE)))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, digests)``: per host, the digests of the lines above the ratio.

    Counts are combined before the shuffle and keyed by host and line, so a hot
    host spreads over all tasks. A host has at most (mean lines a page) / ratio
    such lines, whatever its number of pages.
    """
    once = F.array_distinct(F.transform(F.split(F.col(text), "\n"), lambda x: F.btrim(x, F.lit(_EDGE))))
    lines = (pages.select(F.col(host).alias("host"), F.explode(once).alias("line"))
             .where("line <> ''").select("host", F.md5("line").alias("digest")))
    counts = (lines.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("pages"))
              .where(F.col("pages") >= min_pages))
    totals = pages.groupBy(F.col(host).alias("of")).agg(F.count(F.lit(1)).alias("total"))
    return (counts.join(totals, F.col("host").eqNullSafe(F.col("of")))
            .where(F.col("pages") / F.col("total") > ratio)
            .groupBy("host").agg(F.sort_array(F.collect_list("digest")).alias("digests")))


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text",
                     ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Pages with the cleaned ``text`` and ``n_lines``, ``n_dropped`` (lines before, lines dropped).

    The table of boilerplate is written first; Spark broadcasts it only where
    its written size is under the session's threshold.
    """
    require(pages, host, text)
    pages = pages.drop("n_lines", "n_dropped")
    found = write_scratch(boilerplate(pages, host, text, ratio, min_pages), "boilerplate")
    of, bad, lines, left = fresh(pages, "of", "bad", "lines", "left")
    found = found.select(F.col("host").alias(of), F.col("digests").alias(bad))
    kept = F.when(F.col(bad).isNull(), F.col(lines)).otherwise(
        F.filter(lines, lambda x: ~F.array_contains(F.col(bad), _digest(x))))
    return (pages.join(found, pages[host].eqNullSafe(found[of]), "left")
            .withColumn(lines, F.split(F.col(text), "\n")).withColumn(left, kept)
            .withColumn(text, F.array_join(left, "\n"))
            .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
            .withColumn("n_dropped", (F.col("n_lines") - F.coalesce(F.size(left), F.lit(0))).cast("long"))
            .drop(of, bad, lines, left))
