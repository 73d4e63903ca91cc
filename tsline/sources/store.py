"""A store of lines whose readers open only the files they need.

Lines are written as Parquet, range-partitioned and sorted by measurement, day, series
and time, in folders of one measurement and day. What Spark finds in each new file is
kept beside it, computed once when it is written:

* ``manifest/v...``: the live files of a version with measurement, lines and time range;
* ``pairs/...``: which tag pairs a file holds, sorted by pair, for lookups of one pair;
* ``keys/...``: which tag and field keys, with types, a file holds.

Readers take the newest manifest, drop files by measurement, time range and tag pair,
and read the rest with the exact filters. A delete rewrites only files that the time
range cuts, drops those inside it, and leaves all others where they are, with their
names; a new manifest is what makes an append or a delete visible. Files of older
versions stay for readers that still use them. One writer at a time.

Lines outside the grammar are kept, in files without measurement; they have no time
and no keys and are in no listing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.functions.fmt import STRING
from tsline.functions.timeunit import floor_div
from tsline.operators.decode import HEAD, decode_lines
from tsline.operators.explore import TYPE_NAMES, delete_by_time, filter_tag
from tsline.sources.manifest import Manifest

DAY_NS = 86_400_000_000_000
DATA = ("line string, measurement string, time_ns bigint, series string, tags map<string,string>, "
        "kinds map<string,string>")
MANIFEST = ("file string, measurement string, n_points bigint, n_without_time bigint, first_ns bigint, "
            "last_ns bigint, written string")


class LineStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._live = Manifest(spark, path, MANIFEST)
        self.versions, self.manifest, self._commit = self._live.versions, self._live.read, self._live.commit

    # -- writing -----------------------------------------------------------
    def append(self, lines: DataFrame, line_col: str = "line") -> int:
        """Add lines; returns the new version."""
        given = lines.select(F.col(line_col).alias("text"))
        points = decode_lines(given, line_col="text", keep=["text"])
        rows = points.select(
            F.col("text").alias("line"), "measurement", "time_ns",
            F.when(F.col("measurement").isNotNull(), F.regexp_extract("text", HEAD, 1)).alias("series"), "tags",
            F.transform_values("fields", lambda _, v: v["type"]).alias("kinds"))
        return self._commit(self.manifest().unionByName(self._write(rows)))

    def _write(self, rows: DataFrame) -> DataFrame:
        """Write rows of ``DATA`` as new files with what is known of them; their manifest rows."""
        written = uuid.uuid4().hex[:12]
        folder = f"{self.path}/data/{written}"
        sort = ["place", "day", "series", "time_ns"]
        (rows.withColumn("place", F.coalesce(F.md5("measurement"), F.lit("none")))
             .withColumn("day", F.coalesce(floor_div(F.col("time_ns"), DAY_NS), F.lit(-1)))
             .repartitionByRange(*sort).sortWithinPartitions(*sort)
             .write.mode("errorifexists").partitionBy("place", "day").parquet(folder))
        new = self.spark.read.schema(DATA).parquet(folder).withColumn(
            "file", F.regexp_extract(F.col("_metadata.file_path"), f"(data/{written}/.*)$", 1))
        good = new.where(F.col("measurement").isNotNull())
        pairs = good.select("file", F.explode("tags").alias("key", "value")).distinct()
        pairs.repartitionByRange("key", "value").sortWithinPartitions("key", "value").write.parquet(
            f"{self.path}/pairs/{written}")
        kinds = F.concat(
            F.transform(F.map_keys("tags"), lambda k: F.struct(F.lit("tag").alias("kind"), k.alias("key"),
                                                              F.lit(STRING).alias("type"))),
            F.transform(F.map_entries("kinds"), lambda e: F.struct(F.lit("field").alias("kind"), e["key"].alias("key"),
                                                                  e["value"].alias("type"))))
        good.select("file", "measurement", F.explode(kinds).alias("x")).select(
            "file", "measurement", "x.*").distinct().write.parquet(f"{self.path}/keys/{written}")
        return new.groupBy("file").agg(
            F.first("measurement").alias("measurement"), F.count(F.lit(1)).alias("n_points"),
            F.sum(F.col("time_ns").isNull().cast("bigint")).alias("n_without_time"),
            F.min("time_ns").alias("first_ns"), F.max("time_ns").alias("last_ns")).withColumn(
            "written", F.lit(written))

    def delete(self, after_ns: int | None = None, before_ns: int | None = None) -> int:
        """Remove the points of ``time > after AND time < before`` (C10); returns the new version.

        Points without a time stay. Without bounds nothing is deleted.
        """
        live = self.manifest()
        low = F.lit(True) if after_ns is None else F.col("last_ns") > after_ns
        high = F.lit(True) if before_ns is None else F.col("first_ns") < before_ns
        inside = ((F.lit(True) if after_ns is None else F.col("first_ns") > after_ns)
                  & (F.lit(True) if before_ns is None else F.col("last_ns") < before_ns)
                  & (F.col("n_without_time") == 0))
        none = after_ns is None and before_ns is None
        hit = F.lit(False) if none else F.coalesce(low & high & F.col("first_ns").isNotNull(), F.lit(False))
        state = live.withColumn("hit", hit).withColumn("inside", F.coalesce(inside, F.lit(False)))
        cut = self._paths(state.where("hit AND NOT inside"))
        rest = state.where("NOT hit").drop("hit", "inside")
        if cut:
            kept = delete_by_time(self.spark.read.schema(DATA).parquet(*cut), after_ns, before_ns, keep_corrupt=True)
            rest = rest.unionByName(self._write(kept))
        return self._commit(rest)

    # -- reading -----------------------------------------------------------
    def _paths(self, files: DataFrame) -> list[str]:
        """Paths for Spark to read: a name for each file, as Spark's own file index holds them."""
        return sorted(f"{self.path}/{r['file']}" for r in files.select("file").collect())

    def _beside(self, kind: str) -> DataFrame | None:
        writes = sorted(r["written"] for r in self.manifest().select("written").distinct().collect())
        return self.spark.read.parquet(*[f"{self.path}/{kind}/{w}" for w in writes]) if writes else None

    def files(self, measurement: str | None = None, after_ns: int | None = None, before_ns: int | None = None,
              tag: tuple[str, str] | None = None) -> list[str]:
        """Paths of the live files that may hold a wanted point."""
        live = self.manifest()
        if measurement is not None:
            live = live.where(F.col("measurement") == measurement)
        if after_ns is not None:
            live = live.where(F.col("last_ns") > after_ns)
        if before_ns is not None:
            live = live.where(F.col("first_ns") < before_ns)
        if tag is not None:
            pairs = self._beside("pairs")
            if pairs is None:
                return []
            live = live.join(pairs.where((F.col("key") == tag[0]) & (F.col("value") == tag[1])), "file", "left_semi")
        return self._paths(live)

    def lines(self, **wanted) -> DataFrame:
        """``(line, time_ns)`` of the files that :meth:`files` gives for the same arguments."""
        found = self.files(**wanted)
        if not found:
            return self.spark.createDataFrame([], "line string, time_ns bigint")
        return self.spark.read.schema("line string, time_ns bigint").parquet(*found)

    def points(self, measurement: str | None = None, after_ns: int | None = None, before_ns: int | None = None,
               tag: tuple[str, str] | None = None) -> DataFrame:
        """Decoded points, exactly those wanted; without arguments corrupt lines too."""
        lines = self.lines(measurement=measurement, after_ns=after_ns, before_ns=before_ns, tag=tag)
        for bound, keep in ((after_ns, F.col("time_ns") > F.lit(after_ns)), (before_ns, F.col("time_ns") < F.lit(before_ns))):
            if bound is not None:
                lines = lines.where(keep)
        points = decode_lines(lines.select("line"))
        if measurement is not None:
            points = points.where(F.col("measurement") == measurement)
        return filter_tag(points, *tag) if tag else points

    # -- listings ----------------------------------------------------------
    def keys(self) -> DataFrame:
        """``(measurement, kind, key, type)`` of all live points, from what was kept at each write."""
        kept = self._beside("keys")
        if kept is None:
            return self.spark.createDataFrame([], "measurement string, kind string, key string, type string")
        return kept.join(self.manifest().select("file"), "file", "left_semi").select(
            "measurement", "kind", "key", "type").distinct()

    def tag_keys(self) -> DataFrame:
        """As ``explore.tag_keys``, without a scan of the lines (E5)."""
        return self.keys().where("kind = 'tag'").select("measurement", F.col("key").alias("tag_key")).distinct()

    def field_keys(self) -> DataFrame:
        """As ``explore.field_keys``, without a scan of the lines."""
        return self.keys().where("kind = 'field'").select(
            "measurement", F.col("key").alias("field_key"), _type_name(F.col("type")).alias("field_type"))

    def count_points(self) -> DataFrame:
        """Points of each measurement, without a scan of the lines."""
        return self.manifest().where("measurement IS NOT NULL").groupBy("measurement").agg(
            F.sum("n_points").alias("n_points"))


def _type_name(letter: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in TYPE_NAMES.items() for x in kv])[letter]
