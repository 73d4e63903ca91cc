"""Exact dedup by stateful streaming (native DataFrame operations only).

Documents arrive as a stream. A keyed state on disk, without expiry, holds per
digest of the normalised text the stable identifier that stays (the largest
``doc_id``), a locator of its content (file and row) and the number of rows
seen. The state lives in the stream's checkpoint, so a restart continues it.
Hits, digests seen more than once, are then checked on their full bytes: all rows
of a hit are compared in bulk, by digest, since fetching single rows by locator
would move the same texts once more. The locator leads other readers to the
content that stays, without a search for it.

Defined cases: texts are equal when identical after lower-casing A-Z only; null
counts as empty, and all empty texts are one group; a null ``doc_id`` stays only
where the whole group has none; rows that repeat the kept id are each marked
kept; an empty stream gives an empty state and result; extra columns are not
carried.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.llm.shared import require, write_scratch
from tsline.session import scratch_path

#: Settings of the stream's session: state in RocksDB, without disk reserved ahead for each of many small stores.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _digest(text, digits: int):
    return F.substring(F.sha2(text, 256), 1, digits)


def state_session(spark: SparkSession) -> SparkSession:
    """A session of its own for the stream, with the settings of ``spark`` and those of the state.

    Other queries of ``spark`` keep their settings while the stream runs. Settings
    of the state store are not among those that ``isModifiable`` knows, so what
    differs is set.
    """
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **_STATE}.items():
        if own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def run_state(stream: DataFrame, checkpoint: str, digits: int = 64) -> None:
    """Feed all that ``stream(doc_id, text, locator)`` has so far into the state, then stop.

    ``digits`` is the number of hexadecimal digits of the digest that are kept.
    Rows are combined before the shuffle, so a text that a third of all rows
    share reaches the state as one row per task. The state is kept as the
    stream's session says, see :func:`state_session`.
    """
    require(stream, "doc_id", "text", "locator")
    keyed = stream.select(_digest(normalised(F.col("text")), digits).alias("digest"),
                          "doc_id", "locator")
    state = keyed.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.max_by("locator", F.coalesce("doc_id", F.lit(-(1 << 63)))),
        F.count(F.lit(1)).alias("n"))
    query = (state.writeStream.format("noop").outputMode("update")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The keyed state as ``(digest, keep_id, locator, n)``, read from the checkpoint."""
    rows = spark.read.format("statestore").load(checkpoint)
    names = rows.schema["value"].dataType.names
    if len(names) != 4:
        raise ValueError(f"unexpected state columns {names}")
    return rows.select("key.digest", F.col(f"value.`{names[0]}`").alias("keep_id"),
                       F.col(f"value.`{names[1]}`").alias("locator"),
                       F.col(f"value.`{names[3]}`").alias("n"))


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as a stream with each row's locator (file and row number).

    The path is passed as a glob, since a file stream takes a folder or a glob
    but no single file by name.
    """
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    path = path.rstrip("/")
    return (spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")
            .select("doc_id", "text", F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.row_index").alias("row")).alias("locator")))


def resolve(docs: DataFrame, state: DataFrame, digits: int = 64) -> DataFrame:
    """Every row of ``docs`` with ``keep_id, group_size, kept, text_sha256, locator``.

    Groups of more than one row are checked on their full texts. Where one
    digest stands for different texts, its rows are grouped by the text itself.
    """
    require(docs, "doc_id", "text")
    lowered = docs.select("doc_id", normalised(F.col("text")).alias("_text"))
    rows = lowered.select("doc_id", "_text", _digest(F.col("_text"), digits).alias("digest"))
    state = write_scratch(state, "dedup-state")
    hits = write_scratch(state.where("n > 1").select("digest"), "dedup-hits")
    # one plan at every size: the hits grow with the corpus and are never broadcast
    seen = rows.join(hits.hint("merge"), "digest", "left_semi")
    differing = write_scratch(
        seen.groupBy("digest").agg(F.min("_text").alias("low"), F.max("_text").alias("high"))
        .where("low <> high").select("digest"), "dedup-differing")

    def result(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "keep_id", F.col("n").alias("group_size"),
                         F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                         F.col("sha").alias("text_sha256"), "locator")

    light = rows.select("doc_id", "digest", F.sha2("_text", 256).alias("sha"))
    if differing.isEmpty():
        return result(light.join(state, "digest"))
    rest = light.join(differing, "digest", "left_anti").join(state, "digest")
    clash = rows.join(differing, "digest", "left_semi")
    by_text = clash.groupBy("_text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    apart = clash.join(by_text, "_text").select(
        "doc_id", "keep_id", "n", F.sha2("_text", 256).alias("sha"),
        F.lit(None).cast(state.schema["locator"].dataType).alias("locator"))
    return result(rest).unionByName(result(apart))


def exact_dedup(spark: SparkSession, path: str, checkpoint: str | None = None,
                digits: int = 64) -> DataFrame:
    """Stream a Parquet table through the state and resolve every row of it."""
    checkpoint = checkpoint or scratch_path(spark, "dedup-stream")
    run_state(document_stream(state_session(spark), path), checkpoint, digits)
    return resolve(spark.read.parquet(path), read_state(spark, checkpoint), digits)
