"""Delivering lines through the ``lineproto`` sink, and reading what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tsline.operators.changelog import changelog_filter
from tsline.operators.points import encode
from tsline.session import ship_package
from tsline.sources.sink import NAME, RAW_OPTIONS, LineProtoDataSource, parse_options

WRITE_LOG_DDL = ("batch_name string, partition int, database string, retention_policy string, "
                 "n_lines bigint, n_bytes bigint, attempts int, latency_ms bigint, ok boolean, "
                 "error string, finished_at timestamp")


def register(spark: SparkSession) -> None:
    """Register the data source (idempotent) and ship the package to workers."""
    ship_package(spark)
    spark.dataSource.register(LineProtoDataSource)


ENCODE_OPTIONS = ("escape", "on_empty", "decimal_as", "non_finite", "empty_tag", "time_unit", "overflow")


def _named(spark: SparkSession, sink: str | None) -> dict:
    """Options of a named sink: the session's ``tsline.sink.<name>.<option>`` settings."""
    if sink is None:
        return {}
    prefix = f"tsline.sink.{sink}."
    found = {k[len(prefix):]: v for k, v in spark.conf.getAll.items() if k.startswith(prefix)}
    if not found:
        raise ValueError(f"no setting starts with {prefix!r}")
    return found


def prepare(rows: DataFrame, sink: str | None = None, **options) -> tuple[DataFrame, dict, int | None]:
    """(what goes to the sink, the sink's options, parallelism) for lines or raw rows.

    Raw rows are encoded here, in the JVM, by the encoder ``converter_type``
    names; role and encode options are then used up.  Options of a named sink
    come first, arguments override them.
    """
    given = {**_named(rows.sparkSession, sink),
             **{k.replace("_", "-"): v for k, v in options.items() if v is not None}}
    given = {("converter.type" if k == "converter-type" else "sink.parallelism" if k == "sink-parallelism"
              else k): v for k, v in given.items()}
    encode_with = {k: given.pop(k.replace("_", "-")) for k in ENCODE_OPTIONS if k.replace("_", "-") in given}
    if "line" in rows.columns:
        used = sorted(encode_with) + [k for k in (*RAW_OPTIONS, "measurement") if given.get(k)]
        if used or given.get("converter.type") == "point":
            raise ValueError(f"the rows are lines already: {used or 'converter.type'} would have no effect")
    opts = {k: str(v) for k, v in given.items()}
    parse_options(opts)                       # fail on the driver, before any task starts
    parallelism = opts.pop("sink.parallelism", None)
    if "line" in rows.columns:
        routing = [c for c in ("database", "retention_policy") if c in rows.columns]
        return rows.select("line", *routing), opts, int(parallelism) if parallelism else None
    if not opts.get("measurement"):
        raise ValueError("raw rows need the option 'measurement'")
    op = opts.pop("op-field", None)
    if op:
        rows = changelog_filter(rows, op).drop(op)
    lines = encode(rows, opts.pop("measurement"), opts.pop("tag-fields", None), opts.pop("field-fields", None),
                   opts.pop("timestamp-field", None), precision=opts.pop("source-precision", "ms"),
                   path=opts.pop("converter.type", "line-protocol"), **encode_with)
    return lines.select("line"), opts, int(parallelism) if parallelism else None


def send_lines(lines: DataFrame, path: str | None = None, database: str | None = None,
               parallelism: int | None = None, by: list[str] | None = None,
               sink: str | None = None, **options) -> dict:
    """Write a DataFrame with a ``line`` column through the sink (B1); a DataFrame of
    raw rows works too with role options (``measurement=``, ``tag_fields=``, ...).

    ``parallelism`` (B13, also the option ``sink.parallelism``) repartitions
    first (from SQL: a ``REPARTITION(n)`` hint in the ``SELECT``); without it
    adaptive execution sizes the tasks.  With ``by`` columns (e.g. series,
    time) the rows are range-partitioned and sorted on them: each task sends a
    contiguous, ordered run of a series, and a hot series is split over several
    tasks instead of landing in one.  Options use the sink's names with ``_``
    for ``-`` (batch_size=..., max_retries=...); ``sink`` names an option set
    of the session. With ``ledger``, a shared folder, a retried task sends only
    payloads that the transport has not acknowledged, and with ``ledger_name`` so
    does the same job run again.

    Returns the rows and UTF-8 bytes handed to the sink, observed while the
    write runs (no second pass over the data).
    """
    register(lines.sparkSession)
    rows = lines
    if by:
        if "line" not in rows.columns:
            raise ValueError("'by' orders rows that are lines already")
        order = [F.col(c) for c in by]
        ranged = (rows.repartitionByRange(parallelism, *order) if parallelism
                  else rows.repartitionByRange(*order))        # adaptive execution sizes it
        rows = ranged.sortWithinPartitions(*order, "line")
    out, opts, wanted = prepare(rows, sink, **{k: v for k, v in (("path", path), ("database", database))
                                               if v is not None}, **options)
    if not by and (parallelism or wanted):
        out = out.repartition(parallelism or wanted)
    if opts.get("ledger") and not by:
        # a retry cuts the same payloads only from the same order
        out = out.sortWithinPartitions(*out.columns)
    seen = Observation("tsline_send")
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"),
                      F.coalesce(F.sum(F.octet_length("line")), F.lit(0)).alias("bytes"))
    out.write.format(NAME).options(**opts).mode("append").save()
    return seen.get


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the payload files a directory transport wrote (with routing columns)."""
    return (spark.read.option("recursiveFileLookup", "false").text(path)
            .withColumnRenamed("value", "line").withColumnRenamed("rp", "retention_policy"))


def read_write_log(spark: SparkSession, path: str, all_attempts: bool = False) -> DataFrame:
    """WRITE_LOG rows, one per payload (B15): of committed attempts, or of every attempt.

    A retried task leaves a log of each attempt; the summary that a commit
    writes names the attempts that count.
    """
    root = path.rstrip("/")
    rows = spark.read.schema(WRITE_LOG_DDL).json(f"{root}/*.jsonl")
    if all_attempts:
        return rows
    counted = (spark.read.schema("state string, logs array<string>").json(f"{root}/_summary/*.json")
               .where("state = 'committed'").select(F.explode("logs").alias("_log")).distinct())
    return (rows.withColumn("_log", F.substring_index(F.col("_metadata.file_path"), "/", -1))
            .join(counted, "_log", "left_semi").drop("_log"))


def write_stats(log: DataFrame) -> DataFrame:
    """Totals and latency quantiles over a write log."""
    return log.agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.sum(F.when(F.col("ok"), F.col("n_lines"))).alias("n_lines"),
        F.sum(F.when(F.col("ok"), F.col("n_bytes"))).alias("n_bytes"),
        F.sum(F.col("attempts") - F.col("ok").cast("int")).alias("n_failed_attempts"),
        F.percentile_approx("latency_ms", [0.5, 0.95, 0.99]).alias("latency_ms_p50_p95_p99"),
        F.max(F.when(F.col("ok"), F.col("finished_at"))).alias("last_success"))


def lines_per_second(log: DataFrame) -> DataFrame:
    """Lines written per second of wall clock."""
    return (log.where("ok").groupBy(F.date_trunc("second", "finished_at").alias("second"))
               .agg(F.sum("n_lines").alias("lines_per_second")))
