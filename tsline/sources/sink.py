"""The line sink: a Python data source named ``lineproto``.

Encoding normally stays in the JVM: the writer receives Arrow batches of the
``line`` column (plus optional ``database`` / ``retention_policy`` routing
columns).  Raw rows inserted from SQL with role options (``measurement``,
``tag-fields``, ...) are encoded per Arrow batch by ``arrow_encode``.  Each task:

* trims lines and drops null/blank ones with Arrow compute (B4),
* cuts them into payloads of ``batch-size`` lines per destination (B7, B12),
  the last partial payload at the end of the partition (B16),
* sends each payload through a transport with retries, exponential backoff
  and a per-attempt timeout (B9, B10), optionally adapting the batch size (B11),
* writes one WRITE_LOG row per payload to a JSON-lines file of its attempt (B15),
* with a ledger, passes over payloads that an earlier attempt delivered (``ledger``).

The directory transport appends payloads to one open file per task and
destination, under ``_staging``; the driver publishes the files of the
successful attempts when the job or micro-batch commits.  File names hold the
job, or the streaming query's id (the same for one checkpoint) and micro-batch,
and the partition: a replayed micro-batch replaces its own files and no other
query's.  A failed attempt leaves nothing that a reader sees.
"""

from __future__ import annotations

import importlib
import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as FutureTimeout
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter,
                                    DataSourceStreamArrowWriter, WriterCommitMessage)

from tsline.sources.ledger import Ledger, check_folder, digest, finished_epochs, forget

NAME = "lineproto"

# Option defaults.
DEFAULTS = {
    "batch-size": "5000",
    "max-retries": "3",
    "request-timeout": "30",        # seconds per attempt
    "retry-base-ms": "1000",        # wait min(base * 2^k, cap) before attempt k+1
    "retry-max-ms": "10000",
    "flush-interval": "100",        # ms; a streaming trigger interval, unused in batch
    "adaptive-batch": "false",
    "ignore-null-values": "true",   # accepted; null fields are always left out
    "transport": "directory",
    "converter.type": "line-protocol",
}
# Adaptive batch sizing.
ADAPT_EVERY = 10
ADAPT_FAST_MS = 300
ADAPT_SLOW_MS = 500
ADAPT_GROW = 1.2
ADAPT_SHRINK = 0.7
ADAPT_MAX_FACTOR = 4

#: Options the writer itself understands; a transport's own options start with ``transport.``.
KNOWN_OPTIONS = frozenset(DEFAULTS) | {
    "database", "retention-policy", "measurement", "path", "write-log", "tag-fields", "field-fields",
    "timestamp-field", "source-precision", "op-field", "on-empty", "escape", "sink.parallelism",
    "checkpointlocation", "ledger", "ledger-name"}
RAW_OPTIONS = ("tag-fields", "field-fields", "timestamp-field", "source-precision", "op-field",
               "on-empty", "escape")

# Java's String.trim() set: every char <= U+0020.
TRIM_CHARS = "".join(chr(i) for i in range(0, 33))


# ---------------------------------------------------------------------------
# options

@dataclass
class SinkOptions:
    database: str
    path: str | None
    retention_policy: str | None
    measurement: str | None
    batch_size: int
    max_retries: int
    timeout_s: float
    retry_base_ms: int
    retry_max_ms: int
    flush_interval_ms: int
    adaptive: bool
    transport: str
    write_log: str | None
    ledger: str | None = None
    ledger_name: str | None = None
    raw: dict = field(default_factory=dict)

    @property
    def attempts(self) -> int:
        return self.max_retries + 1


def _int(opts: dict, key: str, minimum: int) -> int:
    raw = opts.get(key, DEFAULTS.get(key))
    try:
        value = int(str(raw).strip())
    except ValueError:
        raise ValueError(f"option {key!r} must be an integer, got {raw!r}") from None
    if value < minimum:
        raise ValueError(f"option {key!r} must be >= {minimum}, got {value}")
    return value


def parse_options(options) -> SinkOptions:
    """Validate the option map (B14): required keys, defaults, ranges."""
    opts = {str(k).lower(): v for k, v in dict(options).items()}
    unknown = sorted(k for k in opts if k not in KNOWN_OPTIONS and not k.startswith("transport."))
    if unknown:
        raise ValueError(f"unknown options {unknown}; known ones are {sorted(KNOWN_OPTIONS)}")
    database = (opts.get("database") or "").strip()
    if not database:
        raise ValueError("option 'database' is required and must not be blank")
    measurement = opts.get("measurement")
    if measurement is not None and not measurement.strip():
        raise ValueError("option 'measurement' must not be blank")
    if measurement is None and any(opts.get(k) for k in RAW_OPTIONS):
        raise ValueError("option 'measurement' is required with role options")
    conv = (opts.get("converter.type") or DEFAULTS["converter.type"]).strip()
    if conv not in ("line-protocol", "line", "point"):
        raise ValueError(f"option 'converter.type' must be line-protocol or point, got {conv!r}")
    transport = (opts.get("transport") or DEFAULTS["transport"]).strip()
    path = opts.get("path")
    if transport == "directory" and not path:
        raise ValueError("option 'path' is required for the directory transport")
    adaptive = str(opts.get("adaptive-batch", "false")).strip().lower() == "true"
    ledger, ledger_name = opts.get("ledger") or None, opts.get("ledger-name") or None
    if ledger:
        check_folder(ledger)
        if transport == "directory":
            raise ValueError("the directory transport publishes at commit and needs no 'ledger'")
        if adaptive:
            raise ValueError("'ledger' needs payloads of a fixed size: not with 'adaptive-batch'")
    if ledger_name and (not ledger or "/" in ledger_name):
        raise ValueError("option 'ledger-name' goes with 'ledger' and holds no '/'")
    timeout = float(opts.get("request-timeout", DEFAULTS["request-timeout"]))
    if timeout <= 0:
        raise ValueError("option 'request-timeout' must be positive")
    return SinkOptions(
        database=database, path=path, retention_policy=opts.get("retention-policy") or None,
        measurement=measurement, batch_size=_int(opts, "batch-size", 1),
        max_retries=_int(opts, "max-retries", 0), timeout_s=timeout,
        retry_base_ms=_int(opts, "retry-base-ms", 0), retry_max_ms=_int(opts, "retry-max-ms", 0),
        flush_interval_ms=_int(opts, "flush-interval", 0),
        adaptive=adaptive, transport=transport, write_log=opts.get("write-log") or None,
        ledger=ledger, ledger_name=ledger_name, raw=opts)


def backoff_ms(retry: int, base_ms: int = 1000, cap_ms: int = 10000) -> int:
    """Wait before retry number ``retry`` (1, 2, 3 ...): min(base * 2^retry, cap)."""
    return min(base_ms * (2 ** retry), cap_ms)


def next_batch_size(size: int, initial: int, mean_latency_ms: float, errors: int) -> int:
    """Adaptive batch size after a window of flushes."""
    if errors == 0 and mean_latency_ms < ADAPT_FAST_MS:
        return min(int(size * ADAPT_GROW), initial * ADAPT_MAX_FACTOR)
    if errors > 0 or mean_latency_ms > ADAPT_SLOW_MS:
        return max(int(size * ADAPT_SHRINK), initial)
    return size


# ---------------------------------------------------------------------------
# transports: callables (database, retention_policy, body: bytes, name: str) -> None

def open_folder(path: str):
    """(file system, root) for a mounted path or a URI understood by ``pyarrow.fs``."""
    from pyarrow import fs as pafs
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def write_file(path: str, name: str, data: bytes) -> None:
    """Write ``data`` to ``<path>/<name>`` (temporary name, then move)."""
    fs, root = open_folder(path)
    folder = f"{root.rstrip('/')}/{os.path.dirname(name)}".rstrip("/")
    fs.create_dir(folder, recursive=True)
    final = f"{root.rstrip('/')}/{name}"
    tmp = f"{folder}/.{os.path.basename(name)}.{uuid.uuid4().hex[:8]}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, final)


class DirectoryTransport:
    """Appends payloads to one file per destination: ``database=<db>/rp=<rp>/<task>.lp``.

    ``path`` is a folder every executor can reach: a mounted file system or a
    URI that ``pyarrow.fs`` understands (``s3://``, ``gs://``, ``hdfs://``).
    Files are written under ``_staging`` and listed by ``finish()`` for the
    driver to publish.  A write that failed or timed out may have left part of
    a payload in the file, so the file is given up and the task fails; Spark's
    retry starts a new one.
    """

    appends = True

    def __init__(self, path: str, task: str, attempt: str = "0", marker: str | None = None):
        self.fs, root = open_folder(path)
        self.root = root.rstrip("/")
        self.task = task
        self.staging = f"{self.root}/_staging/{marker or 'alone'}/{task}-a{attempt}"
        self.files: dict[tuple, tuple] = {}
        self.broken: BaseException | None = None
        if marker and self.fs.get_file_info(f"{self.root}/_staging/{marker}/shared").type.name == "NotFound":
            raise RuntimeError(f"{path!r} is not the folder the driver sees: it must be shared by all "
                               "executors")

    def _file(self, database: str, rp: str | None):
        key = (database, rp or "autogen")
        if key not in self.files:
            name = f"database={key[0]}/rp={key[1]}/{self.task}.lp"
            staged = f"{self.staging}/{name}"
            self.fs.create_dir(os.path.dirname(staged), recursive=True)
            self.files[key] = (self.fs.open_output_stream(staged), staged, f"{self.root}/{name}")
        return self.files[key][0]

    def __call__(self, database: str, rp: str | None, body: bytes, name: str) -> None:
        if self.broken is not None:
            raise RuntimeError("the file of this task was given up") from self.broken
        try:
            out = self._file(database, rp)
            out.write(body)
            out.write(b"\n")
        except BaseException as exc:
            self.broken = exc
            raise

    def give_up(self, error: BaseException) -> None:
        self.broken = error

    def finish(self) -> list[tuple[str, str]]:
        for out, _, _ in self.files.values():
            out.close()
        return [(staged, final) for _, staged, final in self.files.values()]


def _marker(opts: SinkOptions) -> str | None:
    """A staging folder of this writer's own, with a file for executors to look for."""
    if opts.transport != "directory":
        return None
    name = f"writer-{uuid.uuid4().hex}"
    write_file(opts.path, f"_staging/{name}/shared", b"")
    return name


def _publish(opts: SinkOptions, messages) -> None:
    """Move the files of the successful attempts to their places."""
    moves = [move for m in messages if isinstance(m, Totals) for move in m.files]
    if not moves:
        return
    fs, _ = open_folder(opts.path)
    for folder in {os.path.dirname(final) for _, final in moves}:
        fs.create_dir(folder, recursive=True)
    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(lambda move: fs.move(*move), moves))


def _clear(opts: SinkOptions, marker: str | None, keep: bool = False) -> None:
    """Remove what this writer staged: failed attempts, empty folders and, unless it goes on, its folder."""
    if opts.transport != "directory" or marker is None:
        return
    from pyarrow import fs as pafs
    fs, root = open_folder(opts.path)
    folder = f"{root.rstrip('/')}/_staging/{marker}"
    for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
        if info.type == pafs.FileType.Directory:
            fs.delete_dir(info.path)
    if not keep and fs.get_file_info(folder).type == pafs.FileType.Directory:
        fs.delete_dir(folder)


def load_transport(opts: SinkOptions, task: str = "task", attempt: str = "0",
                   marker: str | None = None) -> Callable:
    if opts.transport == "directory":
        return DirectoryTransport(opts.path, task, attempt, marker)
    module, _, attr = opts.transport.partition(":")
    if not attr:
        raise ValueError("option 'transport' must be 'directory' or 'module:callable'")
    factory = getattr(importlib.import_module(module), attr)
    return factory({**opts.raw, "task": task, "attempt": attempt})


# ---------------------------------------------------------------------------
# Arrow helpers

def clean_array(arr: pa.Array) -> pa.Array:
    """Drop null lines, trim each (Java rule), drop empty ones."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.drop_null(arr)
    arr = pc.utf8_trim(arr, characters=TRIM_CHARS)
    return arr.filter(pc.not_equal(arr, ""))


def join_body(arr: pa.Array) -> bytes:
    """Lines -> one newline-separated body, straight from the Arrow buffers."""
    if len(arr) == 0:
        return b""
    with_nl = pc.binary_join_element_wise(arr, pa.scalar("", arr.type), "\n")
    _, offsets, data = with_nl.buffers()
    width = np.int64 if pa.types.is_large_string(with_nl.type) else np.int32
    offs = np.frombuffer(offsets, dtype=width, count=len(with_nl) + 1, offset=with_nl.offset
                         * np.dtype(width).itemsize)
    start, end = int(offs[0]), int(offs[-1]) - 1
    return data.to_pybytes()[start:end]


# ---------------------------------------------------------------------------
# the per-task sender

@dataclass
class Totals(WriterCommitMessage):
    partition: int
    payloads: int
    lines: int
    bytes: int
    attempts: int
    failed_attempts: int
    acknowledged: int = 0                          # payloads passed over: delivered before
    sent_again: int = 0                            # payloads that differ from what the ledger lists
    files: list = field(default_factory=list)      # (staged, final) of this attempt
    log: str | None = None                         # write-log file of this attempt
    prefix: str = ""


class PayloadSender:
    """Buffers cleaned lines per destination and sends full payloads."""

    def __init__(self, opts: SinkOptions, name_prefix: str, partition: int, attempt: str = "0",
                 marker: str | None = None):
        self.opts = opts
        self.task = f"{name_prefix}-p{partition:05d}"
        self.attempt = attempt
        self.transport = load_transport(opts, self.task, attempt, marker)
        self.prefix = name_prefix
        self.partition = partition
        self.size = opts.batch_size
        self.ledger = Ledger(opts.ledger, name_prefix, self.task, attempt) if opts.ledger else None
        self.buffers: dict[tuple, list[pa.Array]] = {}
        self.buffered: dict[tuple, int] = {}
        self.seq = 0
        self.log: list[dict] = []
        self.window: list[tuple[float, bool]] = []
        self.totals = Totals(partition, 0, 0, 0, 0, 0, prefix=name_prefix)
        self.pool = ThreadPoolExecutor(max_workers=1)

    # -- buffering ---------------------------------------------------------
    def add(self, dest: tuple, lines: pa.Array) -> None:
        if len(lines) == 0:
            return
        self.buffers.setdefault(dest, []).append(lines)
        self.buffered[dest] = self.buffered.get(dest, 0) + len(lines)
        while self.buffered[dest] >= self.size:
            self._flush(dest, self.size)

    def close(self) -> Totals:
        for dest in list(self.buffers):
            while self.buffered.get(dest, 0) > 0:
                self._flush(dest, min(self.size, self.buffered[dest]))
        self.pool.shutdown(wait=False, cancel_futures=True)
        if self.ledger:
            self.ledger.close()
        if hasattr(self.transport, "finish"):
            self.totals.files = self.transport.finish()
        self.totals.log = self.flush_log()
        return self.totals

    def _take(self, dest: tuple, n: int) -> pa.Array:
        merged = pa.concat_arrays(self.buffers[dest]) if len(self.buffers[dest]) > 1 \
            else self.buffers[dest][0]
        head, rest = merged.slice(0, n), merged.slice(n)
        self.buffers[dest] = [rest] if len(rest) else []
        self.buffered[dest] = len(rest)
        return head

    # -- sending -----------------------------------------------------------
    def _flush(self, dest: tuple, n: int) -> None:
        lines = self._take(dest, n)
        body = join_body(lines)
        name = f"{self.task}-s{self.seq:06d}"
        seq, self.seq = self.seq, self.seq + 1
        content = digest(dest, body) if self.ledger else ""
        if self.ledger and self.ledger.holds(seq, content):
            self.totals.acknowledged += 1
            self._count(lines, body)
            return
        if self.ledger and self.ledger.differs(seq, content):
            self.totals.sent_again += 1
        started = time.time()
        attempts, error = self._send(dest, body, name)
        latency_ms = int((time.time() - started) * 1000)
        ok = error is None
        self.log.append({"batch_name": name, "partition": self.partition, "database": dest[0],
                         "retention_policy": dest[1], "n_lines": len(lines),
                         "n_bytes": len(body), "attempts": attempts, "latency_ms": latency_ms,
                         "ok": ok, "error": None if ok else repr(error),
                         "finished_at": datetime.now(timezone.utc).isoformat()})
        self.totals.attempts += attempts
        self.totals.failed_attempts += attempts - (1 if ok else 0)
        if not ok:
            self.flush_log()
            raise RuntimeError(f"payload {name} failed after {attempts} attempts: {error!r}")
        if self.ledger:
            self.ledger.add(seq, content)
        self._count(lines, body)
        # only a flush that failed after all retries counts as an error, and that one raised
        self._adapt(latency_ms, False)

    def _count(self, lines: pa.Array, body: bytes) -> None:
        self.totals.payloads += 1
        self.totals.lines += len(lines)
        self.totals.bytes += len(body)

    def _send(self, dest: tuple, body: bytes, name: str):
        error = None
        for attempt in range(1, self.opts.attempts + 1):
            if attempt > 1:
                time.sleep(backoff_ms(attempt - 1, self.opts.retry_base_ms,
                                      self.opts.retry_max_ms) / 1000.0)
            future = self.pool.submit(self.transport, dest[0], dest[1], body, name)
            try:
                future.result(timeout=self.opts.timeout_s)
                return attempt, None
            except FutureTimeout:
                error = TimeoutError(f"no answer within {self.opts.timeout_s}s")
                # the stuck call keeps its thread; later attempts get a fresh one
                self.pool.shutdown(wait=False, cancel_futures=True)
                self.pool = ThreadPoolExecutor(max_workers=1)
                if getattr(self.transport, "appends", False):
                    # the stuck write may still reach the file: leave the file to the failed attempt
                    self.transport.give_up(error)
                    return attempt, error
            except Exception as exc:  # noqa: BLE001 - any transport failure is retried
                error = exc
                if getattr(self.transport, "broken", None) is not None:
                    return attempt, error
        return self.opts.attempts, error

    def _adapt(self, latency_ms: int, had_error: bool) -> None:
        if not self.opts.adaptive:
            return
        self.window.append((latency_ms, had_error))
        if len(self.window) >= ADAPT_EVERY:
            mean = sum(w[0] for w in self.window) / len(self.window)
            errors = sum(1 for w in self.window if w[1])
            self.size = next_batch_size(self.size, self.opts.batch_size, mean, errors)
            self.window.clear()

    def flush_log(self) -> str | None:
        """Write this attempt's log file; its name tells attempts of one task apart."""
        if not self.opts.write_log or not self.log:
            return None
        name = f"{self.task}-a{self.attempt}.jsonl"
        data = "".join(json.dumps(row) + "\n" for row in self.log).encode()
        write_file(self.opts.write_log, name, data)
        self.log.clear()
        return name


def _destinations(lines: pa.Array, db, rp, opts: SinkOptions):
    """Routed rows cut by destination: one dictionary encoding and one sort of the batch."""
    null = pa.scalar("\x00")
    text = lambda col: pc.fill_null(col.cast(pa.string()), null) if col is not None else null
    key = pc.binary_join_element_wise(text(db), text(rp), "\x01")
    if not isinstance(key, pa.Array):
        key = pa.array([key.as_py()] * len(lines))
    coded = key.dictionary_encode()
    codes = np.asarray(coded.indices)
    sorted_lines = lines.take(pa.array(np.argsort(codes, kind="stable")))
    ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
    start = 0
    for name, end in zip(coded.dictionary.to_pylist(), ends.tolist()):
        d, r = (None if part == "\x00" else part for part in name.split("\x01"))
        database = d if d is not None else opts.database
        if not database.strip():
            raise ValueError("blank database in routed rows")
        yield (database, r or opts.retention_policy), sorted_lines.slice(start, end - start)
        start = end


def _send_batches(opts: SinkOptions, prefix: str, batches: Iterator[pa.RecordBatch],
                  now_ns: int | None = None, marker: str | None = None) -> Totals:
    from pyspark import TaskContext
    ctx = TaskContext.get()
    partition = ctx.partitionId() if ctx else 0
    attempt = str(ctx.taskAttemptId()) if ctx else "0"
    sender = PayloadSender(opts, prefix, partition, attempt, marker)
    spec = None
    for rb in batches:
        names = rb.schema.names
        if "line" in names:
            lines = rb.column(names.index("line"))
        elif opts.measurement:
            # raw rows from SQL with role options: encode this Arrow batch here
            from tsline.sources.arrow_encode import encode_batch, spec_from_options
            spec = spec or spec_from_options(opts.raw, rb.schema, now_ns)
            lines = encode_batch(rb, spec)
        else:
            raise ValueError("the lineproto sink needs a 'line' column, or the option "
                             "'measurement' (with tag-fields / field-fields / timestamp-field)")
        db = rb.column(names.index("database")) if "database" in names else None
        rp = rb.column(names.index("retention_policy")) if "retention_policy" in names else None
        if db is None and rp is None:
            sender.add((opts.database, opts.retention_policy), clean_array(lines))
            continue
        for dest, own in _destinations(lines, db, rp, opts):
            sender.add(dest, clean_array(own))
    return sender.close()


# ---------------------------------------------------------------------------
# data source

def _writer_options(options, overwrite: bool) -> SinkOptions:
    if overwrite:
        raise ValueError("the lineproto sink only appends: use mode('append') or a new path")
    opts = parse_options(options)
    if opts.raw.get("sink.parallelism"):
        raise ValueError("'sink.parallelism' works in send_lines and start_sink; in SQL use a "
                         "REPARTITION hint")
    if (opts.raw.get("converter.type") or "").strip() == "point":
        raise ValueError("'converter.type'='point' works in send_lines and start_sink with raw rows, "
                         "and in create_line_view")
    return opts


class LineWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.opts = _writer_options(options, overwrite)
        self.job = uuid.uuid4().hex[:12]       # fixed on the driver: task retries reuse it
        self.name = f"named-{self.opts.ledger_name}" if self.opts.ledger_name else f"job-{self.job}"
        self.now_ns = time.time_ns() // 1000 * 1000   # 'now' of this job, for rows without time
        self.marker = _marker(self.opts)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Totals:
        return _send_batches(self.opts, self.name, iterator, self.now_ns, self.marker)

    def _end(self, messages, state: str) -> None:
        _write_summary(self.opts, self.name, messages, state)
        _clear(self.opts, self.marker)
        if self.opts.ledger and not self.opts.ledger_name:
            forget(self.opts.ledger, [self.name])      # no other job has this name

    def commit(self, messages) -> None:
        _publish(self.opts, messages)
        self._end(messages, "committed")

    def abort(self, messages) -> None:
        self._end(messages, "aborted")


class LineStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.opts = _writer_options(options, overwrite)
        self.now_ns = time.time_ns() // 1000 * 1000
        self.marker = _marker(self.opts)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Totals:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        query = ctx.getLocalProperty("sql.streaming.queryId") if ctx else None
        epoch = ctx.getLocalProperty("streaming.sql.batchId") if ctx else None
        if not query or epoch is None:
            # without them a replay would add files instead of replacing its own
            raise RuntimeError("the streaming query's id and micro-batch id are not known to the task")
        return _send_batches(self.opts, f"query-{query}-b{epoch}", iterator, self.now_ns, self.marker)

    def _name(self, messages, batch_id: int) -> str:
        """The tasks' common prefix (the query's id is known to tasks only)."""
        for m in messages:
            if isinstance(m, Totals) and m.prefix:
                return m.prefix
        return f"query-unknown-b{batch_id}"

    def commit(self, messages, batchId: int) -> None:
        _publish(self.opts, messages)
        name = self._name(messages, batchId)
        _write_summary(self.opts, name, messages, "committed")
        _clear(self.opts, self.marker, keep=True)
        if self.opts.ledger:
            # this micro-batch's ledger stays: it may still be replayed until the next one begins
            query = name.rpartition("-b")[0]
            forget(self.opts.ledger, finished_epochs(self.opts.ledger, query, batchId))

    def abort(self, messages, batchId: int) -> None:
        _write_summary(self.opts, self._name(messages, batchId), messages, "aborted")
        _clear(self.opts, self.marker)


def _write_summary(opts: SinkOptions, prefix: str, messages, state: str) -> None:
    if not opts.write_log:
        return
    done = [m for m in messages if isinstance(m, Totals)]
    summary = {"name": prefix, "state": state, "tasks": len(done),
               "payloads": sum(m.payloads for m in done), "lines": sum(m.lines for m in done),
               "bytes": sum(m.bytes for m in done), "attempts": sum(m.attempts for m in done),
               "failed_attempts": sum(m.failed_attempts for m in done),
               "acknowledged": sum(m.acknowledged for m in done),
               "sent_again": sum(m.sent_again for m in done),
               "logs": sorted(m.log for m in done if m.log)}
    write_file(opts.write_log, f"_summary/{prefix}.json", json.dumps(summary).encode())


class LineProtoDataSource(DataSource):
    """``df.write.format("lineproto")`` / ``writeStream.format("lineproto")``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "line string"      # what a table created without columns holds

    def writer(self, schema, overwrite: bool) -> LineWriter:
        return LineWriter(self.options, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> LineStreamWriter:
        return LineStreamWriter(self.options, overwrite)
