"""Acknowledged payloads: a second attempt sends the rest, and only the rest."""

import glob
import json
import os
from collections import Counter

import pyarrow as pa
import pytest

from tsline.sources import ledger as L
from tsline.sources import sink as K
from tsline.sources.delivery import register, send_lines
from tsline.streaming import stream as ST

FLAKY = {"transport": "tsline.suite.flaky:transport", "batch_size": 10, "max_retries": 0}


def delivered(folder):
    found = Counter()
    for name in glob.glob(f"{folder}/database=*/rp=*/*.lp"):
        with open(name) as f:
            found.update(f.read().splitlines())
    return found


def lines_df(spark, n=400, parts=3):
    return spark.range(n).selectExpr("concat('m v=', id, 'i') AS line").repartition(parts)


def test_job_run_again_sends_the_rest(spark, tmp_dir):
    out, ledger, log = f"{tmp_dir}/out", f"{tmp_dir}/ledger", f"{tmp_dir}/log"
    lines = lines_df(spark)
    with pytest.raises(Exception, match="connection is gone"):
        send_lines(lines, out, "db", ledger=ledger, ledger_name="j", **FLAKY, **{"transport.die-after": 4})
    half = delivered(out)
    assert 0 < len(half) < 400 and set(half.values()) == {1}
    send_lines(lines, out, "db", ledger=ledger, ledger_name="j", write_log=log, **FLAKY)
    assert delivered(out) == Counter(f"m v={i}i" for i in range(400))
    with open(f"{log}/_summary/named-j.json") as f:
        summary = json.load(f)
    assert summary["acknowledged"] * 10 == len(half) and summary["sent_again"] == 0 and summary["lines"] == 400
    # once more: nothing is left to send
    send_lines(lines, out, "db", ledger=ledger, ledger_name="j", **FLAKY)
    assert set(delivered(out).values()) == {1}
    # without a ledger the same failure delivers lines twice
    plain = f"{tmp_dir}/plain"
    with pytest.raises(Exception, match="connection is gone"):
        send_lines(lines, plain, "db", **FLAKY, **{"transport.die-after": 4})
    send_lines(lines, plain, "db", **FLAKY)
    assert max(delivered(plain).values()) == 2


def test_replayed_micro_batch_sends_the_rest(spark, tmp_dir):
    src, out, ledger, ck = (f"{tmp_dir}/{x}" for x in ("src", "out", "ledger", "ck"))

    def run(**options):
        stream = spark.readStream.schema("line string").parquet(src)
        return ST.start_sink(stream, ck, path=out, database="db", ledger=ledger, **FLAKY, **options)

    lines_df(spark, 100, 2).write.parquet(src)
    with pytest.raises(Exception, match="connection is gone"):
        run(**{"transport.die-after": 2}).awaitTermination()
    half = delivered(out)
    assert 0 < len(half) < 100
    run().awaitTermination()
    assert delivered(out) == Counter(f"m v={i}i" for i in range(100))
    assert len(os.listdir(ledger)) == 1  # the last micro-batch may still be replayed
    spark.range(100, 150).selectExpr("concat('m v=', id, 'i') AS line").write.mode("append").parquet(src)
    run().awaitTermination()
    assert delivered(out) == Counter(f"m v={i}i" for i in range(150))
    assert [x.rpartition("-b")[2] for x in os.listdir(ledger)] == ["1"]


def test_an_unnamed_job_leaves_no_ledger(spark, tmp_dir):
    out, ledger = f"{tmp_dir}/out", f"{tmp_dir}/ledger"
    send_lines(lines_df(spark, 50), out, "db", ledger=ledger, **FLAKY)
    with pytest.raises(Exception, match="connection is gone"):
        send_lines(lines_df(spark, 50, 1), out, "db", ledger=ledger, **FLAKY, **{"transport.die-after": 1})
    assert os.listdir(ledger) == []


def test_task_attempts_share_a_ledger(tmp_dir):
    """The retry of a task passes over listed payloads; other content, or a cut line, is sent."""
    os.makedirs(tmp_dir)
    opts = K.parse_options({"database": "db", "path": f"{tmp_dir}/out", "ledger": f"{tmp_dir}/ledger",
                            "transport": "tsline.suite.flaky:transport", "batch-size": "2", "max-retries": "0",
                            "transport.die-after": "2"})
    dest = ("db", None)
    first = K.PayloadSender(opts, "job-x", 0, "7")
    with pytest.raises(RuntimeError, match="connection is gone"):
        first.add(dest, pa.array([f"m v={i}" for i in range(10)]))
    with open(f"{tmp_dir}/ledger/job-x/job-x-p00000-a7", "a") as f:
        f.write('{"seq": 2, "dig')  # died while writing
    opts.raw["transport.die-after"] = "-1"
    second = K.PayloadSender(opts, "job-x", 0, "8")
    second.add(dest, pa.array([f"m v={i}" for i in range(10)]))
    totals = second.close()
    assert (totals.acknowledged, totals.sent_again, totals.payloads, totals.lines) == (2, 0, 5, 10)
    assert delivered(f"{tmp_dir}/out") == Counter(f"m v={i}" for i in range(10))
    other = K.PayloadSender(opts, "job-x", 0, "9")
    other.add(dest, pa.array(["m v=99"] + [f"m v={i}" for i in range(1, 10)]))
    totals = other.close()
    assert (totals.acknowledged, totals.sent_again) == (4, 1)
    # another partition and another destination are other work
    assert not L.Ledger(f"{tmp_dir}/ledger", "job-x", "job-x-p00001", "1").known
    assert L.digest(("db", "a"), b"x") != L.digest(("db", "b"), b"x")


def test_options(spark, tmp_dir):
    register(spark)
    good = {"database": "d", "transport": "m:f", "ledger": "/x"}
    assert K.parse_options(good).ledger == "/x"
    for bad in ({"ledger": "s3://bucket/x"}, {"transport": "directory", "path": "/p"}, {"adaptive-batch": "true"},
                {"ledger-name": "a/b"}):
        with pytest.raises(ValueError):
            K.parse_options({**good, **bad})
    with pytest.raises(ValueError):
        K.parse_options({"database": "d", "transport": "m:f", "ledger-name": "a"})
