"""The compacted upsert log: merged runs, replays, ties, and what a reader opens."""

import random

import pytest

from tsline.operators.changelog import upsert_latest
from tsline.streaming.upserts import UpsertLog

COLS = "host string, time_ns long, seq long, v double, note string"


def batches(n, size, seed=1):
    rng = random.Random(seed)
    return [[(rng.choice(["a", "b", None]), rng.randint(0, 8), rng.randint(0, 20), rng.choice([1.0, 2.0, None]),
              rng.choice(["x", "y", None])) for _ in range(size)] for _ in range(n)]


def order(row):
    value = lambda x: (x is not None, x if x is not None else 0)
    return (row[2], value(row[3]), (row[4] is not None, row[4] or ""))


def latest(given):
    """Highest seq, then the later batch, then the greatest values."""
    out = {}
    for number, rows in enumerate(given):
        for row in rows:
            key = row[:2]
            best = (row[2], number, order(row))
            if key not in out or best > out[key][0]:
                out[key] = (best, row)
    return sorted((row for _, row in out.values()), key=repr)


def rows_of(view):
    return sorted((tuple(r[c] for c in ("host", "time_ns", "seq", "v", "note")) for r in view.collect()), key=repr)


@pytest.mark.parametrize("fan_in", [2, 3, 100])
def test_runs_are_merged_and_the_view_stays(spark, tmp_dir, fan_in):
    given = batches(9, 30)
    log = UpsertLog(spark, tmp_dir, ["host"], ["v", "note"], buckets=3, fan_in=fan_in)
    for number, rows in enumerate(given):
        log.add(spark.createDataFrame(rows, COLS), number)
        assert rows_of(log.view()) == latest(given[:number + 1])
        log.add(spark.createDataFrame(rows[:3], COLS), number)  # a replay changes nothing
    runs = log.runs()
    assert len(runs) == (9 if fan_in == 100 else {2: 2, 3: 1}[fan_in])
    log.compact()
    assert len(log.runs()) == 1 and rows_of(log.view()) == latest(given)
    # another reader follows the manifest; the files of merged runs are not read
    assert rows_of(UpsertLog(spark, tmp_dir, ["host"], ["v", "note"]).view()) == latest(given)
    files = {f.split("/runs/")[1].split("/")[0] for f in log._read(log.runs()).inputFiles()}
    assert files == {log.runs()[0]["run"]}


def test_a_run_that_failed_half_way_is_replaced(spark, tmp_dir):
    log = UpsertLog(spark, tmp_dir, ["host"], ["v", "note"])
    spark.createDataFrame([("junk", 1, 1, 1.0, "x")], COLS).write.parquet(f"{tmp_dir}/runs/l0-b0")
    log.add(spark.createDataFrame([("a", 1, 1, 1.0, "x")], COLS), 0)
    assert rows_of(log.view()) == [("a", 1, 1, 1.0, "x")]


def test_another_stream_is_an_error(spark, tmp_dir):
    log = UpsertLog(spark, tmp_dir, ["host"], ["v"])
    with pytest.raises(ValueError, match="nothing was written"):
        log.view()
    log.add(spark.createDataFrame([("a", 1, 1, 1.0, "x")], COLS), 0, "one")
    with pytest.raises(ValueError, match="belongs to the stream"):
        log.add(spark.createDataFrame([("a", 1, 2, 2.0, "x")], COLS), 0, "two")
    with pytest.raises(ValueError):
        UpsertLog(spark, tmp_dir, ["host"], ["v"], fan_in=1)


def test_ties_have_one_outcome(spark):
    rows = [("a", 1, 5, v, n) for v in (3.0, None, 7.0) for n in ("p", None, "q")] * 3
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, COLS).repartition(4)
        got = upsert_latest(df, ["host", "time_ns"], "seq", ["v", "note"]).collect()
        assert [(r["v"], r["note"], r["seq"]) for r in got] == [(7.0, "q", 5)]
        one = upsert_latest(df, ["host", "time_ns"], "seq", ["v"], total=True).collect()
        assert [(r["v"], r["seq"]) for r in one] == [(7.0, 5)]
