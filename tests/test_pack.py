"""Packing against brute force; payload cleaning (FIXTURES F8); skew-safe ranking."""

import hashlib
import random

from pyspark.sql import functions as F

from tsline.functions.text import clean_payload
from tsline.operators.pack import pack_by_count, pack_by_interval, payloads
from tsline.operators.rank import rank_within


def _fixture(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", "c", None])
        t = rnd.randint(0, 50)                  # many equal times: ties broken by the line
        rows.append((key, t, f"m,k={key} v={i}i {t}"))
    return rows, spark.createDataFrame(rows, "key string, time_ns long, line string")


def _brute(rows, size, bucket=None):
    groups = {}
    for key, t, line in rows:
        b = (t // bucket) * bucket if bucket else None
        groups.setdefault((key, b), []).append((t, line))
    out = {}
    for (key, b), items in groups.items():
        items.sort()
        for start in range(0, len(items), size):
            chunk = [x[1] for x in items[start:start + size]]
            out[(key, b, start // size)] = (len(chunk), hashlib.md5("\n".join(chunk).encode()).hexdigest())
    return out


def test_pack_by_count_matches_brute_force(spark):
    rows, df = _fixture(spark)
    got = pack_by_count(df, 97, keys=["key"], num_partitions=6).collect()
    have = {(r["key"], None, r["batch_id"]): (r["n_lines"], hashlib.md5(r["body"].encode()).hexdigest())
            for r in got}
    assert have == _brute(rows, 97)
    assert max(r["n_lines"] for r in got) <= 97


def test_pack_by_interval_matches_brute_force(spark):
    rows, df = _fixture(spark, seed=11)
    got = pack_by_interval(df, 10, 40, keys=["key"], num_partitions=5).collect()
    have = {(r["key"], r["bucket_ns"], r["batch_id"]):
            (r["n_lines"], hashlib.md5(r["body"].encode()).hexdigest()) for r in got}
    assert have == _brute(rows, 40, bucket=10)


def test_packing_with_many_cuts(spark):
    """Partitions and file splits that cut payloads and keys anywhere, no keys, odd keys, extra columns."""
    rows, df = _fixture(spark, n=4000, seed=5)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for split, parts, size in (("4k", 3, 61), ("128m", 40, 500), ("1m", 17, 1), ("4k", 9, 100_000)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            got = pack_by_count(df, size, keys=["key"], num_partitions=parts).collect()
            have = {(r["key"], None, r["batch_id"]): (r["n_lines"], hashlib.md5(r["body"].encode()).hexdigest())
                    for r in got}
            assert len(have) == len(got) and have == _brute(rows, size)
            assert all(r["n_bytes"] == len(r["body"].encode()) for r in got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep[0])
        spark.conf.set("spark.sql.files.openCostInBytes", keep[1])
    single = [(None, t, line) for _, t, line in rows]
    got = pack_by_count(df, 333, num_partitions=5).collect()
    assert {(None, None, r["batch_id"]): (r["n_lines"], hashlib.md5(r["body"].encode()).hexdigest())
            for r in got} == _brute(single, 333)
    odd = df.selectExpr("time_ns", "line", "CASE time_ns % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN NULL WHEN 2 THEN 0.5D "
                        "ELSE -1D END AS x", "key = 'hot' AS body")
    got = pack_by_count(odd, 50, keys=["x"], num_partitions=6).collect()
    kind = {0: "nan", 1: "None", 2: "0.5", 3: "-1.0"}
    assert {(str(r["x"]), None, r["batch_id"]): (r["n_lines"], hashlib.md5(r["body"].encode()).hexdigest())
            for r in got} == _brute([(kind[t % 4], t, line) for _, t, line in rows], 50)
    assert pack_by_count(df.where("false"), 5, keys=["key"]).collect() == []


def test_lines_move_once(spark):
    """Bodies pass one exchange, the range partitioning; after it only pieces of payloads do."""
    _, df = _fixture(spark)
    packed = pack_by_count(df, 40, keys=["key"], num_partitions=6)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    moved = packed.select("key", "batch_id").groupBy("key", "batch_id").count()
    assert moved.where("count > 1").isEmpty()


def test_rank_without_broadcast_and_without_keys(spark):
    rows, df = _fixture(spark, n=500, seed=3)
    ranked = rank_within(df, ["key"], ["time_ns", "line"], num_partitions=4)
    got = sorted((r["key"] or "", r["_rank"], r["line"]) for r in ranked.collect())
    expect = []
    for key in {r[0] for r in rows}:
        items = sorted((t, line) for k, t, line in rows if k == key)
        expect += [(key or "", i, line) for i, (t, line) in enumerate(items)]
    assert got == sorted(expect)
    total = rank_within(df, [], ["time_ns", "line"], num_partitions=3)
    assert sorted(r["_rank"] for r in total.collect()) == list(range(500))


def test_payload_join_f8(spark):
    df = spark.createDataFrame([(1, 0, "a f=1"), (1, 1, ""), (1, 2, "b f=2"), (1, 3, None),
                                (2, 0, "  a f=1  "), (2, 1, "\tb f=2\n"),
                                (3, 0, ""), (3, 1, "   "), (3, 2, None)],
                               "g int, o int, line string")
    got = {r["g"]: r["body"] for r in payloads(df, ["g"], order="o").collect()}
    assert got == {1: "a f=1\nb f=2", 2: "a f=1\nb f=2"}


def test_clean_payload(spark):
    df = spark.createDataFrame([("  a f=1 \n\n \tb f=2\r\n",), (" \n ",)], "body string")
    assert [r[0] for r in df.select(clean_payload(F.col("body"))).collect()] == ["a f=1\nb f=2", None]


def test_hot_key_is_split_across_partitions(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), (F.col("id") * 7 % 20000).alias("t"))
    ranked = rank_within(df, ["k"], ["t"], num_partitions=8)
    spread = ranked.select("_pid").distinct().count()
    assert spread >= 4                       # one key, many tasks
    ranks = ranked.agg(F.min("_rank"), F.max("_rank"), F.countDistinct("_rank")).collect()[0]
    assert tuple(ranks) == (0, 19999, 20000)
    bad = ranked.where(F.col("_rank") != F.col("t")).count()   # t is a permutation of 0..19999
    assert bad == 0
