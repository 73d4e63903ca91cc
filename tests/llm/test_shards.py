"""Hilbert shards: the curve itself, both laws, hostile rows, hot rows, pruning of written files."""

import glob
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from tsline.llm import queries, shards
from tsline.session import scratch_path

DIMS = ["source", "lang", "n_chars"]


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve(spark, dims, bits):
    """Every cell has one place, and neighbours on the curve are neighbours in the grid."""
    rows = sorted((r["place"], r["cell"]) for r in shards.curve(spark, dims, bits).collect())
    assert [p for p, _ in rows] == list(range(1 << dims * bits))
    assert sorted(c for _, c in rows) == list(range(1 << dims * bits))
    at = [[c >> bits * i & (1 << bits) - 1 for i in range(dims)] for _, c in rows]
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(at, at[1:]))


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = queries.op12_hilbert_shards(spark, SF_SMALL).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    held = Counter(r["shard"] for r in got)
    assert set(held) == set(range(24)) and max(held.values()) - min(held.values()) <= 1
    for shard, n in held.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))
    again = queries.op12_hilbert_shards(spark, SF_SMALL).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def sized(df):
    return F.coalesce(F.octet_length(df["text"]), F.lit(0)) + 8


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_hostile(spark, hostile, law):
    df = hostile.withColumns({c: F.lit("clash") for c in ("row", "place", "shard", "slot", "cell", "tie", "_rank", "_pid")})
    size = sized(df)
    got = shards.curve_shards(df, DIMS, 5, ["doc_id", "text"], law=law, size=size)
    assert got.columns == ["row", "place", "shard", "slot"]
    rows = got.select("row.*", F.col("shard").alias("_s")).drop("_s")
    assert rows.columns == df.columns
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, df.collect()))
    held = got.select("place", "shard", "slot", F.coalesce(F.octet_length("row.text"), F.lit(0)).alias("n")).collect()
    held = sorted((r["shard"], r["slot"], r["place"], r["n"] + 8) for r in held)
    assert [p for _, _, p, _ in held] == sorted(p for _, _, p, _ in held)
    total, before = sum(n for *_, n in held), 0
    for shard in {h[0] for h in held}:
        assert [s for k, s, _, _ in held if k == shard] == list(range(sum(k == shard for k, *_ in held)))
    if law == "rows":
        counts = Counter(h[0] for h in held)
        assert len(counts) == 5 and max(counts.values()) - min(counts.values()) <= 1
    for shard, _, _, n in held:
        if law == "bytes":
            assert shard == min(before * 5 // total, 4)
        before += n


def test_buckets_keep_order_and_hold_like_counts(spark):
    df = spark.range(1000).selectExpr("id", "concat('host-', lpad(id % 700, 4, '0')) AS source",
                                      "if(id % 10 = 0, cast('NaN' AS double), id * 1.5) AS x", "cast(null AS int) AS no")
    source, x, no = shards.quantised(df, ["source", "x", "no"], 3)
    rows = df.select("source", "x", source.alias("s"), x.alias("b"), no.alias("n")).collect()
    by_source = sorted((r["source"], r["s"]) for r in rows)
    assert [s for _, s in by_source] == sorted(s for _, s in by_source)
    assert max(Counter(r["s"] for r in rows).values()) <= 200
    assert {r["b"] for r in rows if r["x"] != r["x"]} == {7} and {r["n"] for r in rows} == {0}


def test_equal_rows_spread(spark):
    df = spark.range(3000).selectExpr("cast(null AS long) AS doc_id", "'a' AS source", "1 AS size").repartition(6)
    got = shards.curve_shards(df, ["source"], 7, ["doc_id"], law="bytes", size=F.col("size"))
    counts = Counter(r["shard"] for r in got.collect())
    assert len(counts) == 7 and max(counts.values()) - min(counts.values()) <= 1


def test_empty_and_errors(spark, empty):
    assert shards.curve_shards(empty, DIMS, 5, ["doc_id"]).collect() == []
    for bad in ({"law": "even"}, {"law": "bytes"}, {"bits": 9}, {"dims": ["source", "source"]}, {"shards": 0}):
        with pytest.raises(ValueError):
            shards.curve_shards(empty, **{"dims": DIMS, "shards": 5, "order": ["doc_id"], **bad})


def test_written_files_prune(spark):
    """A filter on any one of the columns opens fewer files than in a table cut by id."""
    df = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    path = scratch_path(spark, "shards")
    shards.write_shards(shards.curve_shards(df, DIMS, 16, ["doc_id"]), path, 16)
    by_id = scratch_path(spark, "by-id")
    df.repartitionByRange(16, "doc_id").write.parquet(by_id)
    assert sorted(map(repr, spark.read.parquet(path).select(df.columns).collect())) == sorted(map(repr, df.collect()))
    chars = sorted(r["n_chars"] for r in df.select("n_chars").collect())

    def open_files(folder, column, low, high):
        files = glob.glob(f"{folder}/**/*.parquet", recursive=True)
        ends = []
        for f in files:
            data = pq.ParquetFile(f).read([column])[column].to_pylist()
            ends.append((min(data), max(data)))
        return sum(a <= high and b >= low for a, b in ends) / len(files)

    for column, low, high in (("source", "src3", "src3"), ("n_chars", chars[200], chars[250]), ("lang", "fr", "fr")):
        assert open_files(path, column, low, high) < 0.7 * open_files(by_id, column, low, high), column
