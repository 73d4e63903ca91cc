"""The pruned line store against a full scan: files opened, files kept by a delete, listings."""

import pytest
from pyspark.sql import functions as F

from tsline.operators import explore as X
from tsline.operators.decode import decode_lines
from tsline.sources.store import DAY_NS, LineStore

ODD = ["not a line", "m,a=b", "", r"we\ ird\,name,k\,1=v\=1,host=h1 f=1i 5", "m v=1"]


def some_lines(spark, n=3000):
    rows = spark.range(n).selectExpr(
        f"concat('m', id % 3, ',host=h', id % 40, if(id % 5 = 0, ',zone=z', ''), ' v=', id, 'i', "
        f"if(id % 2 = 0, ',t=\"x\"', ''), ' ', (id % 10) * {DAY_NS} + id) AS line")
    return rows.unionByName(spark.createDataFrame([(x,) for x in ODD], "line string"))


def rows_of(points):
    return sorted((r["measurement"] or "", r["time_ns"] or -1, r["_corrupt"] or "", str(sorted((r["tags"] or {}).items())))
                  for r in points.collect())


@pytest.fixture(scope="module")
def filled(spark):
    from tsline.session import scratch_path
    store = LineStore(spark, scratch_path(spark, "store"))
    lines = some_lines(spark).cache()
    store.append(lines.where("length(line) % 2 = 0"))
    store.append(lines.where("length(line) % 2 = 1"))
    return store, lines


def test_everything_comes_back(filled):
    store, lines = filled
    assert rows_of(store.points()) == rows_of(decode_lines(lines))
    assert store.versions()[:2] == [1, 2]
    assert sorted(r["line"] for r in store.lines().collect()) == sorted(r["line"] for r in lines.collect())


def test_filters_are_exact_and_open_few_files(filled):
    store, lines = filled
    every, points = decode_lines(lines), store.files()
    got = store.points(tag=("host", "h7"))
    assert rows_of(got) == rows_of(X.filter_tag(every, "host", "h7"))
    assert 0 < len(store.files(tag=("host", "h7"))) < 0.8 * len(points)
    span = dict(after_ns=3 * DAY_NS - 1, before_ns=4 * DAY_NS)
    inside = every.where((F.col("time_ns") > span["after_ns"]) & (F.col("time_ns") < span["before_ns"]))
    assert rows_of(store.points("m1", **span)) == rows_of(inside.where("measurement = 'm1'"))
    assert 0 < len(store.files("m1", **span)) < 0.15 * len(points)
    name = "we ird,name"
    assert rows_of(store.points(name)) == rows_of(every.where(F.col("measurement") == name))
    assert rows_of(store.points(tag=("k,1", "v=1"))) == rows_of(every.where(F.col("measurement") == name))
    assert len(store.files(tag=("k,1", "v=1"))) == 1
    assert store.files("none") == [] and store.points("none").collect() == []
    assert store.points(tag=("host", "h99")).collect() == []


def listing(df):
    return sorted(map(tuple, df.collect()))


def test_listings_equal_a_scan_after_appends_and_deletes(spark, filled, tmp_dir):
    store, lines = filled
    every = decode_lines(lines)
    assert listing(store.tag_keys()) == listing(X.tag_keys(every))
    assert listing(store.field_keys()) == listing(X.field_keys(every))
    assert listing(store.count_points()) == listing(X.count_points(every))
    other = LineStore(spark, tmp_dir)
    other.append(lines.where("line LIKE 'm0%' OR line LIKE 'm1%'"))
    other.append(spark.createDataFrame([("m9,x=1 q=1 7",), ("m9,x=2 q=1i 8",)], "line string"))
    assert ("m9", "field", "q", "f") in listing(other.keys()) and ("m9", "field", "q", "i") in listing(other.keys())
    other.delete(after_ns=7, before_ns=9)
    left = listing(other.keys())
    assert ("m9", "field", "q", "f") in left and ("m9", "field", "q", "i") not in left
    other.delete(after_ns=-1, before_ns=8)
    assert "m9" not in {r[0] for r in listing(other.keys())}
    assert listing(other.tag_keys()) == listing(X.tag_keys(other.points()))
    assert listing(other.field_keys()) == listing(X.field_keys(other.points()))


def test_a_delete_rewrites_only_files_it_cuts(spark, tmp_dir):
    store, lines = LineStore(spark, tmp_dir), some_lines(spark)
    store.append(lines)
    before = set(store.files())
    after_ns, before_ns = 2 * DAY_NS + 1000, 5 * DAY_NS + 1000
    store.delete(after_ns, before_ns)
    after = set(store.files())
    want = X.delete_by_time(decode_lines(lines), after_ns, before_ns, keep_corrupt=True)
    assert rows_of(store.points()) == rows_of(want)
    days = lambda files: {int(f.split("day=")[1].split("/")[0]) for f in files}
    assert {3, 4} <= days(before - after) and days(before - after) <= {2, 3, 4, 5}
    assert days(after - before) == {2, 5}  # cut files only
    assert {f for f in before if f.split("day=")[1][0] not in "2345"} <= after
    # readers of the old version still find their files
    assert store.manifest(1).count() == len(before)
    rows = spark.read.parquet(*sorted(before)).count()
    assert rows == lines.count()
    store.delete()
    assert set(store.files()) == after and len(store.versions()) == 3


def test_empty(spark, tmp_dir):
    store = LineStore(spark, tmp_dir)
    assert store.points().collect() == [] and store.keys().collect() == [] and store.files(tag=("a", "b")) == []
    store.append(spark.createDataFrame([], "line string"))
    store.delete(after_ns=0)
    assert store.points().collect() == [] and store.count_points().collect() == [] and store.keys().collect() == []
