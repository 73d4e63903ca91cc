"""Decoding: exact round trips, corrupt lines, field types, typed read-back."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tsline.operators.decode import decode_lines
from tsline.operators.encode import encode_lines
from tsline.sources.lines import infer_layout, read_back, scan_points, write_lines

ALPHABET = [" ", ",", "=", '"', "\\", "\n", "\r", "\t", "a", "Z", "0", "é", "漢", "😀", "n", "r", "i"]


def _strings(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = rnd.randint(0, 12)
        out.append("".join(rnd.choice(ALPHABET) for _ in range(k)))
    return out


def test_round_trip_hostile_strings(spark):
    tags, texts = _strings(1, 400), _strings(2, 400)
    rows = [(i, t, s, f"k{i % 3}") for i, (t, s) in enumerate(zip(tags, texts))]
    df = spark.createDataFrame(rows, "id long, tagv string, text string, key string")
    lines = encode_lines(df, F.concat(F.lit("m e=a"), F.col("key")), tags=["tagv"],
                         fields=["text"], time="id", precision="ns", keep=["id", "tagv", "text"])
    dec = decode_lines(lines, keep=["id", "tagv", "text"])
    bad = dec.where(F.col("_corrupt").isNotNull()).count()
    assert bad == 0
    mism = dec.where((F.col("tags")["tagv"] != F.col("tagv"))
                     | (F.col("fields")["text"]["text"] != F.col("text"))
                     | (F.col("time_ns") != F.col("id"))
                     | ~F.col("measurement").startswith("m e=a")).count()
    assert mism == 0


def test_corrupt_lines_are_flagged(spark):
    bad = ["bad line", "m", "m f=", "m,t=1,t=2 f=1 5", "m f=1,f=2 5", 'm f="open 5', "",
           "m f=1 99999999999999999999"]
    good = ["m f=1 5", 'm,t=a\\ b s="x y",i=3i,b=true,fl=1.5 7', "m f=1"]
    df = spark.createDataFrame([(x,) for x in bad + good], "line string")
    out = {r["_corrupt"] for r in decode_lines(df).where("_corrupt is not null").collect()}
    assert out == set(bad)


def test_field_types_and_time(spark):
    df = spark.createDataFrame([('m,h=a i=-3i,f=2.5,b=T,c=false,s="q\\"uote",n=NaN 42',)], "line string")
    r = decode_lines(df).collect()[0]
    f = {k: (v["type"], v["text"]) for k, v in r["fields"].items()}
    assert f == {"i": ("i", "-3"), "f": ("f", "2.5"), "b": ("b", "true"), "c": ("b", "false"),
                 "s": ("s", 'q"uote'), "n": ("f", "NaN")}
    assert r["tags"] == {"h": "a"} and r["time_ns"] == 42 and r["measurement"] == "m"


def test_missing_time_decodes_as_null(spark):
    r = decode_lines(spark.createDataFrame([("m v=1",)], "line string")).collect()[0]
    assert r["_corrupt"] is None and r["time_ns"] is None


def test_read_back_documents(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    lines = encode_lines(docs, "documents", tags=["lang", "source"], fields=["text", "n_chars"],
                         time="doc_id", precision="ns")
    path = write_lines(lines, tmp_dir)
    pts = scan_points(spark, path)
    tag_keys, fields = infer_layout(pts)
    assert tag_keys == ["lang", "source"] and list(fields) == ["n_chars", "text"]
    back = read_back(spark, path).select(F.col("time_ns").alias("doc_id"), "lang", "source",
                                         "text", "n_chars")
    assert back.exceptAll(docs.select("doc_id", "lang", "source", "text", "n_chars")).count() == 0
    assert back.count() == docs.count()


def test_decode_columns_missing_keys_and_escapes(spark):
    from pyspark.sql import types as T
    from tsline.operators.decode import decode_columns
    df = spark.createDataFrame([('m,a\\ b=x\\,y f=1i,s="q\\"" 5',), ("m g=2.5 6",), ("broken",)],
                               "line string")
    rows = decode_columns(df, ["a b", "zz"], {"f": T.LongType(), "s": T.StringType(),
                                              "g": T.DoubleType()}).orderBy("time_ns").collect()
    assert [(r["a b"], r["zz"], r["f"], r["s"], r["g"], r["time_ns"]) for r in rows] == [
        ("x,y", None, 1, 'q"', None, 5), (None, None, None, None, 2.5, 6)]
