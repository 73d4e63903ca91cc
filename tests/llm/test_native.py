"""Mixing, exact dedup, line dedup and fingerprints on hostile rows, and their queries against DuckDB."""

import hashlib
import math
import random
import string
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm.helpers import words_of
from tsline.llm import exact_dedup, line_dedup, mixing, queries, sketch

ASCII = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF_SMALL)
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    key = lambda row: tuple(round(v, 6) if isinstance(v, float) else v for v in row)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(key, (tuple(r[c] for c in columns) for r in got.collect())), key=repr) == sorted(
        map(key, want.fetchall()), key=repr)


def test_native_plans_have_no_python(spark):
    for name in ("op6_mixing", "op7_exact_dedup", "op9_line_dedup", "op10_fingerprints",
                 "op12_hilbert_shards"):
        plan = queries.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def water_level(sizes, share=1.5, ceiling=2.0, weights=(5, 2, 1)):
    """Targets by resharing the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    caps = {s: ceiling * sizes[s] for s in names}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > caps[s]]
        if not over:
            return {**target, **{s: left * w[s] / total for s in open_}}
        for s in over:
            target[s] = caps[s]
        left -= sum(caps[s] for s in over)
        open_ -= set(over)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, "d": 70, None: 3}, {"a": 0, "b": 0}, {"x": 7},
                                   {chr(97 + i): 10 ** (i % 5) for i in range(12)}, {"a": 0, "b": 8, None: 0}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    want = water_level(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


def test_mix(hostile, empty):
    plan = mixing.plan_mix(hostile)
    assert set(plan.columns) == set(hostile.columns) | {"source_size", "rate"}
    rows = plan.collect()
    assert len(rows) == hostile.count()
    for r in rows:
        assert r["size"] == len(words_of(r["text"])) and 0 <= r["copies"] <= 2
        assert math.floor(r["rate"]) <= r["copies"] <= math.ceil(r["rate"])
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"], r["source"]].add(r["copies"])
    assert all(len(v) == 1 for v in by_id.values())
    mixed = mixing.mix(hostile)
    assert mixed.count() == sum(r["copies"] for r in rows)
    assert sorted(mixing.mix(hostile).select("doc_id", "copy").collect(), key=repr) == sorted(
        mixed.select("doc_id", "copy").collect(), key=repr)
    assert mixing.plan_mix(empty).collect() == [] and mixing.mix(empty).collect() == []


def test_mix_comes_near_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 9 AS int)) AS text",
                                          "concat('s', id % 4 * (id % 4)) AS source")
    rows = mixing.plan_mix(docs).groupBy("source").agg({"target": "max", "copies": "count"}).collect()
    taken = {r["source"]: r["t"] for r in mixing.mix(docs).groupBy("source").agg({"size": "sum"}).withColumnRenamed(
        "sum(size)", "t").collect()}
    for r in rows:
        assert abs(taken[r["source"]] - r["max(target)"]) <= 0.05 * r["max(target)"]


def grouped(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(ASCII)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize("digits", [64, 1])
def test_exact_dedup(spark, hostile, tmp_dir, digits):
    """One digit makes different texts collide: only the full bytes tell them apart."""
    hostile.coalesce(3).write.parquet(tmp_dir + "/docs")
    got = exact_dedup.exact_dedup(spark, tmp_dir + "/docs", digits=digits)
    rows = [(r["doc_id"], r["text"]) for r in hostile.select("doc_id", "text").collect()]
    assert sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256"))
                   for r in got.collect()), key=repr) == grouped(rows)


def test_state_goes_on_where_it_stopped(spark, hostile, empty, tmp_dir):
    path, checkpoint = tmp_dir + "/docs", tmp_dir + "/state"
    hostile.where("doc_id < 6").write.parquet(path)
    exact_dedup.run_state(exact_dedup.document_stream(exact_dedup.state_session(spark), path), checkpoint)
    first = exact_dedup.read_state(spark, checkpoint).agg({"n": "sum"}).first()[0]
    assert first == hostile.where("doc_id < 6").count()
    hostile.where("doc_id >= 6 OR doc_id IS NULL").write.mode("append").parquet(path)
    exact_dedup.run_state(exact_dedup.document_stream(exact_dedup.state_session(spark), path), checkpoint)
    state = exact_dedup.read_state(spark, checkpoint)
    assert state.agg({"n": "sum"}).first()[0] == hostile.count()
    rows = {(r["f"], r["n"]): r["text"] for r in spark.read.parquet(path).select(
        "text", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("n")).collect()}
    for r in state.collect():  # the locator leads to the content that stays
        text = (rows[r["locator"]["file"], r["locator"]["row"]] or "").translate(ASCII)
        assert hashlib.sha256(text.encode()).hexdigest() == r["digest"]
    empty.write.parquet(tmp_dir + "/none")
    assert exact_dedup.exact_dedup(spark, tmp_dir + "/none").collect() == []


def test_state_session_has_all_settings(spark):
    """The store's settings are unknown to ``isModifiable``; without them each small store reserves 4 MB of disk."""
    theirs = "spark.sql.streaming.stateStore.rocksdb.compactOnCommit"
    before = dict(spark.conf.getAll)
    spark.conf.set(theirs, "false")
    try:
        own = exact_dedup.state_session(spark)
        assert own.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"
        assert own.conf.get(theirs) == "false"
    finally:
        spark.conf.unset(theirs)
    assert spark.conf.getAll == before


def cleaned(rows, ratio, min_pages):
    pages, total = Counter(), Counter()
    for _, text, host in rows:
        total[host] += 1
        pages.update({(host, x.strip(" \t\r")) for x in (text or "").split("\n")})
    bad = {k for k, n in pages.items() if k[1] and n >= min_pages and n / total[k[0]] > ratio}
    out = []
    for doc_id, text, host in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if (host, x.strip(" \t\r")) not in bad]
        out.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("ratio,min_pages", [(0.1, 2), (0.3, 1), (0.1, 5), (0.0, 1), (0.01, 3)])
def test_line_dedup(hostile, empty, ratio, min_pages):
    got = line_dedup.drop_boilerplate(hostile, ratio=ratio, min_pages=min_pages)
    assert set(got.columns) == set(hostile.columns)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in hostile.collect()]
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()),
                  key=repr) == cleaned(rows, ratio, min_pages)
    assert line_dedup.drop_boilerplate(empty).collect() == []


def shingles_of(text, k=5):
    w = words_of((text or "").lower(), fold=False)
    out = set()
    for i in range(max(1, len(w) - k + 1) if w else 0):
        h = 42
        for word in w[i:i + k]:
            h = xxhash.xxh64_intdigest(word.encode(), seed=h)
        out.add(h - (1 << 64) if h >= 1 << 63 else h)
    return sorted(out)


def sketch_of(text, fraction=sketch.FRACTION, least=sketch.LEAST):
    every = shingles_of(text)
    low = [h for h in every if h <= -(1 << 63) + int(fraction * (1 << 64))]
    return low if len(low) >= least else every[:least]


def top_of(kept, fraction=sketch.FRACTION, least=sketch.LEAST):
    return (1 << 63) - 1 if len(kept) < least else max(-(1 << 63) + int(fraction * (1 << 64)), kept[least - 1])


def near(a, b):
    top = min(top_of(a), top_of(b))
    a, b = {h for h in a if h <= top}, {h for h in b if h <= top}
    return len(a & b) / len(a | b) if a | b else 1.0


def ring(rows):
    """Expected values, as often as each (id, text) comes."""
    times = Counter((i, t or "") for i, t in rows)
    key = lambda d: (d[0] is None, -(d[0] or 0), hashlib.md5(d[1].encode()).hexdigest())
    order = sorted(times, key=key)
    out = []
    for (here, text), (_, after) in zip(order, order[1:] + order[:1]):
        n = len(text)
        edited = text[:n - n // 3] + after[:n // 3]
        a, b, c = sketch_of(text), sketch_of(edited), sketch_of(after)
        out += [(here, n, edited, a, b, near(a, b), near(a, c))] * times[here, text]
    return sorted(out, key=repr)


def test_fingerprints(spark, hostile, empty, documents):
    for df in (hostile, hostile.where("doc_id = 9"), hostile.where("doc_id = 5"), documents.limit(60)):
        want = ring([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
        found = sketch.fingerprints(df)
        got = found.withColumn("e", sketch.likeness(found["sketch"], found["edited_sketch"])).withColumn(
            "x", sketch.likeness(found["sketch"], found["next_sketch"])).collect()
        names = ("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "e", "x")
        assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == want
    assert sketch.fingerprints(empty).collect() == []


def test_fingerprint_query(spark, documents):
    want = {r[0]: r[1:] for r in ring([(r["doc_id"], r["text"]) for r in documents.collect()])}
    text = lambda hashes: "".join(f"{h % (1 << 64):016x}" for h in hashes)
    for r in queries.op10_fingerprints(spark, SF_SMALL).collect():
        n, edited, a, b, e, x = want.pop(r["doc_id"])
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (text(a), text(b))
        assert math.isclose(r["near_edited"], e) and math.isclose(r["near_next"], x)
    assert not want


def test_likeness_is_near_the_exact_one(spark, documents):
    """The sketch's error against the similarity of all shingles, and its size against theirs."""
    found = sketch.fingerprints(documents)
    rows = found.withColumn("e", sketch.likeness(found["sketch"], found["edited_sketch"])).collect()
    off, kept, whole = [], 0, 0
    for r in rows:
        a, b = set(shingles_of(r["text"])), set(shingles_of(r["edited"]))
        off.append(abs(r["e"] - (len(a & b) / len(a | b) if a | b else 1.0)))
        kept, whole = kept + len(r["sketch"]), whole + len(a)
    print("mean error", sum(off) / len(off), "largest", max(off), "kept", kept / whole)
    assert sum(off) / len(off) < 0.06 and max(off) < 0.35 and kept < 0.3 * whole


def test_merge_and_containment(spark):
    rng = random.Random(4)
    long_ = [f"w{rng.randint(0, 300)}" for _ in range(4000)]
    a, b = " ".join(long_[1000:2200]), " ".join(long_)
    short, both = "one two three four five six seven", " ".join(long_[:700] + long_[1500:])
    df = spark.createDataFrame([(a, b, short, both)], "a string, b string, short string, both string")
    for name in df.columns:
        df = sketch.with_sketch(df, name, f"{name}_s")
    one = df.select(sketch.containment(F.col("a_s"), F.col("b_s")).alias("held"),
                    sketch.containment(F.col("b_s"), F.col("a_s")).alias("part"),
                    sketch.containment(F.col("short_s"), F.col("short_s")).alias("same"),
                    sketch.merged(F.array("a_s", "short_s")).alias("m"), "a_s", "short_s").first()
    assert one["held"] == 1.0 and abs(one["part"] - 0.3) < 0.08 and one["same"] == 1.0
    every = sorted(set(shingles_of(a)) | set(shingles_of(short)))
    assert one["m"] == [h for h in every if h <= -(1 << 63) + int(sketch.FRACTION * (1 << 64))]
    assert one["short_s"] == shingles_of(short)


def test_merged_short_sketches_are_the_sketch_of_both(spark):
    texts = [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((3, 20, 40, 90, 300, 0))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    rows = sketch.with_sketch(df, "t", "s")
    pairs = rows.alias("a").join(rows.alias("b"), F.col("a.i") < F.col("b.i")).select(
        "a.i", F.col("b.i").alias("j"), sketch.merged(F.array("a.s", "b.s")).alias("m")).collect()
    for r in pairs:
        every = sorted(set(shingles_of(texts[r["i"]])) | set(shingles_of(texts[r["j"]])))
        low = [h for h in every if h <= -(1 << 63) + int(sketch.FRACTION * (1 << 64))]
        assert r["m"] == (low if len(low) >= sketch.LEAST else every[:sketch.LEAST])


def test_short_texts_keep_fingerprints_of_their_own(spark):
    """Each text of few words has a filled fingerprint, and unrelated ones are not near."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(1 + i % 12))) for i in range(60)],
                                 "doc_id long, text string")
    got = sketch.fingerprints(docs)
    rows = got.withColumn("x", sketch.likeness(got["sketch"], got["next_sketch"])).withColumn(
        "e", sketch.likeness(got["sketch"], got["edited_sketch"])).collect()
    assert all(r["sketch"] and r["edited_sketch"] and r["x"] == 0.0 and r["e"] < 1.0 for r in rows)
    assert len({tuple(r["sketch"]) for r in rows}) == len(rows)
