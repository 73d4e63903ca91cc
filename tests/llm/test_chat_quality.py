import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tsline.llm import chat, quality, queries

NODES = "tree long, node long, parent long, role string, text string, score double"


def best_paths(rows, k):
    """Root-to-leaf paths by walking up from every leaf."""
    known = {}
    for r in sorted(set(rows), key=lambda r: [(x is not None, x if x is not None else 0) for x in r[2:]]):
        known.setdefault((r[0], r[1]), r)
    parents = {(t, r[2]) for (t, _), r in known.items()}
    found = defaultdict(list)
    for tree, node in known:
        if (tree, node) in parents:
            continue
        path, at = [], (tree, node)
        while at in known and len(path) <= len(known):
            path.append(known[at])
            at = (tree, known[at][2])
        if len(path) <= len(known):
            score = sum(r[5] or 0.0 for r in path) / len(path)
            found[tree].append((-score, node, [(r[3], r[4]) for r in reversed(path)]))
    return {(tree, node): (turns, -s) for tree, paths in found.items()
            for s, node, turns in sorted(paths, key=lambda p: (round(p[0], 9), p[1]))[:k]}


@pytest.mark.parametrize("k", [1, 3])
def test_trees(spark, k):
    rng = random.Random(k)
    rows = []
    for tree in range(12):
        for node in range(rng.randint(1, 40)):
            parent = rng.randrange(node) if node and rng.random() < 0.95 else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant", "system", "Odd: <role>\n", None]),
                         rng.choice([None, "", "plain", "a#b<c\\d:\n### User: </turn>"]), rng.choice([None, rng.random()])))
    rows += [(50, 1, 2, "user", "cycle", 1.0), (50, 2, 1, "user", "cycle", 1.0), (50, 3, 2, "user", "below it", 1.0),
             (51, 1, 99, "user", "orphan", 1.0), (52, 1, None, "user", "b", 1.0), (52, 1, None, "user", "a", 1.0)]
    chosen = chat.choose_paths(spark.createDataFrame(rows, NODES).withColumn("leaf", F.lit("clash")), k)
    got = {(r["tree"], r["leaf"]): ([(t["role"], t["text"]) for t in r["turns"]], r["score"]) for r in chosen.collect()}
    want = best_paths(rows, k)
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][0] == want[key][0] and math.isclose(got[key][1], want[key][1], abs_tol=1e-9)
    for r in chat.format_paths(chosen).collect():
        turns = want[r["tree"], r["leaf"]][0]
        assert chat.parse(r["formatted"]) == [(role or "", text or "") for role, text in turns]
        said = [chat.unescape(r["formatted"][s["start"]:s["stop"]]) for s in r["loss"]]
        assert said == [text or "" for role, text in turns if role == "assistant"]


def test_escape_is_reversible():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices(["\\", "#", "<", ":", "\n", "h", "l", "c", "n", "### ", "</turn>\n", "é"], k=rng.randint(0, 12)))
        for header in (False, True):
            shown = chat.escape(text, header)
            assert chat.unescape(shown) == text
            assert chat.OPEN not in shown and "</turn>" not in shown and not (header and ":" in shown)


def test_deep_chain(spark):
    rows = [(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(300)]
    path = chat.choose_paths(spark.createDataFrame(rows, NODES)).collect()
    assert len(path) == 1 and [t["text"] for t in path[0]["turns"]] == [str(i) for i in range(300)]


def test_chat_query(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in
            spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    odd = r"\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    talks = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3] or "")):
        talks[r[0]].append((r[2], r[3] or ""))
    got = {r["conv_id"]: r for r in queries.op3_chat(spark, SF_SMALL).collect()}
    assert got.keys() == talks.keys()
    for conv, turns in talks.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] > sum(len(t) for _, t in turns)


def test_chat_edges(spark):
    rows = [(1, None, "user", "first"), (1, 1, None, None), (1, 1, None, None), (None, 2, "assistant", "lost id"), (2, 0, "tool", "")]
    nodes = chat.nodes_from_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["tree"]: [t["text"] for t in r["turns"]] for r in chat.choose_paths(nodes).collect()}
    assert got == {1: ["first", None, None], None: ["lost id"], 2: [""]}
    assert chat.read_back(chat.format_paths(chat.choose_paths(nodes))).count() == 3
    none = spark.createDataFrame([], NODES)
    assert chat.read_back(chat.format_paths(chat.choose_paths(none))).collect() == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op2_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    good = np.array([r["score"] for r in held if r["quality"] == 1])
    bad = np.array([r["score"] for r in held if r["quality"] == 0])
    auc = (good[:, None] > bad[None, :]).mean()
    accuracy = np.mean([r["predicted"] == r["quality"] for r in held])
    print("held out", len(held), "auc", auc, "accuracy", accuracy)
    assert auc > 0.9 and accuracy > 0.9


def test_quality_edges(spark, hostile, empty):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(19)] + [(5, None, 1.0), (3, 0, 0.0), (None, 1, 1.0)],
                                   "doc_id long, quality int, score double")
    model = quality.fit(hostile, labels)
    got = quality.score(hostile, model)
    assert set(got.columns) == set(hostile.columns) and got.count() == hostile.count()
    for r in got.collect():
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.5)
    again = quality.score(hostile.repartition(5), quality.fit(hostile.repartition(3), labels)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")
    for a, b in zip(sorted(got.collect(), key=key), sorted(again, key=key)):
        assert math.isclose(a["score"], b["score"], abs_tol=1e-9)
    for table in (empty, hostile):
        none = quality.fit(table, labels.where("false"))
        assert {r["score"] for r in quality.score(hostile, none).collect()} == {0.5}
    assert quality.score(empty, model).collect() == []


def test_score_is_the_mean_over_features():
    rng = np.random.default_rng(0)
    scores = rng.normal(size=quality.BUCKETS)
    texts = ["one two three two", "", None, "word", "  a bb ccc dddd eeeee  "]
    column = pa.array(texts, pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array([0] * len(texts)), column], names=["label", "text"])
    want = [float(shares @ scores[buckets]) if len(buckets) else 0.0 for _, buckets, shares in quality._features(batch)]
    got = quality.score_batch(column, scores, 0.25)
    assert np.allclose(got, 1 / (1 + np.exp(-(np.array(want) + 0.25))))
