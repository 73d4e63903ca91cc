"""Ranked search against brute force: hostile rows, blocks of items, bounds that are never too low."""

import math
import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from tsline.llm import bitslice_search as search

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def cut(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, limit=50):
    held = [(i, Counter(cut(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(cut(t))
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, terms in queries.items():
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * sum(c.values()) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        rows += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:limit], 1)]
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    index = search.build_index(docs)
    rows = search.search(index, items, **options)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, rows.collect()), key=repr)


def items_of(spark):
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)]
    return [(i, " ".join(rng.choices(vocab, k=20))) for i in range(12)] + [
        (20, None), (21, ""), (22, "it's NAÏVE 123"), (23, "zzz nowhere"), (24, "one"), (24, "footer"),
        (24, "footer"), (None, "two words"), (25, "漢字 🙂🙂 été")]


@pytest.mark.parametrize("limit, slots", [(50, 1 << 15), (3, 1 << 15), (7, 20)])
def test_hostile(spark, hostile, limit, slots):
    docs = [(r["doc_id"], r["text"]) for r in hostile.select("doc_id", "text").collect()]
    items = items_of(spark)
    given = spark.createDataFrame(items, ITEMS).selectExpr("*", "'clash' AS score", "'clash' AS doc_id")
    assert found(spark, hostile, given, limit=limit, slots=slots) == brute(docs, items, limit)


def test_nothing(spark, hostile, empty):
    some, none = spark.createDataFrame([(1, "footer")], ITEMS), spark.createDataFrame([], ITEMS)
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " -- ")], "doc_id long, text string")
    assert found(spark, empty, some) == found(spark, hostile, none) == found(spark, blank, some) == []


def test_counts_beyond_all_levels_and_ties(spark):
    docs = [(i, "same text here") for i in range(40)] + [(100, "word " * 5000 + "end"), (101, "word word"), (102, "x")]
    items = [(1, "word"), (2, "same text"), (3, "x end word same")]
    got = found(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                spark.createDataFrame(items, ITEMS), limit=10)
    assert got == brute(docs, items, 10)


def test_bounds_hold_and_skip(spark):
    """No bound is below a score, and far fewer documents are scored than there are."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = [r["text"] for r in docs] * 5
    rare = [f"only{i} " * (1 + i % 4) + (t or "") for i, t in enumerate(texts)]
    held = [Counter(cut(t)) for t in rare]
    df = Counter(t for c in held for t in c)
    n, total = len(held), sum(sum(c.values()) for c in held)
    weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    pairs = sorted({(i, t) for i in range(0, n, 50) for t in set(cut(rare[i])[:40])})
    query = search.Query(pairs, weights, n, total)
    query.prepare()
    best, scored = search._Best(len(query.items), 5), 0
    ids = pa.array(range(n), pa.int64())
    for height, own, lengths, part, bits in search._blocks(ids, pa.array(rare)):
        scales = query.scales(lengths)
        assert (query.bounds(height, scales, bits) >= query.scores(scales, part)).all()
        scored += search.search_block(query, best, height, np.asarray(own), lengths, part, bits)
    assert all((best.score > 0).any(axis=1))
    assert scored < 0.6 * n
