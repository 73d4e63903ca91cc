import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from tsline.llm import queries, suffix_dedup


def brute(texts, length):
    """per text: covered byte mask"""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i:i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        mask = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                mask[i:i + length] = True
        out.append((raw, mask))
    return out


def expected(rows, length):
    out = []
    for (doc_id, _), (raw, mask) in zip(rows, brute([t for _, t in rows], length)):
        runs = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if len(mask) else 0
        out.append((doc_id, len(raw), int(mask.sum()), runs, bytes(np.frombuffer(raw, np.uint8)[~mask])))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], sum(s["stop"] - s["start"] for s in r["spans"]), len(r["spans"]),
                    bytes(r["kept"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("options", [dict(length=40, gram=16), dict(length=40, gram=16, most=1),
                                     dict(length=64, gram=64, piece=64)])
def test_hostile_rows(hostile, options):
    rows = [(r["doc_id"], r["text"]) for r in hostile.select("doc_id", "text").collect()]
    assert result(suffix_dedup.drop_repeats(hostile, **options)) == expected(rows, options["length"])


@pytest.mark.parametrize("most", [20_000, 2])
def test_shared_passages(spark, most):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choices("abcd é\n", k=n))
    passages = [prose(rng.randint(30, 90)) for _ in range(4)]
    rows = [(i, prose(rng.randint(0, 60)) + "".join(p + prose(rng.randint(0, 9)) for p in rng.choices(passages, k=3)))
            for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix_dedup.drop_repeats(df, 40, 16, most)) == expected(rows, 40)


def test_query_is_exact_on_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    want = [(a, b, c, d, hashlib.sha256(e).hexdigest()) for a, b, c, d, e in expected(rows, 400)]
    got = queries.op4_suffix_dedup(spark, SF_SMALL).collect()
    assert sorted(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in got) == sorted(want)


def test_empty_table(empty):
    assert suffix_dedup.drop_repeats(empty).collect() == []


@pytest.mark.parametrize("alphabet", [2, 250])
def test_deep_shallow_order(alphabet):
    rng = np.random.default_rng(alphabet)
    data = rng.integers(0, alphabet, 3000).astype(np.uint8)
    data[1000:1600] = data[200:800]
    data[2000:2300] = 7
    starts = rng.permutation(3000 - 80)
    groups = starts % 3
    order, same = suffix_dedup.deep_shallow(data, starts, groups, 80, 2)
    raw = data.tobytes()
    keys = [(groups[i], raw[starts[i]:starts[i] + 80]) for i in order]
    assert keys == sorted(keys)
    assert list(same) == [False] + [a == b for a, b in zip(keys, keys[1:])]


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 7, 64, 200):
        assert list(suffix_dedup.sliding_min(values, width)) == [min(values[i:i + width]) for i in range(201 - width)]
