from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_CHECK, SF_SMALL
from llm.helpers import words_of
from tsline.llm import ngram_join, queries
from tsline.llm.shared import components


def brute(rows, k, num, den):
    """component by (id, text) over all pairs"""
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        low = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out += [(rows[i][0], len(sets[i]), low if sets[i] else rows[i][0]) for i in members]
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (2, 50, 100)])
def test_hostile_rows(hostile, k, num, den):
    rows = [(r["doc_id"], r["text"]) for r in hostile.select("doc_id", "text").collect()]
    assert result(ngram_join.ngram_groups(hostile, k, num, den)) == brute(rows, k, num, den)


@pytest.mark.parametrize("limits", [{"most_rows": 4, "pivots": 2}, {"most_rows": 3, "pivots": 3, "most_shingles": 500}])
def test_near_copies_through_recursion(spark, limits, monkeypatch):
    """Groups of many different near copies: cells, windows, blocks and settled rows give the exact links."""
    monkeypatch.setattr(ngram_join, "REGION_ROWS", limits.get("most_rows", 256))
    rng = np.random.default_rng(5)
    rows = []
    for group, edits in enumerate((3, 8, 14)):
        base = [f"w{group}_{i}" for i in range(150)]
        for _ in range(25):
            text = list(base)
            for at in rng.integers(0, 150, rng.integers(0, edits)):
                text[at] = f"e{rng.integers(0, 10_000)}"
            rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.ngram_groups(df, 3, 90, 100, **limits)
    assert result(got) == brute(rows, 3, 90, 100)


def test_query_is_exact_on_documents(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert result(queries.op1_ngram_join(spark, SF_SMALL)) == brute(rows, 3, 90, 100)


def test_one_of_each(hostile):
    kept = ngram_join.one_of_each(hostile, k=5, num=80, den=100)
    assert kept.columns == hostile.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert [x for x in rows if x[0] == 5] == [r for r in rows if r[0] == 5][:1]
    assert not any(r[0] == 6 for r in rows)  # a copy of 5
    linked = brute([r for r in rows if r[0] is not None], 5, 80, 100)
    assert all(a == b for a, _, b in linked)
    # a second pass finds nothing more
    assert kept.count() == ngram_join.one_of_each(kept, k=5, num=80, den=100).count()


def test_one_of_each_goes_by_links_not_by_ids(spark, hostile):
    prose = lambda n: " ".join(f"w{n}x{i}" for i in range(40))
    near = prose(1) + " more"
    rows = [(99, prose(1)), (99, prose(2)), (7, near), (None, prose(3)), (None, prose(3)), (None, prose(4)),
            (None, prose(2)), (50, prose(5)), (50, prose(5)), (8, None), (8, ""), (None, " "), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, ngram_join.one_of_each(df, k=5, num=80, den=100).collect()), key=repr)
    assert kept == sorted([(7, near), (99, prose(2)), (None, prose(3)), (None, prose(4)), (50, prose(5)),
                           (8, None), (8, ""), (None, " "), (None, " ")], key=repr)
    planted = [r["text"] for r in hostile.where("doc_id = 99").collect()]
    found = ngram_join.one_of_each(hostile, k=5, num=80, den=100).where("doc_id = 99").collect()
    assert sorted(r["text"] for r in found) == sorted(planted)


def test_empty_table(empty):
    assert ngram_join.ngram_groups(empty).collect() == []
    assert ngram_join.one_of_each(empty).collect() == []


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (50, 100)])
def test_sets_at_the_threshold_share_a_key(num, den):
    rng = np.random.default_rng(2)
    for size in (1, 2, 5, 9, 10, 19, 20, 50, 200, 1000):
        for _ in range(40):
            a = rng.integers(0, 1 << 63, size).astype(np.uint64)
            drop = rng.integers(0, size * (den - num) // den + 1)
            b = a[drop:]
            extra = (len(b) * den - num * size) // num
            b = np.concatenate([b, rng.integers(0, 1 << 63, max(0, int(rng.integers(0, extra + 1)))).astype(np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if den * both < num * (len(a) + len(b) - both):
                continue
            keys, rows = ngram_join.part_keys([a, b], num, den)
            assert set(keys[rows == 0]) & set(keys[rows == 1]), (size, len(a), len(b))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (3, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_without_ids_keep_their_links(spark):
    """Near copies that all lack an id, or share one, are one group of their own kind."""
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(base[:i] + [f"edit{i}"] + base[i + 1:]) for i in range(150)]
    for ids in ([None] * 150, [4] * 150, list(range(150))):
        df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
        got = ngram_join.ngram_groups(df, 5, 80, 100)
        rows = got.collect()
        assert len(rows) == 150 and len({r["group_key"] for r in rows}) == 1
        assert {r["component_id"] for r in rows} == {min((i for i in ids if i is not None), default=None)}
        assert ngram_join.one_of_each(df, k=5, num=80, den=100).count() == 1


def test_starting_regions_do_not_grow_together(spark):
    """Documents that share passages, but are no near copies, are not tied into one region."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    sizes = (ngram_join.starting_regions(docs, 5, 80, 100).groupBy("component").count().toPandas()["count"])
    assert sizes.max() <= 30


def test_names_of_all_kinds_are_kept(spark):
    names = ("_own", "_id", "_hash", "_group", "row", "id", "hash", "own_id", "own_hash", "number", "region", "digest",
             "component", "low", "a b", "x.y")
    df = spark.createDataFrame([(1, "some words here now", *names), (1, "some words here now", *names),
                                (2, "some words here now", *names)],
                               "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert [tuple(r) for r in kept.collect()] == [(1, "some words here now", *names)]


def test_sets_below_the_threshold_are_not_tied(spark):
    """A chain of documents that each share half of their passages with the next one has no regions."""
    rows = [(i, " ".join(f"w{j}x{n}" for j in (i, i + 1) for n in range(200))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.starting_regions(df, 5, 80, 100).collect() == []
    near = rows + [(100 + i, text + " more") for i, text in rows[::10]]
    got = ngram_join.ngram_groups(spark.createDataFrame(near, "doc_id long, text string"), 5, 80, 100)
    assert result(got) == brute(near, 5, 80, 100)


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (50, 100)])
def test_linked_sets_pass_the_parity_check(num, den):
    rng, seen = np.random.default_rng(3), []
    for size in (1, 3, 9, 20, 64, 65, 300, 1000, 6000):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = a[rng.integers(0, size * (den - num) // den + 1):]
            more = rng.integers(0, (len(b) * den - num * size) // num + 1)
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 63, more).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            seen.append((a, b, den * both >= num * (len(a) + len(b) - both)))
            seen.append((a, np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64)), False))
    bits = [pa.array([ngram_join.parity_bits(x[i]) for x in seen], pa.binary()) for i in (0, 1)]
    many = [np.array([len(x[i]) for x in seen]) for i in (0, 1)]
    good = ngram_join.may_link(*bits, *many, num, den)
    linked = np.array([x[2] for x in seen])
    assert linked.sum() > 100 and good[linked].all()
    far = np.array([not x[2] and len(x[0]) >= 20 for x in seen])
    assert good[far].mean() < (0.05 if num >= 80 else 1.01)


@pytest.mark.parametrize("most", [1, 3])
def test_common_keys_lose_no_link(hostile, spark, monkeypatch, most):
    """With keys of few sets taken as common, hubs and the other keys still find every link."""
    monkeypatch.setattr(ngram_join, "KEY_SETS", most)
    rows = [(r["doc_id"], r["text"]) for r in hostile.select("doc_id", "text").collect()]
    assert result(ngram_join.ngram_groups(hostile, 3, 90, 100)) == brute(rows, 3, 90, 100)
    rng, near = np.random.default_rng(8), []
    for group in range(12):
        base = [f"w{group}_{i}" if i % 3 else f"all_{i}" for i in range(6 + 12 * group)]
        for _ in range(8):
            text = list(base)
            for at in rng.integers(0, len(base), rng.integers(0, 2 + len(base) // 25)):
                text[at] = f"e{rng.integers(0, 10_000)}"
            near.append((len(near), " ".join(text)))
    df = spark.createDataFrame(near, "doc_id long, text string").repartition(3)
    for k, num in ((1, 80), (2, 80), (3, 90)):
        assert result(ngram_join.ngram_groups(df, k, num, 100)) == brute(near, k, num, 100)


def test_regions_that_cells_would_copy_are_left_whole(spark, monkeypatch):
    """Unlinked sets in one region are compared as blocks once, not as a copy for every pivot."""
    monkeypatch.setattr(ngram_join, "REGION_ROWS", 8)
    sets = [[100 * i + j for j in range(20)] for i in range(40)]
    sets += [s[:-1] for s in sets[::4]]
    rows = spark.createDataFrame([("0", f"d{i:02}", s, None) for i, s in enumerate(sets)],
                                 "region string, digest string, found array<long>, label string")
    sizes = rows.groupBy("region").agg({"digest": "count"}).toDF("region", "n")
    cells, whole, _ = ngram_join._split(rows, sizes, 4, 80, 100)
    assert cells.count() == 0 and whole.count() == len(sets) - 4
    got = components(ngram_join.region_links(rows, 80, 100, pivots=4, most_rows=8)).collect()
    assert {(r["component"], r["id"]) for r in got if r["id"] != r["component"]} == {
        (f"d{4 * i:02}", f"d{40 + i:02}") for i in range(10)}


def test_open_sets_are_tied_by_their_rarest_shingles_only(spark):
    """Short texts with empty parts and texts around one common passage have no regions; near copies among them have."""
    rows = [(i, " ".join(f"w{i}x{n}" for n in range(9 + i % 4))) for i in range(1200)]
    rows += [(5000 + i, " ".join([f"all{n}" for n in range(i % 3, 150)] + [f"v{i}x{n}" for n in range(50)]))
             for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.starting_regions(df, 5, 80, 100).collect() == []
    near = [(7000 + i, text + " more") for i, text in rows[::9]]
    near += [(8000 + i, "more " + text) for i, text in rows[-30:]]
    df = spark.createDataFrame(rows + near, "doc_id long, text string")
    assert result(ngram_join.ngram_groups(df, 5, 80, 100)) == brute(rows + near, 5, 80, 100)


@pytest.mark.parametrize("num,den", [(90, 100), (80, 100), (50, 100), (1, 3)])
def test_linked_sets_share_a_key_of_first_shingles(num, den):
    rng = np.random.default_rng(6)
    for size in (1, 2, 3, 4, 5, 9, 10, 19, 20, 21, 50, 200, 1000):
        for _ in range(40):
            pool = rng.permutation(4 * size + 8)  # a shingle's number is its place in the order of all
            a = pool[:size]
            b = a[rng.integers(0, size * (den - num) // den + 1):]
            more = rng.integers(0, (len(b) * den - num * size) // num + 1)
            b = np.concatenate([b, pool[size:size + more]])
            both = len(np.intersect1d(a, b))
            if den * both < num * (len(a) + len(b) - both):
                continue
            sizes = np.array([len(a), len(b)])
            run = np.repeat([0, 1], sizes)
            place = np.concatenate([np.arange(len(x)) for x in (a, b)])
            keys, sets = ngram_join.first_keys(sizes, run, place, np.concatenate([np.sort(a), np.sort(b)]).astype(np.uint64),
                                               num, den)
            assert set(keys[sets == 0]) & set(keys[sets == 1]), (size, len(a), len(b))


def test_halves_of_the_keys_are_all_keys():
    """Keys are dealt in two halves, each with about half of them and its own slack; no set is without one of them."""
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 2, 4, 5, 7, 9, 30, 100, 300, 1000)] * 20
    for num in (50, 80, 90):
        for empties in (True, False):
            keys, rows, slack = ngram_join._keys_and_slack(sets, num, 100, empties)
            parts = [ngram_join._keys_and_slack(sets, num, 100, empties, half) for half in (0, 1)]
            both = [np.concatenate([p[i] for p in parts]) for i in (0, 1)]
            assert sorted(zip(*both)) == sorted(zip(keys, rows))
            assert (np.minimum(parts[0][2], parts[1][2]) == slack).all()


def test_sets_that_go_on_in_the_next_batch_keep_their_keys(monkeypatch):
    rng = np.random.default_rng(10)
    rows = sorted((n, times, shingle, 27) for n in range(30)
                  for times, shingle in zip(rng.integers(2, 9, 25).tolist(), rng.permutation(60)[:25].tolist()))
    rows += rows[-3:]  # rows that repeat an id with its text
    rows.sort()
    table = pa.RecordBatch.from_pydict({"number": [r[0] for r in rows], "size": [r[3] for r in rows],
                                        "shingle": [r[2] for r in rows]})
    keys = lambda batches: sorted((r["key"], r["a"]) for b in ngram_join._by_rarest(batches, 80, 100, 99)
                                  for r in b.to_pylist())
    whole = keys([table])
    monkeypatch.setattr(ngram_join, "SHINGLES_HELD", 10)
    assert whole and keys([table.slice(i, 7) for i in range(0, len(rows), 7)] + [table.slice(0, 0)]) == whole
