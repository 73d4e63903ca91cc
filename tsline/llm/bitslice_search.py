"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks of like size. A block has one bitmap row for
each signature position and one bit in it for each document: a term's slice is
the AND of its rows, which tells every document that has the term, and a few
that do not. A document also enters the pair (term, level) for every level its
count reaches, so slices of higher levels bound the count from above. The sum of
the weighted slices of an item's terms is then never below a document's score.

A search task reads its blocks once. It scores exactly, from the whole text, every
document whose bound reaches the item's lowest score so far among its best, and
skips only those that provably rank below; its best documents of each item go on,
and the best of all tasks are ranked. The index depends on the documents alone, so
any items can be searched in it, in blocks of a bounded number of terms.

Defined cases: a null or empty text, or one without terms, has no score, counts
in no statistic and is never returned; a null id ranks behind other ids of the same
score; repeated rows are documents of their own; texts that share an item's id are
one item with the terms of all; an item without terms, or of terms that no document
holds, has no rows; no documents or no items give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsline.llm.shared import bounded, mix64, require, word_view, write_scratch

#: Rows of a block's bitmaps that a term sets, and bits of a document for each of its entries.
HASHES = 4
BITS_PER_ENTRY = 10
#: A block has at most this many documents, and bits in its bitmaps.
BLOCK_DOCS = 256
BLOCK_BITS = 1 << 24
#: Distinct (item, term) pairs that are searched at a time.
SLOTS = 1 << 15
_NO_ID = (1 << 63) - 1

#: Bytes of terms: digits, letters and everything beyond ASCII.
TERM_BYTES = np.array([chr(b).isalnum() if b < 0x80 else True for b in range(256)])
#: Counts at which a term enters a further slice.
LEVELS = np.array([1, 2, 3] + [b << s for s in range(1, 40) for b in (2, 3)], np.int64)


def terms_of(column: pa.Array):
    """Distinct terms of a batch, each term's index, and each row's first term, plus the end."""
    return word_view(column, fold=True, inside=TERM_BYTES)


def hashes(terms: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in terms.to_pylist()), np.uint64, len(terms))


def rows_of(hashed: np.ndarray, level: int, height: int) -> np.ndarray:
    """Bitmap rows of each term at a level: one line of ``HASHES`` rows a term."""
    mixed = mix64(hashed + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & 0xFFFFFFFFFFFFFFFF))
    start, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    return ((start[:, None] + turns * step[:, None]) % np.uint64(height)).astype(np.int64)


def _blocks(ids: pa.Array, texts: pa.Array):
    """Index blocks of one batch: (height, ids, lengths, texts, bitmaps)."""
    terms, index, first = terms_of(texts)
    lengths = np.diff(first)
    if not len(index):
        return
    hashed = hashes(terms)
    row = np.repeat(np.arange(len(lengths)), lengths)
    pairs, counts = np.unique(row * len(terms) + index, return_counts=True)
    row, term = pairs // len(terms), pairs % len(terms)
    levels = np.searchsorted(LEVELS, counts, side="right")
    entries = np.bincount(row, levels, len(lengths)).astype(np.int64)
    kind = np.frexp(entries.astype(np.float64))[1]  # documents of like size share a block
    order = np.argsort(kind, kind="stable")
    order = order[entries[order] > 0]
    at = np.searchsorted(row, np.arange(len(lengths) + 1))
    while len(order):
        members = order[kind[order] == kind[order[0]]]
        height = -(-int(entries[members].max()) * BITS_PER_ENTRY // 64) * 64
        members = members[:max(1, min(BLOCK_DOCS, BLOCK_BITS // height))]
        order = order[len(members):]
        bits = np.zeros((height, len(members)), np.bool_)
        for column, r in enumerate(members):
            own, top = hashed[term[at[r]:at[r + 1]]], levels[at[r]:at[r + 1]]
            for level in range(int(top.max())):
                bits[rows_of(own[top > level], level, height).ravel(), column] = True
        yield (height, ids.take(pa.array(members)), lengths[members], texts.take(pa.array(members)),
               np.packbits(bits, axis=1).tobytes())


INDEX = "height long, ids array<long>, lengths array<long>, texts array<string>, bits binary"


def build_index(docs: DataFrame) -> DataFrame:
    """The bit-sliced index of all documents with a term, written once to the shared folder."""
    require(docs, "doc_id", "text")

    def index(batches):
        for batch in bounded(batches, 1):
            found = list(_blocks(batch.column(0), batch.column(1)))
            if found:
                height, ids, lengths, texts, bits = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(height, pa.int64()), pa.array([i.to_pylist() for i in ids], pa.list_(pa.int64())),
                     pa.array(lengths, pa.list_(pa.int64())),
                     pa.array([t.to_pylist() for t in texts], pa.list_(pa.string())), pa.array(bits, pa.binary())],
                    names=["height", "ids", "lengths", "texts", "bits"])

    return write_scratch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                         .mapInArrow(index, INDEX), "bitslice-index")


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, term)``, each pair once."""
    require(items, item_id, text)

    def cut(batches):
        for batch in bounded(batches, 1):
            terms, index, first = terms_of(batch.column(1))
            row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            pairs = np.unique(row * max(1, len(terms)) + index)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(pairs // max(1, len(terms)))),
                 terms.take(pa.array(pairs % max(1, len(terms)))).cast(pa.large_string()).cast(pa.string())],
                names=["item_id", "term"])

    return items.select(F.col(item_id).cast("long"), F.col(text).cast("string")).mapInArrow(
        cut, "item_id long, term string").distinct()


class Query:
    """A block of items: distinct weighted terms, and each item's places among them."""

    def __init__(self, pairs: list[tuple], weights: dict[str, int], n: int, total: int):
        pairs = sorted((p for p in pairs if weights.get(p[1], 0) > 0), key=lambda p: (p[0] is None, p[0] or 0, p[1]))
        self.terms = sorted({t for _, t in pairs})
        place = {t: i for i, t in enumerate(self.terms)}
        self.slots = np.array([place[t] for _, t in pairs], np.int64)
        self.starts = np.array([i for i, p in enumerate(pairs) if not i or p[0] != pairs[i - 1][0]], np.int64)
        self.items = [pairs[i][0] for i in self.starts]
        self.weights = np.array([weights[t] for t in self.terms], np.int64)
        self.n, self.total = n, total

    def prepare(self) -> None:
        self.known = pa.array([t.encode() for t in self.terms], pa.large_binary())
        self.hashed = hashes(self.known)

    def scales(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 50 + (50 * lengths * self.n) // self.total

    def by_item(self, each: np.ndarray) -> np.ndarray:
        """Sums over each item's terms of a (term, document) table."""
        return np.add.reduceat(each[self.slots], self.starts, axis=0)

    def bounds(self, height: int, scales: np.ndarray, bits: bytes) -> np.ndarray:
        """Upper bounds of the scores: (item, document)."""
        packed = np.frombuffer(bits, np.uint8).reshape(height, -1)
        rows = rows_of(self.hashed, 0, height)
        slices = packed[rows[:, 0]]
        for j in range(1, HASHES):
            slices &= packed[rows[:, j]]
        term, doc = np.nonzero(np.unpackbits(slices, axis=1, count=len(scales)))
        high = np.zeros(len(term), np.int64)
        alive = np.arange(len(term))
        for level in range(1, len(LEVELS)):
            place = rows_of(self.hashed, level, height)[term[alive]]
            d = doc[alive]
            here = (packed[place, (d >> 3)[:, None]] >> (7 - (d & 7)).astype(np.uint8)[:, None]) & 1
            alive = alive[here.all(axis=1)]
            if not len(alive):
                break
            high[alive] = level
        most = np.append(LEVELS[1:], 1 << 41)[high] - 1  # the largest count below the next level
        each = np.zeros((len(self.terms), len(scales)), np.int64)
        each[term, doc] = self.weights[term] * ((1_000_000_000 * most) // (1000 * most + 20 * scales[doc]))
        return self.by_item(each)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Occurrences of each term in whole texts: (term, document)."""
        terms, index, first = terms_of(texts)
        where = np.asarray(pc.index_in(terms, value_set=self.known).fill_null(-1)).astype(np.int64)[index]
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        here = where >= 0
        size = len(first) - 1
        found = np.bincount(where[here] * size + row[here], minlength=len(self.terms) * size)
        return found.reshape(len(self.terms), size)

    def scores(self, scales: np.ndarray, texts: pa.Array) -> np.ndarray:
        """Exact scores: (item, document)."""
        tf = self.counts(texts)
        each = self.weights[:, None] * ((1_000_000_000 * tf) // (1000 * tf + 20 * scales))
        return self.by_item(each)


class _Best:
    """The best documents of every item so far."""

    def __init__(self, items: int, limit: int):
        self.limit = limit
        self.score = np.zeros((items, limit), np.int64)
        self.id = np.full((items, limit), _NO_ID, np.int64)

    def floor(self) -> np.ndarray:
        """Scores that a document has to reach."""
        return np.maximum(self.score[:, -1], 1)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for i in np.flatnonzero((scores >= self.floor()[:, None]).any(axis=1)):
            score, own = np.concatenate([self.score[i], scores[i]]), np.concatenate([self.id[i], ids])
            order = np.lexsort((own, -score))[:self.limit]
            self.score[i], self.id[i] = score[order], own[order]


def search_block(query: Query, best: _Best, height: int, ids: np.ndarray, lengths: np.ndarray,
                 texts: pa.Array, bits: bytes, at_once: int = 16) -> int:
    """Bring every document of a block that may be among the best into ``best``; how many were scored."""
    scales = query.scales(lengths)
    bounds = query.bounds(height, scales, bits)
    open_ = np.ones(len(ids), np.bool_)
    while True:
        reach = bounds - best.floor()[:, None]
        reach[:, ~open_] = -1
        most = reach.max(axis=0)
        chosen = np.argsort(-most, kind="stable")[:at_once]
        chosen = chosen[most[chosen] >= 0]
        if not len(chosen):
            return int((~open_).sum())
        open_[chosen] = False
        best.add(query.scores(scales[chosen], texts.take(pa.array(chosen))), ids[chosen])


def _search(index: DataFrame, query: Query, limit: int) -> DataFrame:
    def run(batches):
        query.prepare()
        best = _Best(len(query.items), limit)
        for batch in batches:
            for i in range(batch.num_rows):
                search_block(query, best, batch.column(0)[i].as_py(),
                             np.asarray(batch.column(1)[i].values.fill_null(_NO_ID), np.int64),
                             np.asarray(batch.column(2)[i].values, np.int64),
                             batch.column(3)[i].values, batch.column(4)[i].as_py())
        item, rank = np.nonzero(best.score)
        ids = best.id[item, rank]
        yield pa.RecordBatch.from_arrays(
            [pa.array([query.items[i] for i in item], pa.int64()), pa.array(ids, mask=ids == _NO_ID),
             pa.array(best.score[item, rank])], names=["item_id", "doc_id", "score"])

    return index.select("height", "ids", "lengths", "texts", "bits").mapInArrow(
        run, "item_id long, doc_id long, score long")


def _document_counts(index: DataFrame, terms: list[str]) -> dict[str, int]:
    """Number of documents that hold each term."""
    def count(batches):
        probe = Query([(0, t) for t in terms], dict.fromkeys(terms, 1), 0, 1)
        probe.prepare()
        held = np.zeros(len(probe.terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                held += (probe.counts(batch.column(0)[i].values) > 0).sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(held)), pa.array(held[held > 0])], names=["at", "n"])

    found = index.select("texts").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    ordered = sorted(terms)
    return {ordered[r["at"]]: r["n"] for r in found.collect()}


def search(index: DataFrame, items: DataFrame, limit: int = 50, item_id: str = "item_id",
           text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``limit`` best documents of the index.

    The driver holds the terms of one block of items at a time, about ``slots``
    of them (or one item's), and their document counts.
    """
    spark = index.sparkSession
    whole = index.agg(F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate(
        "lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("total")).first()
    n, total = whole["n"] or 0, whole["total"] or 0
    pairs = write_scratch(item_terms(items, item_id, text).withColumn(
        "deal", F.xxhash64("item_id")), "item-terms")
    parts = max(1, -(-pairs.count() // slots)) if n else 0
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for part in range(parts):
        mine = [(r["item_id"], r["term"]) for r in
                pairs.where(F.pmod("deal", F.lit(parts)) == part).select("item_id", "term").toLocalIterator()]
        held = _document_counts(index, sorted({t for _, t in mine}))
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in held.items()}
        query = Query(mine, weights, n, total)
        if query.items:
            found = found.union(_search(index, query, limit))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= limit).select("item_id", "rank", "doc_id", "score")
