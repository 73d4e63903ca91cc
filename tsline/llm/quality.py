"""Quality classifier with supervised subword embeddings.

A document is the mean of the learned vectors of its hashed features: words,
word pairs and the 3 to 5 byte substrings of each word; a softmax over two
classes follows. Training is stochastic gradient descent in numpy over a bounded
sample of labelled rows; scoring runs over every document and whole text.

Defined cases: null text counts as empty; a text without words scores the bias
alone; labels that are null are ignored, repeated labels of a document count
once (the smallest), as do texts of a repeated id; without labelled rows every score is 0.5, with one class
only the scores lean to it; repeated documents are scored alike, and ``score``,
``predicted`` and ``held_out`` replace input columns of these names; an empty
table gives an empty result. ``doc_id`` decides only which rows are held out,
and, with the labels, which rows are trained on; it is no feature.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsline.llm.shared import bounded, mix64, require, word_view, write_scratch

BUCKETS = 1 << 18
DIM = 8
RATE = 0.5
#: Steps of training, whatever the number of rows: passes over all rows in new orders, the last one cut.
STEPS = 48_000
#: Bound on the labelled rows that training takes, by hash of their id.
TRAINING_ROWS = 6000
NGRAMS = (3, 4, 5)
#: Bytes of text that a worker scores at a time.
TEXT_AT_ONCE = 1 << 20


def _hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each distinct word; substring buckets of all words and each word's start among them."""
    n = len(words)
    ends = np.asarray(np.frombuffer(words.buffers()[1], np.int64, n + 1, words.offset * 8))
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    # each word between two marks
    size = np.diff(ends) + 2
    start = np.concatenate([[0], np.cumsum(size)])
    marked = np.zeros(start[-1], np.uint64)
    marked[start[:-1]], marked[start[1:] - 1] = 256, 257
    inside = np.ones(start[-1], bool)
    inside[start[:-1]] = inside[start[1:] - 1] = False
    marked[inside] = data
    owner = np.repeat(np.arange(n), size)
    code = mix64(marked + np.uint64(1))
    room = start[1:][owner] - np.arange(start[-1])  # bytes from here to the word's end
    grams, owners = [], []
    rolling = np.zeros(start[-1], np.uint64)
    for k in range(1, max(NGRAMS) + 1):
        here = np.zeros(start[-1], np.uint64)
        here[:start[-1] - k + 1] = code[k - 1:]
        rolling = rolling * np.uint64(0x9E3779B97F4A7C15) + here
        if k in NGRAMS:
            ok = room >= k
            grams.append(mix64(rolling[ok] + np.uint64(k)) % np.uint64(BUCKETS))
            owners.append(owner[ok])
    own = np.concatenate(owners)
    order = np.argsort(own, kind="stable")
    place = np.arange(start[-1], dtype=np.uint64) - start[:-1].astype(np.uint64)[owner]
    terms = mix64(marked * np.uint64(0x9E3779B97F4A7C15) + place)
    hashes = mix64(np.add.reduceat(terms, start[:-1])) if n else np.zeros(0, np.uint64)
    counts = np.bincount(own, minlength=n)
    return hashes, np.concatenate(grams)[order].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def _pairs(hashes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Bucket of each pair of adjacent words (the last entry pairs nothing)."""
    h = hashes[index]
    return (mix64(h[:-1] * np.uint64(3) + h[1:]) % np.uint64(BUCKETS)).astype(np.int64)


def _features(batch: pa.RecordBatch):
    """Per row of ``(label, text)``: its distinct buckets and their shares."""
    words, index, rows = word_view(batch.column(1))
    hashes, grams, starts = _hashed(words) if len(words) else (np.zeros(0, np.uint64),) * 3
    single = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    pairs = _pairs(hashes, index) if len(index) > 1 else np.zeros(0, np.int64)
    labels = batch.column(0).to_pylist()
    for r, label in enumerate(labels):
        own = index[rows[r]:rows[r + 1]]
        distinct, times = np.unique(own, return_counts=True)
        spans = [grams[starts[w]:starts[w + 1]] for w in distinct]
        buckets = np.concatenate([single[distinct], *spans, pairs[rows[r]:max(rows[r], rows[r + 1] - 1)]]).astype(np.int64)
        weight = np.concatenate([times, *[np.full(len(s), t) for s, t in zip(spans, times)],
                                 np.ones(max(0, len(own) - 1))])
        buckets, where = np.unique(buckets, return_inverse=True)
        weight = np.bincount(where, weight, len(buckets))
        yield label, buckets, weight / max(weight.sum(), 1.0)


def train(rows, dim: int = DIM, steps: int = STEPS, rate: float = RATE, seed: int = 7):
    """Score of each bucket (class 1 against class 0, per unit share) and the bias.

    ``rows`` are ``(label, buckets, shares)``. Only the difference of the two
    softmax logits matters afterwards, so the embeddings fold into one number
    for each bucket.
    """
    rows = list(rows)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    output, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    done = 0
    while rows and done < steps:
        for r in rng.permutation(len(rows))[:steps - done]:
            label, buckets, shares = rows[r]
            step = rate * (1 - done / steps)
            done += 1
            hidden = shares @ vectors[buckets] if len(buckets) else np.zeros(dim)
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[label] -= 1.0
            back = output @ error
            output -= (step * np.outer(hidden, error)).astype(np.float32)
            bias -= (step * 0.1 * error).astype(np.float32)
            if len(buckets):
                vectors[buckets] -= (step * len(buckets) ** 0.5 * np.outer(shares, back)).astype(np.float32)
    slope = (output[:, 1] - output[:, 0]).astype(np.float64)
    return vectors.astype(np.float64) @ slope, float(bias[1] - bias[0])


def held_out(doc_id):
    """Rows that no training sees: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS):
    """``(bucket scores, bias)`` learned from at most ``rows`` labelled rows that are not held out.

    Features are computed where the texts are; one task holds at most ``rows``
    times the distinct buckets of a document and trains on them in id order.
    """
    require(docs, "doc_id", "text")
    require(labels, "doc_id", label)
    spark = docs.sparkSession
    usable = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("label")))
    chosen = write_scratch(usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows), "quality-sample")
    full = F.coalesce("text", F.lit(""))
    # at most ``rows`` ids; of the texts of a repeated id, the one with the smallest hash
    texts = (docs.select(F.col("doc_id").cast("long"), full.alias("text")).join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")))

    def features(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, 64):
                part = list(_features(batch.slice(at, 64).select([1, 2])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + 64], pa.int64()), pa.array([x[0] for x in part], pa.int32()),
                     pa.array([x[1].astype(np.int32) for x in part], pa.list_(pa.int32())),
                     pa.array([x[2].astype(np.float32) for x in part], pa.list_(pa.float32()))],
                    names=["doc_id", "label", "buckets", "shares"])

    def learn(batches):
        found = []
        for batch in batches:
            for i in range(batch.num_rows):
                found.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(),
                              batch.column(2)[i].values.to_numpy(), batch.column(3)[i].values.to_numpy()))
        found.sort(key=lambda x: x[0])
        scores, bias = train(x[1:] for x in found)
        yield pa.RecordBatch.from_arrays([pa.array([scores.tobytes()], pa.binary()), pa.array([bias])],
                                         names=["scores", "bias"])

    table = write_scratch(texts.mapInArrow(
        features, "doc_id long, label int, buckets array<int>, shares array<float>"), "quality-features")
    model = write_scratch(table.repartition(1).mapInArrow(learn, "scores binary, bias double"), "quality-model")
    found = [r for r in model.collect()]
    if not found:
        return spark.sparkContext.broadcast((np.zeros(BUCKETS), 0.0))
    return spark.sparkContext.broadcast((np.frombuffer(found[0]["scores"], np.float64), found[0]["bias"]))


def score_batch(column: pa.Array, scores: np.ndarray, bias: float) -> np.ndarray:
    """Probability of class 1 for every row of a string column."""
    words, index, rows = word_view(column)
    logits = np.zeros(len(column))
    if len(words):
        hashes, grams, starts = _hashed(words)
        sums = np.concatenate([[0.0], np.cumsum(scores[grams])])
        own = scores[(hashes % np.uint64(BUCKETS)).astype(np.int64)] + sums[starts[1:]] - sums[starts[:-1]]
        total = np.concatenate([[0.0], np.cumsum(own[index])])
        many = np.concatenate([[0], np.cumsum((1 + np.diff(starts))[index])])
        pairs = np.concatenate([[0.0], np.cumsum(scores[_pairs(hashes, index)]), [0.0]]) if len(index) > 1 else np.zeros(len(index) + 1)
        pairs[-1] = pairs[-2] if len(pairs) > 1 else 0.0
        last = np.maximum(rows[:-1], rows[1:] - 1)
        value = total[rows[1:]] - total[rows[:-1]] + pairs[last] - pairs[np.minimum(rows[:-1], len(pairs) - 1)]
        logits = value / np.maximum(many[rows[1:]] - many[rows[:-1]] + last - rows[:-1], 1)
    return 1.0 / (1.0 + np.exp(-np.clip(logits + bias, -700, 700)))


def score(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted``: map-only; only texts go to the workers and only scores come back."""
    require(docs, text)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores, bias = model.value
        for batch in batches:
            parts = bounded([pa.RecordBatch.from_arrays([batch], names=["text"])], 0, TEXT_AT_ONCE)
            yield pa.array(np.concatenate([np.zeros(0), *(score_batch(p.column(0), scores, bias) for p in parts)]))

    return docs.select(*kept, probability(F.col(f"`{text}`").cast("string")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
