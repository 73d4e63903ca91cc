"""Every stage's rows against brute force on its own input."""

import string
from collections import Counter

import pytest
import tiktoken

import corpus_pipeline
from conftest import SF_SMALL
from llm.helpers import words_of
from llm.test_bpe import RANKS
from llm.test_native import cleaned, water_level
from llm.test_ngram_join import brute
from tsline.llm import bpe, mixing
from tsline.llm.shared import write_scratch

ASCII = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage at the smallest size."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = write_scratch(stage(spark, docs, SF_SMALL), "test-stage")
        out.append((name, docs.columns, docs.collect(), after.columns, after.collect()))
        docs = after
    return out


def test_columns_and_order(stages):
    assert [s[0] for s in stages] == ["quality classifier", "line dedup", "n-gram Jaccard join", "mixing sources",
                                      "byte-level BPE"]
    for _, before, _, after, _ in stages[:-1]:
        assert after == before


def test_quality_keeps_good_rows(spark, stages):
    _, _, before, _, after = stages[0]
    kept = {r["doc_id"] for r in after}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    known = [r["doc_id"] for r in before if r["doc_id"] in labels]
    right = sum((d in kept) == bool(labels[d]) for d in known) / len(known)
    assert right > 0.9 and {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_lines(stages):
    _, _, before, _, after = stages[1]
    want = {d: text for d, _, _, text in cleaned([(r["doc_id"], r["text"], r["source"]) for r in before], 0.01, 3)}
    assert {r["doc_id"]: r["text"] for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_copies(stages):
    _, _, before, _, after = stages[2]
    groups = brute([(r["doc_id"], r["text"]) for r in before], 5, 80, 100)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, _, low in groups if d == low)


def test_mixture(stages):
    _, _, before, _, after = stages[3]
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(words_of(r["text"]))
    targets = water_level(dict(sizes))
    taken, texts = Counter(r["doc_id"] for r in after), {r["doc_id"]: tuple(r) for r in before}
    assert all(tuple(r) == texts[r["doc_id"]] for r in after)
    for r in before:
        rate = targets[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
        assert int(rate) <= taken[r["doc_id"]] <= int(rate) + 1
    assert mixing.CEILING == 2.0 and max(taken.values()) <= 2


def test_ids(stages):
    _, _, before, _, after = stages[4]
    import public_tokenizers
    with open(RANKS, "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in before}
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
    for r in after:
        assert r["text"] == (texts[r["doc_id"]] or "") and r["ids"] == reference.encode_ordinary(r["text"])
        assert r["n_tokens"] == len(r["ids"])


def test_run_and_hostile_rows(spark, hostile, empty, tmp_dir):
    """Nulls, empty texts, repeated rows, clashing columns and empty tables pass through every stage."""
    labels = spark.createDataFrame([(i, 1, 0) for i in range(19)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_dir}/labels.parquet")
    for docs in (hostile, empty):
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, write_scratch(stage(spark, docs, tmp_dir), "test-stage")
            assert docs.columns == before.columns or name == "byte-level BPE"
    assert docs.count() == 0
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
