import base64
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tsline.llm import bpe, queries, token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def blob():
    with open(RANKS, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def reference(blob):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hostile_rows(hostile, reference):
    got = bpe.encode(hostile, RANKS, P.PATTERN, offsets=True)
    assert set(got.columns) == set(hostile.columns) | {"char_starts"}
    decoded = bpe.decode(bpe.decode(got, RANKS).withColumnRenamed("decoded", "raw"), RANKS, as_text=True)
    for r in decoded.collect():
        text = r["text"] or ""
        assert r["ids"] == reference.encode_ordinary(text)
        assert bytes(r["raw"]) == text.encode() and r["decoded"] == text
        assert r["char_starts"] == (reference.decode_with_offsets(r["ids"])[1] if r["ids"] else [])


def test_cuts_never_change_ids(blob, reference):
    tokenizer = bpe.PieceEncoder(bpe.rank_tokenizer(blob, P.PATTERN), limit=500)
    rng = random.Random(4)
    alphabet = list("aZ9 '.\n\t\r") + [" ", " ", "\x1c", "\x7f", " ", "\u0085", " ", " ", " ", "　",
                                        "é", "ß", "я", "漢", "ก", "🙂", "​", "́", "'s", "'ll", "<|endoftext|>"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4000)] + [None, ""]
    flat, starts = bpe.encode_column(tokenizer, pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert list(flat[starts[i]:starts[i + 1]]) == reference.encode_ordinary(text or ""), repr(text)
    for at in (7, 7, 900):  # pieces kept, and forgotten past the bound
        some, starts = bpe.encode_column(tokenizer, pa.array(texts, pa.string()).slice(at, 50))
        assert list(some[starts[0]:starts[1]]) == reference.encode_ordinary(texts[at])


def test_split_characters(blob, reference):
    table = bpe.token_bytes(blob)
    text = "🙂 漢字 ก็ é"
    ids = reference.encode_ordinary(text)
    assert "".join(bpe.decode_steps(ids, table)) == text
    assert any(len(reference.decode_single_token_bytes(i).decode("utf-8", "ignore").encode()) < len(table[i]) for i in ids)
    cut = bpe.decode_steps(ids[:1], table)
    assert cut == [table[ids[0]].decode("utf-8", "replace")]


def test_bad_id_is_an_error(spark):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), RANKS).collect()


def test_null_ids(spark):
    rows = bpe.decode(spark.createDataFrame([(1, None), (2, [64, 65]), (3, [])], "doc_id long, ids array<int>"), RANKS)
    got = {r["doc_id"]: bytes(r["decoded"]) for r in rows.collect()}
    assert got[1] == got[3] == b"" and len(got[2]) == 2


def test_query(spark, documents, reference):
    got = {r["doc_id"]: r for r in queries.op5_bpe(spark, SF_SMALL).collect()}
    for r in documents.collect():
        ids, own = reference.encode_ordinary(r["text"] or ""), got.pop(r["doc_id"])
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert not got


def test_empty(empty, tmp_dir):
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).collect() == []
    assert token_counts.count_tokens(empty, P.path("byte_bpe_50k.json"), tmp_dir).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, hostile, documents, tmp_dir, name):
    if name.endswith(".json"):
        tokenizer = Tokenizer.from_file(P.path(name))
        want = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=P.path(name))
        want = lambda t: len(model.encode(t))
    first = hostile.where("doc_id % 2 = 0")
    token_counts.count_tokens(first, P.path(name), tmp_dir).count()
    before = spark.read.parquet(tmp_dir).count()
    assert before == first.select("text").na.fill("").distinct().count()
    got = token_counts.count_tokens(hostile.withColumn("body", hostile["text"]), P.path(name), tmp_dir, limit=10)
    rows = got.collect()
    assert len(rows) == hostile.count()
    for r in rows:
        text = r["body"] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), want(text))
        assert r["over_limit"] == (r["n_tokens"] > 10)
    # only the texts that were missing were added, and a third run adds none
    stored = spark.read.parquet(tmp_dir).count()
    assert stored == hostile.select("text").na.fill("").distinct().count()
    token_counts.count_tokens(hostile, P.path(name), tmp_dir).count()
    assert spark.read.parquet(tmp_dir).count() == stored
    # counts come from the cache: what another run stored there is what is given
    tag = token_counts.version(P.path(name))
    other = f"{tmp_dir}-other"
    texts = hostile.select("text").na.fill("").distinct()
    texts.selectExpr("sha2(text, 256) AS content", "cast(7 AS long) AS n_tokens").write.parquet(f"{other}/version={tag}")
    texts.selectExpr("sha2(text, 256) AS content", "cast(9 AS long) AS n_tokens").write.parquet(f"{other}/version=old")
    assert {r["n_tokens"] for r in token_counts.count_tokens(hostile, P.path(name), other).collect()} == {7}


def test_counts_query(spark, documents):
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r["n_tokens"] for r in queries.op8_token_counts(spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: len(tokenizer.encode(r["text"] or "").ids) for r in documents.collect()}
    assert os.path.exists(P.path("byte_bpe_50k.json")) and np.all([n >= 0 for n in got.values()])
