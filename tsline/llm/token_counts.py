"""Token counts through a digest cache.

Texts are keyed by the digest of their content and the digest of the tokenizer
file. Counts already stored are joined; only distinct texts without one are
encoded, and their counts are appended to the cache, a Parquet folder with a
subfolder for each tokenizer, of which only the one in use is read. Missing counts
are made and stored when ``count_tokens`` is called, not when its result is read.

Defined cases: null counts as empty (0 bytes; the count the tokenizer gives the
empty text); normalising is only that, since any other change could alter the
count; repeated texts are encoded once; a text that reached the cache twice
through concurrent writers is read once; strings of special tokens inside texts
are handled as the library does by default; begin, end and other special tokens
are not added; an empty table gives an empty result and appends nothing; columns
of the input named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.llm.bpe import PieceEncoder, safe_cuts
from tsline.llm.shared import bounded, fresh, require, slices, text_buffer, write_scratch

LIMIT = 1024
CACHE_SCHEMA = "content string, n_tokens long"


def version(tokenizer_file: str) -> str:
    """Digest of the library that reads the file and of its content."""
    with open(tokenizer_file, "rb") as f:
        kind = os.path.splitext(tokenizer_file)[1].encode()
        return hashlib.sha256(kind + b"\0" + f.read()).hexdigest()


def _cuts_are_safe(spec: dict) -> bool:
    """Whether pieces cut before single spaces are encoded as in their text."""
    pre = spec.get("pre_tokenizer") or {}
    plain = not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
    byte_level = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                  and not pre.get("add_prefix_space"))
    added = all(" " not in t["content"] and not (t["lstrip"] or t["rstrip"] or t["single_word"])
                for t in spec.get("added_tokens") or [])
    return plain and byte_level and added


def _counter(kind: str, blob: bytes):
    """A function from a string column to the number of tokens of each row."""
    if kind == ".model":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        return lambda column: np.array(
            [len(model.encode(x or "", num_threads=1)) for x in column.to_pylist()], np.int64)
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(blob.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    by_piece = _cuts_are_safe(json.loads(blob))
    encoder = PieceEncoder(tokenizer, joined=by_piece)

    def count(column: pa.Array) -> np.ndarray:
        data, offsets = text_buffer(column)
        cuts = safe_cuts(data, offsets) if by_piece else offsets[:-1]
        if not len(cuts):
            return np.zeros(len(column), np.int64)
        bounds = np.append(cuts, len(data))
        pieces = slices(data, bounds, pa.large_string()).dictionary_encode()
        sizes = np.diff(np.asarray(encoder(pieces.dictionary).offsets))
        ends = np.concatenate([[0], np.cumsum(sizes[np.asarray(pieces.indices)])])
        if not by_piece:
            return np.diff(ends)
        return np.diff(ends[np.searchsorted(bounds, offsets)])

    return count


def read_cache(spark: SparkSession, cache: str, tag: str) -> DataFrame:
    """``(content, n_tokens)`` stored for one tokenizer; empty where nothing was stored yet."""
    own = _folder(cache, tag)
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    stored = (spark.read.schema(CACHE_SCHEMA).parquet(own) if there
              else spark.createDataFrame([], CACHE_SCHEMA))
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _folder(cache: str, tag: str) -> str:
    return f"{cache.rstrip('/')}/version={tag}"


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: str, text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` in place of the text.

    Digests alone decide which texts are missing; only the missing ones' texts
    are shuffled, once, by digest, and copies are dropped before that shuffle.
    A job that fails commits nothing to the cache.
    """
    require(docs, text)
    spark = docs.sparkSession
    tag, kind = version(tokenizer_file), os.path.splitext(tokenizer_file)[1]
    with open(tokenizer_file, "rb") as f:
        blob = spark.sparkContext.broadcast(f.read())
    full = F.coalesce(F.col(text), F.lit(""))
    own, = fresh(docs, "content")
    keyed = docs.withColumn(own, F.sha2(full, 256))
    texts = keyed.select(F.col(own).alias("content"), full.alias("text"))
    missing = write_scratch(texts.select("content").distinct().join(
        read_cache(spark, cache, tag), "content", "left_anti"), "missing-counts")
    todo = texts.join(missing, "content", "left_semi").dropDuplicates(["content"])

    def run(batches):
        count = _counter(kind, blob.value)
        for batch in bounded(batches, 1):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(count(batch.column(1)), pa.int64())], names=["content", "n_tokens"])

    todo.mapInArrow(run, CACHE_SCHEMA).write.mode("append").parquet(_folder(cache, tag))
    # written, so that the rows of a hot text can be split over the tasks of the join
    counts = write_scratch(read_cache(spark, cache, tag), "token-counts").withColumnRenamed("content", own)
    return (keyed.drop("n_tokens").withColumn("n_bytes", F.octet_length(full).cast("long")).drop(text)
            .join(counts, own).drop(own)
            .withColumn("over_limit", F.col("n_tokens") > limit))
