"""From raw documents to an encoded, mixed corpus: stages that each apply one text operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsline.llm import bpe, line_dedup, mixing, ngram_join, quality
from tsline.llm.shared import write_scratch
from tsline.suite.registry import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = quality.score(docs, model).where("predicted = 1")
    return kept.select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; ``n_chars`` follows the text."""
    cleaned = line_dedup.drop_boilerplate(docs, host="source")
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, one stays."""
    return ngram_join.one_of_each(docs, k=5, num=80, den=100).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mix(docs).select(*docs.columns)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that decoding them gives."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    kept = [c for c in docs.columns if c != "text"]
    # written between, so that a task has one Python worker at a time
    encoded = write_scratch(bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=kept), "encoded")
    decoded = bpe.decode(encoded, ranks, as_text=True).withColumnRenamed("decoded", "text")
    return decoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality classifier", keep_quality), ("line dedup", drop_lines),
          ("n-gram Jaccard join", drop_near_copies), ("mixing sources", mix_sources),
          ("byte-level BPE", encode_text)]

#: Training and set similarity have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_scratch(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
