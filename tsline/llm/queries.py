"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tsline.llm import (bitslice_search, bpe, chat, exact_dedup, line_dedup, mixing, ngram_join, quality, shards, sketch,
                        suffix_dedup, token_counts, whitening)
from tsline.session import scratch_path
from tsline.suite.registry import table

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM s),
w AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             source_size * 2.0::DOUBLE AS cap FROM r),
o AS (SELECT *, cap / w AS ratio FROM w),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
                / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS level
      FROM o),
f AS (SELECT arg_min(level, rn) AS level FROM (SELECT level, ratio, row_number() OVER (ORDER BY ratio, rk) AS rn FROM l)
      WHERE level <= ratio),
t AS (SELECT source, source_size, least(cap, coalesce(f.level * w, cap)) AS target FROM l, f),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
             CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':mix'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM c"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP7_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "source", "n_lines", "n_dropped", "text")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
k AS (SELECT source, unnest(list_distinct(list_transform(ls, lambda x: trim(x, ' ' || chr(9) || chr(13))))) AS line FROM d),
c AS (SELECT source, line, count(*) AS pages FROM k WHERE line <> '' GROUP BY source, line HAVING count(*) >= 3),
n AS (SELECT source, count(*) AS total FROM d GROUP BY source),
b AS (SELECT c.source, list(c.line) AS bad FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source
      WHERE CAST(pages AS DOUBLE) / total > 0.01 GROUP BY c.source),
j AS (SELECT d.*, CASE WHEN b.bad IS NULL THEN ls ELSE
             list_filter(ls, lambda x: NOT list_contains(b.bad, trim(x, ' ' || chr(9) || chr(13)))) END AS kept
      FROM d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(ls), 0) - coalesce(len(kept), 0) AS BIGINT) AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text
FROM j"""


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_string("sketch").alias("fingerprint"),
        sketch.as_string("edited_sketch").alias("edited_fingerprint"),
        sketch.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        sketch.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.ngram_groups(table(spark, sf_dir, "documents"), k=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql("SELECT -7L AS conv_id, id AS turn, if(id = 0, 'user', 'assistant') AS role FROM range(2)")
    rows = rows.unionByName(extra.withColumn("text", F.lit(text)))
    formatted = chat.format_paths(chat.choose_paths(chat.nodes_from_turns(rows)))
    return chat.read_back(formatted).withColumnRenamed("tree", "conv_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=["doc_id"])
    return bpe.decode(encoded, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cache, tokenizer = scratch_path(spark, "token-cache"), public_tokenizers.path("byte_bpe_50k.json")
    token_counts.count_tokens(docs, tokenizer, cache)  # all counts are stored here ...
    counted = token_counts.count_tokens(docs, tokenizer, cache)  # ... and come from the cache here
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = bitslice_search.build_index(table(spark, sf_dir, "documents"))
    return bitslice_search.search(index, table(spark, sf_dir, "benchmark"), limit=50)


OP11_SQL = r"""
WITH x AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms,
                  row_number() OVER () AS row FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS total FROM x WHERE len(terms) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
e AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM x),
f AS (SELECT row, doc_id, n, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
r AS (SELECT item_id, doc_id, row,
             sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // total)))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id, row),
o AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
      FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50"""


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", "n_chars", (F.length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"))
    dealt = shards.curve_shards(docs, ["source", "lang", "n_chars"], 24, order=["doc_id", "text_crc32", "size"],
                                keep=["doc_id", "size", "text_crc32"])
    return dealt.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_ngram_join": op1_ngram_join, "op2_quality": op2_quality, "op3_chat": op3_chat,
           "op4_suffix_dedup": op4_suffix_dedup, "op5_bpe": op5_bpe, "op6_mixing": op6_mixing,
           "op7_exact_dedup": op7_exact_dedup, "op8_token_counts": op8_token_counts,
           "op9_line_dedup": op9_line_dedup, "op10_fingerprints": op10_fingerprints,
           "op11_ranked_search": op11_ranked_search, "op12_hilbert_shards": op12_hilbert_shards,
           "op13_whitening": op13_whitening}
ORACLES = {"op6_mixing": OP6_SQL, "op7_exact_dedup": OP7_SQL, "op9_line_dedup": OP9_SQL,
           "op11_ranked_search": OP11_SQL}
