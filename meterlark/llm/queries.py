"""The registered queries of the operators, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark.llm import bpe, decontam, embeddings, html, licenses, minhash, prefixtrie, quality, sharding, tokenfiles, toxicity, vectorcodes, warc
from meterlark.llm.common import table

#: The vocabulary file; its place is a parameter of every operator that reads it.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: The id that ends each document in token files.
END_ID = 2
#: Shards into which documents are dealt.
SHARDS = 24


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(warc.with_revisits(table(spark, sf_dir, "pages")))
    records = warc.read(spark, files, payload=False, verify=True)
    return records.select(
        warc.page_id("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(quality.fold() == 0, F.lit(False))
    rows = quality.training_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    scored = quality.with_scores(rows, quality.fit(rows))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "content_margin", "meta_margin", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    train = toxicity.labelled(docs, table(spark, sf_dir, "labels"), "toxic").where(toxicity.fold() != 0)
    scored = toxicity.score(docs, toxicity.fit(train, pairs=True))
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, WORD_BPE, lexicon=bpe.fit_lexicon(docs, WORD_BPE))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfiles.write(table(spark, sf_dir, "documents"), WORD_BPE, END_ID)
    return tokenfiles.read(spark, files, digests=True)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.rebuilt_prefixes(table(spark, sf_dir, "conversations"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_warc": op2_warc,
    "op3_embeddings": op3_embeddings,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_bpe_round_trip": op6_bpe_round_trip,
    "op7_licences": op7_licences,
    "op8_main_text": op8_main_text,
    "op9_decontamination": op9_decontamination,
    "op10_token_files": op10_token_files,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sharding": op12_sharding,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE_SQL: dict[str, str] = {"op7_licences": licenses.oracle_sql()}
