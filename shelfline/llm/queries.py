"""The registered query of each operator, with production parameters over its whole table, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    bpe, decontaminate, embed_dedup, licenses, line_dedup, near_dedup, pii, prefix_trie, quality, suffix_dedup,
    token_counts, url_filter, whitening)
from shelfline.llm.common import table

BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.summarise(licenses.scan(table(spark, sf, "documents")))


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf, "documents"), BPE_FILE)


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf, "documents"))


def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = line_dedup.drop_repeats(table(spark, sf, "documents"))
    return done.select("row.doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("cleaned", F.lit("")), 256).alias("cleaned_sha256"))


def op6_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.summarise(pii.find_spans(table(spark, sf, "documents")))


def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embed_dedup.near_groups(table(spark, sf, "embeddings"))


def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"), PIECE_FILE)


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf, "labels")))


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf, "pages"), URL_RULES)


def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    # a deviation that is no long is an error, not another number
    return whitening.whiten(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.build(table(spark, sf, "conversations"))


def op13_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.summarise(suffix_dedup.drop_repeats(table(spark, sf, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in (
        op1_licenses, op2_bpe, op3_decontamination, op4_near_dedup, op5_line_dedup, op6_pii, op7_embedding_dedup,
        op8_token_counts, op9_quality, op10_url_filter, op11_embedding_whitening, op12_prefix_trie,
        op13_suffix_dedup)}


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": licenses.ORACLE_SQL, "op4_near_dedup": near_dedup.ORACLE_SQL,
            "op5_line_dedup": line_dedup.ORACLE_SQL, "op7_embedding_dedup": embed_dedup.ORACLE_SQL,
            "op12_prefix_trie": prefix_trie.ORACLE_SQL}
