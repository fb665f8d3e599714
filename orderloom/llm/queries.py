"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    bagminhash,
    decontam,
    exact_dedup,
    langid,
    lemp,
    license_scan,
    merkle,
    mixing,
    pii,
    recompression,
    sharding,
    token_counts,
    warc_zip,
)
from orderloom.llm.common import picked, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitised(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, k)) for k in pii.KINDS]
    counts = [(F.size("base") - n).cast("bigint").alias(f"n_{k}") for k, n in zip(pii.KINDS, counts, strict=True)]
    base = F.sha2(pii.span_text(F.col("base")), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.round_trip(spark, table(spark, sf_dir, "pages")).drop("url")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = langid.predictions(picked(docs, doc_id="doc_id", text="text"), F.col("text"), langid.fit(docs))
    return told.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_groups(table(spark, sf_dir, "documents")).drop("node")


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return merkle.verified(docs, tampered=number % 5 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_sharding": op2_sharding,
    "op3_mixing": op3_mixing,
    "op4_pii": op4_pii,
    "op5_licenses": op5_licenses,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language": op9_language,
    "op10_near_dedup": op10_near_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_ranked_search": op12_ranked_search,
    "op13_merkle": op13_merkle,
}
