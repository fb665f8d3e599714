"""Documents to sharded training text: five stages, each over all that the one before kept.

Every stage but the last returns the columns of documents. A stage's rows are written as Parquet and read again
as the next one's input, so a lost executor costs no earlier stage.

The language model learns from the documents it is given; the held-out quarter is never learned from. It rejects
documents without a letter, and those whose language it cannot tell: the closest of its duels is all but a toss-up
(`langid.TOSS_UP`). Near duplicates keep the document with the smallest id of each class. A
document that benchmark passages make up by a twentieth or more is removed. Mixing repeats or drops documents
by their fitted rate; toxic ones are thinned out to a sixteenth of the clean tokens, never repeated, and not all dropped. The last stage adds `slot` and `shard`.

Null texts and texts without a letter leave in the first stage; without a lang to learn from, only these. Null ids take part in every stage; further
columns are carried along. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import bagminhash, decontam, langid, mixing, sharding
from orderloom.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.languages_kept(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

# Learned models decide in the stages language and mixture.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
