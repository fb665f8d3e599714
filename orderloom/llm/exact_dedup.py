"""Exact duplicates by a split into heavy and other digests.

A Misra-Gries summary finds the digests that many rows share: `approx_top_k` is Spark's mergeable form
of it, kept here for each of `BUCKETS` ranges of digests, so that each map task sends a bounded number
of counters and no single task merges all of them. What it names is only a candidate. The
candidates' rows are counted exactly, which partial sums do before the shuffle, and those that hold at
least a thousandth of all rows win. At most a thousand digests can, so broadcasting them is safe; their
rows are settled where they lie and never shuffled. The other digests are shuffled as usual: partial sums by digest, of
which those with two rows or more are written and joined back, by broadcast if they are measured to be few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import boxed, lower_ascii, picked, small_enough, unboxed, written

BUCKETS = 64
COUNTERS = 128
HEAVY_SHARE = 1000
BROADCAST_BYTES = 32 * 1024 * 1024


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and the SHA-256 of the normalised text."""
    return picked(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.sha2(lower_ascii(F.col("text")), 256).alias("text_sha256")
    )


def frequent_digests(keyed: DataFrame, buckets: int = BUCKETS, counters: int = COUNTERS) -> DataFrame:
    """Candidates as 64-bit keys, at most `buckets * counters` of them."""
    key = F.xxhash64("text_sha256")
    return (
        keyed.select(key.alias("key"))
        .groupBy(F.pmod("key", F.lit(buckets)).alias("bucket"))
        .agg(F.expr(f"approx_top_k(key, {counters}, {4 * counters})").alias("top"))
        .select(F.explode("top").alias("top"))
        .select(F.col("top.item").alias("key"))
    )


def heavy_groups(keyed: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """Digest, size and largest id of the groups that hold at least 1/share of the rows."""
    rows = keyed.count()
    candidates = frequent_digests(keyed)
    return (
        keyed.withColumn("key", F.xxhash64("text_sha256"))
        .join(F.broadcast(candidates), "key", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where((F.col("group_size") >= 2) & (F.col("group_size") * share >= F.lit(rows)))
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after lower-casing A-Z; a null counts as empty. The row with
    the largest id of a group stays. A null id never stays beside one that is not null; in a group of
    null ids alone, `keep_id` is null and all stay. Rows repeated with id and text are the same
    document: all count for `group_size` and all are marked alike. An empty table gives an empty result.
    """
    keyed = written(digests(docs, id_col, text_col), "digests")
    heavy = written(heavy_groups(keyed), "heavy-digests")
    result = ["doc_id", "keep_id", "group_size", "text_sha256"]
    settled = keyed.join(F.broadcast(heavy), "text_sha256").select(*result)
    rest = keyed.join(F.broadcast(heavy), "text_sha256", "left_anti")
    groups = rest.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = small_enough(written(groups.where("group_size > 1"), "groups"), 128, BROADCAST_BYTES)
    # A digest without a group is one row's own.
    others = rest.join(groups, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        "text_sha256",
    )
    return settled.unionByName(others).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col).where("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), "text_sha256").distinct()
    own = F.sha2(lower_ascii(F.col("text")), 256).alias("own")
    rows = boxed(docs, doc_id=id_col, text=text_col).select("row", "doc_id", own)
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("own") == F.col("text_sha256"))
    return unboxed(rows.join(kept, same, "left_semi"), docs)
