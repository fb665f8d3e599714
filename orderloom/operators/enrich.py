"""Lookups on order headers or lines.

A lookup measured to be small is broadcast. A large one lies in buckets by its key, so that only the rows are shuffled.
The rows of its hot keys, of which there are few, find their values in a broadcast of these keys alone and are dealt out
evenly in the shuffle, which they go through without looking for a match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.config import JobConfig
from orderloom.operators.dimensions import Lookup
from orderloom.session import fresh_dir

SHARES = JobConfig().lookup_shares
# Keys a sketch of frequent ones keeps track of, as a multiple of the shares, and where rows of hot keys go.
TRACKED = 8
SPREAD = 4096


def _sketch(key: str, shares: int) -> Column:
    """The most frequent keys, with counts that are off by half a share at most. Sketches of parts of the rows are merged, so
    a task sends a bounded one."""
    return F.expr(f"approx_top_k({key}, {shares}, {shares * TRACKED})").alias(key)


def kept_with_hot_keys(df: DataFrame, keys: list[str], shares: int) -> tuple[DataFrame, dict[str, list[str]]]:
    """The rows, written once, and for each key column its hot keys: those with more than one part in `shares` of the rows.
    They are found while the rows are written, and there are fewer than `shares` of them."""
    spark, seen = df.sparkSession, Observation()
    path = fresh_dir(spark, "kept")
    df.observe(seen, F.count(F.lit(1)).alias("_rows"), *[_sketch(k, shares) for k in keys]).write.parquet(path)
    found = seen.get
    hot = {
        k: [top["item"] for top in found[k] or [] if top["item"] is not None and top["count"] * shares > found["_rows"]]
        for k in keys
    }
    return spark.read.schema(df.schema).parquet(path), hot


def _shuffled_join(df: DataFrame, found: DataFrame, key: str, hot: list[str]) -> DataFrame:
    """Left join by shuffle that bears keys with very many rows."""
    atomic = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "bigint", "int")]
    settled = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    spread = F.concat(F.lit("-"), F.pmod(F.xxhash64(*atomic), F.lit(SPREAD)).cast("string"))
    if hot:
        few = found.where(F.col("_key").isin(hot)).select(F.col("_key").alias("_hot_key"), F.col("_found").alias("_hot"))
        df = df.join(F.broadcast(few), df[key] == few["_hot_key"], "left").drop("_hot_key")
    else:
        df = df.withColumn("_hot", F.lit(None).cast("string"))
    probe = df.withColumn("_settled", settled).withColumn("_probe", F.when(F.col("_settled"), spread).otherwise(F.col(key)))
    match = (F.col("_probe") == F.col("_key")) & ~F.col("_settled")
    joined = probe.join(found.hint("merge"), match, "left")
    return joined.withColumn("_found", F.coalesce("_hot", "_found"))


def lookup_overwrite(
    df: DataFrame, lookup: Lookup, key: str, target: str, hot: list[str] | None = None, shares: int = SHARES
) -> DataFrame:
    """Set `target` to the value found for `key`; rows without a match keep theirs. For a large lookup the rows are kept and
    its hot keys found, unless they are given."""
    if not lookup.small and hot is None:
        df, found_hot = kept_with_hot_keys(df, [key], shares)
        hot = found_hot[key]
    found = lookup.rows.selectExpr(f"{lookup.key} as _key", f"{lookup.value} as _found")
    if lookup.small:
        joined = df.join(F.broadcast(found), df[key] == found["_key"], "left")
    else:
        joined = _shuffled_join(df, found, key, hot)
    columns = [f"coalesce(_found, {c}) as {c}" if c == target else c for c in df.columns]
    return joined.selectExpr(*columns)


def store_lookup(df: DataFrame, store: Lookup, hot: list[str] | None = None, shares: int = SHARES) -> DataFrame:
    """The brand's official store replaces the message's shop name."""
    return lookup_overwrite(df, store, "brand_id", "shop_name", hot, shares)


def marketplace_lookup(
    df: DataFrame,
    marketplace: Lookup,
    null_text: str | None = "null",
    hot: list[str] | None = None,
    shares: int = SHARES,
) -> DataFrame:
    """Adds the marketplace of the channel code, `null_text` for a code not found."""
    blank = df.withColumn("marketplace", F.lit(null_text).cast("string"))
    return lookup_overwrite(blank, marketplace, "channel_code", "marketplace", hot, shares)


def enrich(df: DataFrame, store: Lookup, marketplace: Lookup, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Both lookups. If either is large, the rows are written once, and the hot keys of both counted in passing."""
    hot: dict[str, list[str]] = {}
    large = [key for key, lookup in (("brand_id", store), ("channel_code", marketplace)) if not lookup.small]
    if large and not df.isStreaming:  # the rows of a stream cannot be counted first
        df, hot = kept_with_hot_keys(df, large, cfg.lookup_shares)
    named = store_lookup(df, store, hot.get("brand_id", []))
    return marketplace_lookup(named, marketplace, cfg.null_text, hot.get("channel_code", []))
