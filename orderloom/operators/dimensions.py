"""The two lookup tables, computed from the channel table.

A channel row reads `channel_code = <brand>_<marketplace code>`,
`channel_name = <marketplace>-<store>`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.text import (
    after_last, before_first, clean_store_name, excluded_channel, official_store,
)
from orderloom.session import drop_dir, ensure_checkpoint_dir, fresh_dir


def split_channels(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """Shop channels, split into their four parts; duplicates remain."""
    code, name = "channel_code", "channel_name"
    return channels.where(f"not {excluded_channel(code)}").selectExpr(
        f"{before_first(code, '_')} as channel_code",
        f"lower({after_last(code, '_')}) as mp_code",
        f"{official_store(code, name, case_insensitive)} as official_store",
        f"{before_first(name, '-')} as marketplace",
    )


def _folded(column: str) -> Column:
    """The text as a server compares it that pays no regard to case."""
    return F.collate(F.col(column), "UTF8_LCASE")


def oms_channel_clean(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """The distinct shop channels. Of rows that differ in case only, the first one bytewise stays."""
    parts = split_channels(channels, case_insensitive)
    if not case_insensitive:
        return parts.distinct()
    same = [_folded(c).alias(f"folded_{c}") for c in parts.columns]
    return parts.groupBy(*same).agg(F.min(F.struct(*parts.columns)).alias("row")).select("row.*")


def _greatest(df: DataFrame, key: str, value: str, case_insensitive: bool, *kinds: str) -> DataFrame:
    """The greatest value per key (and kind). Partial maxima are taken before the one shuffle, so a key with
    very many rows costs no more than the others."""
    if not case_insensitive:
        return df.groupBy(*kinds, key).agg(F.max(value).alias(value))
    # Among names that differ in case only, the last one bytewise.
    top = F.max(F.struct(_folded(value).alias("folded"), F.col(value), F.col(key))).alias("top")
    folded = df.groupBy(*kinds, _folded(key).alias("folded_key")).agg(top)
    return folded.select(*kinds, f"top.{key}", f"top.{value}")


def _store_rows(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    return (
        split_channels(channels, case_insensitive)
        .where(F.col("official_store").isNotNull())
        .select(F.col("channel_code").alias("brand_id"), "official_store")
    )


def _marketplace_rows(channels: DataFrame) -> DataFrame:
    return split_channels(channels).where(F.col("mp_code").isNotNull()).select("mp_code", "marketplace")


def _cleaned(stores: DataFrame) -> DataFrame:
    """The choice among names is made on the raw name, so cleaning comes last."""
    return stores.withColumn("official_store", F.expr(clean_store_name("official_store")))


def master_store(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """brand_id -> official_store, one row per brand."""
    return _cleaned(
        _greatest(_store_rows(channels, case_insensitive), "brand_id", "official_store", case_insensitive)
    )


def master_marketplace(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """mp_code -> marketplace, one row per code."""
    return _greatest(_marketplace_rows(channels), "mp_code", "marketplace", case_insensitive)


def _first_row(df: DataFrame, key: str, value: str, case_insensitive: bool = False) -> DataFrame:
    if case_insensitive:
        order = [F.desc_nulls_last("_folded"), F.desc_nulls_last(value), F.desc(key)]
        df = df.withColumn("_folded", _folded(value)).withColumn("_key", _folded(key))
        ranked = Window.partitionBy("_key").orderBy(*order)
    else:
        ranked = Window.partitionBy(key).orderBy(F.desc_nulls_last(value))
    return df.withColumn("row_num", F.row_number().over(ranked)).where("row_num = 1").select(key, value)


def master_store_windowed(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    """`master_store` with a ranking window, as a cross-check of the aggregate."""
    rows = _store_rows(channels, case_insensitive)
    return _cleaned(_first_row(rows, "brand_id", "official_store", case_insensitive))


def master_marketplace_windowed(channels: DataFrame, case_insensitive: bool = False) -> DataFrame:
    return _first_row(_marketplace_rows(channels), "mp_code", "marketplace", case_insensitive)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def dimension(df: DataFrame, key: str, value: str) -> DataFrame:
    """A checked two-column lookup table from any query result: unique keys, no NULLs. The query is run once; what is
    returned are the rows that were checked, kept by a checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    pairs = df.select(key, value).checkpoint()
    if not pairs.where(F.col(key).isNull() | F.col(value).isNull()).isEmpty():
        raise ValueError(f"lookup table has NULL in {key} or {value}")
    repeated = duplicate_keys(pairs, key).limit(5).collect()
    if repeated:
        raise ValueError(f"lookup table repeats keys, e.g. {[r[key] for r in repeated]}")
    return pairs


@dataclass(frozen=True)
class Lookup:
    """A lookup table, whether it was measured small enough to broadcast, and the folders of its rows."""

    rows: DataFrame
    key: str
    value: str
    small: bool
    paths: tuple[str, ...] = ()


# Memory a broadcast row takes beyond its text.
ROW_OVERHEAD_BYTES = 64


def _measured_bytes(key: str, value: str) -> Column:
    text = F.octet_length(key) + F.coalesce(F.octet_length(value), F.lit(0))
    return F.coalesce(F.sum(text + ROW_OVERHEAD_BYTES), F.lit(0))


STORE, MARKETPLACE = "store", "marketplace"


def _table_at(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def _store_by_key(rows: DataFrame, key: str, path: str) -> DataFrame:
    """The rows as a table bucketed by the key, which a join by shuffle reads as it lies."""
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    dealt.option("path", path).saveAsTable(_table_at(path))
    return spark.table(_table_at(path))


def channel_lookups(
    channels: DataFrame, broadcast_limit: int, case_insensitive: bool = False
) -> tuple[Lookup, Lookup]:
    """Store and marketplace lookups over a channel table.

    The table is read once: each channel gives a pair for either lookup, and one shuffle takes the greatest value
    per lookup and key, which makes keys unique. The result is written. What is measured,
    what is broadcast and both lookups are thus the same rows, whatever becomes of the table or of an
    executor. A lookup too large to broadcast is stored once more, in buckets by its key. A store has no NULL name; a
    marketplace may, and then counts as not found.
    """
    spark = channels.sparkSession
    pairs = split_channels(channels, case_insensitive).selectExpr(
        f"""inline(array(named_struct('kind', '{STORE}', 'key', channel_code, 'value', official_store),
            named_struct('kind', '{MARKETPLACE}', 'key', mp_code, 'value', marketplace)))"""
    )
    wanted = pairs.where(f"if(kind = '{STORE}', value is not null, key is not null)")
    best = _greatest(wanted, "key", "value", case_insensitive, "kind")
    shown = f"if(kind = '{STORE}', {clean_store_name('value')}, value)"
    path = fresh_dir(spark, "lookups")
    named = best.selectExpr("kind", "key", f"{shown} as value")
    named.write.parquet(path)
    kept = spark.read.schema(named.schema).parquet(path)
    bytes_of = {
        r["kind"]: r["bytes"]
        for r in kept.groupBy("kind").agg(_measured_bytes("key", "value").alias("bytes")).collect()
    }

    def lookup(kind: str, key: str, value: str) -> Lookup:
        rows = kept.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("value").alias(value))
        if bytes_of.get(kind, 0) <= broadcast_limit:
            return Lookup(rows, key, value, True, (path,))
        stored = fresh_dir(spark, "lookup")
        return Lookup(_store_by_key(rows, key, stored), key, value, False, (path, stored))

    return lookup(STORE, "brand_id", "official_store"), lookup(MARKETPLACE, "mp_code", "marketplace")


def fingerprint(channels: DataFrame) -> tuple[int, ...]:
    """Numbers that stand for the rows of a channel table, in whatever order: one scan, a row per task."""
    row = ("channel_code", "channel_name")
    each = [F.xxhash64(F.lit(seed), *[F.hex(c) for c in row], *[F.col(c).isNull() for c in row]) for seed in (1, 2)]
    sums = [F.sum(h.cast("decimal(38,0)")) for h in each]
    found = channels.agg(F.count(F.lit(1)), *sums, *[F.bit_xor(h) for h in each]).head()
    return tuple(int(x or 0) for x in found)


class LookupVersions:
    """The lookups of a channel table that is read again and again: made anew only if its rows have changed, the version
    before being removed. Whoever reads a version has to be done with it when the next one is asked for."""

    def __init__(self, broadcast_limit: int, case_insensitive: bool = False):
        self.settings = broadcast_limit, case_insensitive
        self.mark: tuple[int, ...] | None = None
        self.lookups: tuple[Lookup, Lookup] | None = None

    def of(self, channels: DataFrame) -> tuple[Lookup, Lookup]:
        mark = fingerprint(channels)
        if mark != self.mark:
            before, self.lookups = self.lookups, channel_lookups(channels, *self.settings)
            self.mark = mark
            if before is not None:
                self._remove(channels.sparkSession, before)
        return self.lookups

    @staticmethod
    def _remove(spark: SparkSession, lookups: tuple[Lookup, Lookup]) -> None:
        for path in {path for lookup in lookups for path in lookup.paths}:
            spark.sql(f"drop table if exists {_table_at(path)}")
            drop_dir(spark, path)
