"""Upserts: per key, some columns keep their first value and the others take the last."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom import schemas as S


def _split(columns: Sequence[str], keys: Sequence[str]) -> tuple[list[str], list[str]]:
    rest = [c for c in columns if c not in keys]
    return [c for c in rest if c in S.FIRST_WINS], [c for c in rest if c in S.LAST_WINS]


def loose_keys(keys: Sequence[str]) -> str:
    """Whether a row has a NULL in its key."""
    return " or ".join(f"{k} is null" for k in keys)


def latest_state(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    null_keys_distinct: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    """The table after upserting `rows` in `order`: one row per key, or one per key within each group of rows.

    One shuffle on the key. Each task first reduces its own rows, so a key with very many rows
    sends one row per task. As in a unique index, rows with a NULL in the key can be kept apart.
    """
    first, last = _split(S.SINK_COLUMNS, keys)
    position = F.struct(*order)
    group = [F.col(k) for k in (*within, *keys)]
    if null_keys_distinct:
        any_null = reduce(or_, [F.col(k).isNull() for k in keys])
        group.append(F.when(any_null, position).alias("_apart"))
    reduced = rows.groupBy(*group).agg(
        *([F.min_by(F.struct(*first), position).alias("_first")] if first else []),
        F.max_by(F.struct(*last), position).alias("_last"),
    )
    source = {c: f"_first.{c}" for c in first} | {c: f"_last.{c}" for c in last}
    return reduced.select(*within, *[F.col(source.get(c, c)).alias(c) for c in S.SINK_COLUMNS])


def merge_snapshot(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], null_keys_distinct: bool = False
) -> DataFrame:
    """Upsert `changes` (one row per key, see `latest_state`) into `current`.

    With `current` a table bucketed and sorted by the key, only the changes are shuffled. Rows with
    a NULL in the key match nothing; kept apart, they stay out of the join, where all of them would
    meet in one task.
    """
    if null_keys_distinct:
        loose = loose_keys(keys)
        merged = _merge(current.where(f"not ({loose})"), changes.where(f"not ({loose})"), keys)
        apart = [side.where(loose).select(*S.SINK_COLUMNS) for side in (current, changes)]
        return merged.unionAll(apart[0]).unionAll(apart[1])
    return _merge(current, changes, keys)


def _merge(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    first, _ = _split(S.SINK_COLUMNS, keys)
    # A marker is NULL where its side has no row for the key.
    old = current.withColumn("_old", F.lit(True)).alias("old")
    new = changes.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full")

    def pick(c: str):
        keep_old = F.col("_old").isNotNull() if c in first or c in keys else F.col("_new").isNull()
        return F.when(keep_old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c)

    return joined.select(*[pick(c) for c in S.SINK_COLUMNS])
