"""The whole job as one function of two tables; batch and streaming use it alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.config import JobConfig
from orderloom.functions.times import load_ts
from orderloom.operators.dimensions import Lookup, channel_lookups
from orderloom.operators.enrich import enrich
from orderloom.operators.messages import (
    classify_messages, explode_lines, order_headers, rejected, sound_headers,
)
from orderloom.session import ensure_checkpoint_dir


def to_sink(lines: DataFrame, loaded: Column | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """The target table's columns, in its order and types, after any `extra` ones. `loaded` replaces the load time."""
    columns = [f"cast({c} as {t}) as {c}" for c, t in S.SINK_TYPES.items()]
    stamped = lines if loaded is None else lines.withColumn("load_timestamp", loaded)
    return stamped.selectExpr(*extra, *columns)


def lines_of(headers: DataFrame, store: Lookup, marketplace: Lookup, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Enriched lines. The lookups use header columns only, so they run before the explode: once
    per order, and with far fewer rows to move should a lookup be too large to broadcast. The load time is taken there
    too, so the lines of a message share it."""
    timed = headers.withColumn("load_timestamp", F.expr(load_ts()))
    return explode_lines(enrich(timed, store, marketplace, cfg), cfg)


def build(
    messages: DataFrame,
    channels: DataFrame,
    cfg: JobConfig = JobConfig(),
    loaded: Column | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Messages and channels to rows of the target table. Malformed messages stop the query; with
    `on_error="quarantine"` they are left out, and `build_with_rejects` returns them as well."""
    store, marketplace = channel_lookups(channels, cfg.broadcast_limit, cfg.case_insensitive)
    return to_sink(lines_of(order_headers(messages, cfg), store, marketplace, cfg), loaded, extra)


def build_with_rejects(
    messages: DataFrame,
    channels: DataFrame,
    cfg: JobConfig = JobConfig(on_error="quarantine"),
    loaded: Column | None = None,
    extra: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Rows of the target table, and the malformed messages with their text and `error_reason`.

    The messages are read once; the reading is kept by a checkpoint, so the two results belong together.
    """
    ensure_checkpoint_dir(messages.sparkSession)
    judged = classify_messages(messages, cfg).checkpoint()
    store, marketplace = channel_lookups(channels, cfg.broadcast_limit, cfg.case_insensitive)
    return to_sink(lines_of(sound_headers(judged), store, marketplace, cfg), loaded, extra), rejected(judged)
