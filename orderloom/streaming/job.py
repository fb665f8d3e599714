"""The job on a stream. Every micro-batch runs the batch plan inside `foreachBatch`, so it gets
adaptive execution. Its lines and rejects come into sight together, by one commit record; a batch run again after
that changes nothing, and one that failed before leaves nothing that is read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.config import JdbcConfig, JobConfig
from orderloom.operators.dimensions import Lookup, LookupVersions, channel_lookups
from orderloom.operators.messages import classify_messages, order_headers, rejected, sound_headers
from orderloom.operators.upsert import latest_state
from orderloom.plans.order_lines import lines_of, to_sink
from orderloom.session import any_path, with_fine_splits
from orderloom.sources import jdbc
from orderloom.sources.files import (
    LINES, REJECTS, attempt_path, commit, committed, is_committed, new_attempt, read_log,
)
from orderloom.streaming.snapshots import MERGE_SHARE, Snapshot, fold, open_snapshot, state_rows

Reader = Callable[[SparkSession], DataFrame]

# What orders the lines of a log: batch, message, place in the message.
ORDER = ("batch_id", "message_seq", "message_row", "line_pos")
LOGGED = ("message_seq", "message_row", "line_pos")


__all__ = ["Snapshot", "Targets", "compact", "current_state", "open_snapshot", "read_rejects", "run_stream"]


@dataclass(frozen=True)
class Targets:
    """Where a run writes. All folders must be on storage shared by the cluster."""

    lines: str
    checkpoint: str
    rejects: str | None = None
    database: JdbcConfig | None = None


def _write(rows: DataFrame, path: str, batch_id: int, attempt: str) -> DataFrame:
    """The rows as written."""
    place = attempt_path(path, batch_id, attempt)
    rows.write.parquet(place)
    return rows.sparkSession.read.schema(rows.schema).parquet(place)


def _process(
    messages: DataFrame, batch_id: int, store: Lookup, marketplace: Lookup, targets: Targets, cfg: JobConfig
) -> None:
    spark, attempt = messages.sparkSession, new_attempt()
    if is_committed(spark, targets.lines, batch_id):
        return
    # Rows of one file or partition keep their order; the number tells them apart.
    numbered = messages.withColumn("message_row", F.monotonically_increasing_id())
    if cfg.on_error == "fail":
        headers, outputs = order_headers(numbered, cfg), (LINES,)
        lines = _write(to_sink(lines_of(headers, store, marketplace, cfg), extra=LOGGED), targets.lines, batch_id, attempt)
    else:
        outputs = (LINES, REJECTS)
        judged = classify_messages(numbered, cfg).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = to_sink(lines_of(sound_headers(judged), store, marketplace, cfg), extra=LOGGED)
            lines = _write(found, targets.lines, batch_id, attempt)
            _write(rejected(judged), targets.rejects, batch_id, attempt)
        finally:
            judged.unpersist()
    if targets.database is not None:
        # The database takes the batch as logged: same rows, same load time, no second parse. Should the batch fail
        # after this, the same keys are upserted again.
        jdbc.upsert(lines, targets.database, cfg.key_cols, LOGGED)
    commit(spark, targets.lines, batch_id, attempt, outputs)


def run_stream(
    spark: SparkSession,
    messages: Reader,
    channels: Reader,
    targets: Targets,
    cfg: JobConfig = JobConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the job. `trigger` takes the keywords of `DataStreamWriter.trigger`."""
    if cfg.on_error == "quarantine" and not targets.rejects:
        raise ValueError("quarantine needs a folder for rejects")
    if targets.database is not None and cfg.null_text is None:
        raise ValueError("a database needs a null_text: rows with NULL in the key cannot be upserted")
    for folder in filter(None, (targets.lines, targets.rejects)):
        if any_path(spark, f"{folder}/batch_id=*") and not any_path(spark, f"{targets.checkpoint}/*"):
            # Batch numbers would start again at 0 and replace the batches already there.
            raise ValueError(f"{folder} has batches of another run: use a new folder or its checkpoint")

    settings = cfg.broadcast_limit, cfg.case_insensitive
    frozen = channel_lookups(channels(spark), *settings) if cfg.refresh == "never" else None
    versions = LookupVersions(*settings)

    def process(batch: DataFrame, batch_id: int) -> None:
        _process(batch, batch_id, *(frozen or versions.of(channels(batch.sparkSession))), targets, cfg)

    return (
        messages(spark)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", targets.checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def read_rejects(spark: SparkSession, targets: Targets) -> DataFrame:
    """The messages set aside in committed batches."""
    return read_log(spark, targets.rejects, commits=targets.lines, output=REJECTS)


def current_state(
    spark: SparkSession, log: str, cfg: JobConfig = JobConfig(), snapshot: Snapshot | None = None
) -> DataFrame:
    """The upserted table: a snapshot, if there is one, with the batches after it, which alone are read from the log."""
    spark, apart = with_fine_splits(spark), cfg.null_text is None
    if snapshot is None:
        return latest_state(read_log(spark, log), cfg.key_cols, ORDER, apart)
    later = read_log(spark, log, after=snapshot.upto)
    return state_rows(spark, snapshot, latest_state(later, cfg.key_cols, ORDER, apart), cfg)


def compact(
    spark: SparkSession,
    log: str,
    upto: int,
    folder: str,
    snapshot: Snapshot | None = None,
    cfg: JobConfig = JobConfig(),
    buckets: int = 64,
    merge_share: float = MERGE_SHARE,
) -> Snapshot:
    """Fold the batches after a snapshot, up to and with `upto`, into a new one.

    The old one is untouched; once the new one is in use, the batches it holds may go from the log. The first
    snapshot settles the number of buckets: so many that one fits a task.
    """
    first = -1 if snapshot is None else snapshot.upto
    if upto <= first:
        raise ValueError(f"the snapshot holds batch {first} already")
    if upto not in committed(spark, log):
        raise ValueError(f"{log} has no committed batch {upto}")
    spark = with_fine_splits(spark)
    span = read_log(spark, log, after=first, upto=upto)
    changes = latest_state(span, cfg.key_cols, ORDER, cfg.null_text is None)
    return fold(spark, changes, upto, folder, snapshot, cfg, buckets, merge_share)
