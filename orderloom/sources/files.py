"""Logs of order lines as parquet folders whose batches come into sight at once.

A batch is written to a folder of its own for each attempt, `batch_id=N/attempt=A`, and counts from the moment its
commit record stands in `_commits`: a small file per batch that names the attempt and the outputs it has
written. Readers ask the records which folders to read, so they never meet a half-written batch, an attempt that
failed, or one output of a batch without the others. A batch that is committed is not written again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.session import any_path, put_text

LINES, REJECTS = "lines", "rejects"


def append_lines(lines: DataFrame) -> DataFrame:
    """The columns of the append-only table."""
    return lines.select(*S.APPEND_COLUMNS)


def write_append(lines: DataFrame, path: str, run: int | None = None) -> None:
    """Add the lines to the append-only table. Appends that have a number are kept as a log, see `read_log`, in which
    the same append counts once however often it is made; without a number the rows are added to a plain folder."""
    if run is None:
        append_lines(lines).write.mode("append").parquet(path)
    else:
        write_batch(append_lines(lines), path, run)


def new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"


def attempt_path(path: str, batch_id: int, attempt: str) -> str:
    return f"{path}/batch_id={batch_id}/attempt={attempt}"


def _record_path(path: str, batch_id: int) -> str:
    return f"{path}/_commits/{batch_id:012d}.json"


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    return any_path(spark, _record_path(path, batch_id))


def commit(spark: SparkSession, path: str, batch_id: int, attempt: str, outputs: tuple[str, ...] = (LINES,)) -> None:
    """Bring an attempt's outputs into sight, all at once."""
    record = {"batch_id": batch_id, "attempt": attempt, "outputs": list(outputs)}
    put_text(spark, _record_path(path, batch_id), json.dumps(record))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch with one output and commit it. A batch run again changes nothing."""
    if not is_committed(rows.sparkSession, path, batch_id):
        attempt = new_attempt()
        rows.write.parquet(attempt_path(path, batch_id, attempt))
        commit(rows.sparkSession, path, batch_id, attempt)


def committed(spark: SparkSession, path: str, output: str = LINES) -> dict[int, str]:
    """The committed batches that have the output, and their attempts: a row for each batch."""
    if not any_path(spark, f"{path}/_commits/*.json"):
        return {}
    records = spark.read.schema("batch_id long, attempt string, outputs array<string>").json(f"{path}/_commits/*.json")
    rows = records.where(F.array_contains("outputs", output)).orderBy("batch_id").collect()
    return {r["batch_id"]: r["attempt"] for r in rows}


def read_log(
    spark: SparkSession,
    path: str,
    after: int | None = None,
    upto: int | None = None,
    commits: str | None = None,
    output: str = LINES,
) -> DataFrame:
    """The committed batches of a log, with `batch_id` as a column: those after one and up to and with another, of which
    alone the files are listed. `commits` is the folder of the records, if it is another one."""
    found = committed(spark, commits or path, output)
    if not found:
        raise ValueError(f"{commits or path} has no committed batch")
    wanted = {
        b: a for b, a in found.items() if (after is None or b > after) and (upto is None or b <= upto)
    }
    # Without a batch in the range, one is read for its columns.
    shown = wanted or dict(list(found.items())[-1:])
    paths = [attempt_path(path, b, a) for b, a in shown.items()]
    rows = spark.read.option("basePath", path).parquet(*paths).drop("attempt")
    rows = rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows if wanted else rows.where("false")
