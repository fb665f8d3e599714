"""What several operators share: reading a table, normalising text, scratch tables.

Operators take any table with an id and a text column and pick these two out under their own names, or put all columns
into one, so further columns, whatever they are called, neither clash nor change.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.fixtures import table as table
from orderloom.session import fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Separators of words made of ASCII letters, ASCII digits and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """The lower-cased words. Splitting is linear in the text, which listing matches is not."""
    return F.filter(F.split(lower_ascii(text), SEPARATORS), lambda w: w != "")


def _place(docs: DataFrame, name: str) -> int:
    """Where a column stands: the one of just this name, or else the only one of this name in any case."""
    if name in docs.columns:
        return docs.columns.index(name)
    alike = [i for i, c in enumerate(docs.columns) if c.lower() == name.lower()]
    if len(alike) != 1:
        raise ValueError(f"{len(alike)} columns are called {name}")
    return alike[0]


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])


def picked(docs: DataFrame, **columns: str) -> DataFrame:
    """Only these of the caller's columns, under the names of the arguments."""
    own = _numbered(docs)
    return own.select(*[F.col(f"_{_place(docs, c)}").alias(name) for name, c in columns.items()])


def boxed(docs: DataFrame, **columns: str) -> DataFrame:
    """All of the caller's columns as one, `row`, so that no name of theirs meets one of ours; and some under names of
    ours beside it. See `unboxed`."""
    own = _numbered(docs)
    some = [F.col(f"_{_place(docs, c)}").alias(name) for name, c in columns.items()]
    return own.select(F.struct(*own.columns).alias("row"), *some)


def unboxed(rows: DataFrame, docs: DataFrame, *more: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The caller's columns as they were, and more columns behind them. `without`: names, in any case, to leave out."""
    kept = [i for i, c in enumerate(docs.columns) if c.lower() not in without]
    out = rows.select(*[F.col(f"row._{i}").alias(f"_{i}") for i in kept], *more)
    return out.toDF(*[docs.columns[i] for i in kept], *more)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder. What reads it survives the loss of executors
    and does not repeat the work behind it."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_unit(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11)) / F.lit(float(1 << 53))


def small_enough(df: DataFrame, row_bytes: Column | int, limit: int) -> DataFrame:
    """The table, to be broadcast if it was measured to be within the limit."""
    size = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).head()[0] or 0
    return F.broadcast(df) if size <= limit else df


def scratch(spark: SparkSession, name: str) -> str:
    """A path for files in the shared folder."""
    return fresh_dir(spark, name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python reads operators from it, and it may not
    be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="orderloom-code-"), "orderloom")
        archive = shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
