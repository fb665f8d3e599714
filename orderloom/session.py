"""Where the session keeps files that all executors must reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# What a task reads at most where it sorts wide rows before a shuffle: a row of a column file is some twenty times wider
# in memory, so that 16 MB are several hundred MB there.
SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
FINE_SPLIT = 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local master without the setting."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix="orderloom-")
    raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def with_fine_splits(spark: SparkSession) -> SparkSession:
    """A session like this one that reads files in splits of `FINE_SPLIT` bytes at most; this one stays as it is."""
    fine = spark.newSession()
    known = fine.conf.getAll
    for name, value in spark.conf.getAll.items():
        if known.get(name) != value:  # set since the application began
            fine.conf.set(name, value)
    as_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if as_bytes(fine.conf.get(SPLIT_CONF)) > FINE_SPLIT:
        fine.conf.set(SPLIT_CONF, str(FINE_SPLIT))
    return fine


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def any_path(spark: SparkSession, pattern: str) -> bool:
    """Whether the pattern matches any path on whatever storage it names."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(target.getFileSystem(hadoop).globStatus(target))


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all: under another name first, then renamed."""
    aside, files = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = files.create(aside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    target, _ = _file_system(spark, path)
    if not files.rename(aside, target):
        raise OSError(f"cannot write {path}")


def get_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    target, files = _file_system(spark, path)
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def files_below(spark: SparkSession, path: str) -> dict[str, int]:
    """Paths, relative to the folder, and sizes of all files below it."""
    target, files = _file_system(spark, path)
    found, root = {}, files.makeQualified(target).toString().rstrip("/") + "/"
    listed = files.listFiles(target, True)
    while listed.hasNext():
        status = listed.next()
        found[status.getPath().toString().removeprefix(root)] = status.getLen()
    return found


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder this package has written and nobody reads any more."""
    target, files = _file_system(spark, path)
    files.delete(target, True)
