"""The upserted table between runs: a base in buckets by the key, small deltas over it, and a manifest that names them.

`compact` folds further batches of a log in. Their rows are reduced to one per key and dealt to the buckets of the base.
A bucket that has taken in few rows since its base was written gets them as a delta; one whose deltas have grown
to a share of its base is merged into a new base file. Buckets that nothing has come for keep their files. What a run writes
goes to a folder of its own and counts from the moment its manifest is there, so a run that died can be
made again, and older snapshots stay as they were until someone clears their folders away.

The manifest says which batch the snapshot goes up to, the key, the number of buckets, the columns, and for each bucket its
files with their sizes and rows. A snapshot is opened by its manifest only, and refused if it is missing, was made for
another key or other columns, or lacks a file or a part of one.

To read it, the base's buckets are the partitions of one catalog table bucketed by the key, wherever their files lie.
Joined with the reduced deltas and later batches, only these are shuffled.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.config import JobConfig
from orderloom.operators.upsert import latest_state, loose_keys, merge_snapshot
from orderloom.session import any_path, files_below, get_text, put_text

# A bucket is merged once its deltas have more rows than this share of its base.
MERGE_SHARE = 0.25


@dataclass(frozen=True)
class Files:
    """A bucket's files in a run's folder."""

    folder: str
    files: dict[str, int]
    rows: int


@dataclass(frozen=True)
class Snapshot:
    """The state up to and with a batch of the log."""

    folder: str
    upto: int
    keys: tuple[str, ...]
    buckets: int
    columns: dict[str, str]
    base: dict[int, Files]
    # By bucket, the oldest first.
    deltas: dict[int, list[Files]]

    def dumped(self) -> str:
        def shown(f: Files) -> dict:
            return {"folder": f.folder, "files": f.files, "rows": f.rows}

        return json.dumps(
            {
                "upto": self.upto,
                "keys": list(self.keys),
                "buckets": self.buckets,
                "columns": self.columns,
                "base": {b: shown(f) for b, f in self.base.items()},
                "deltas": {b: [shown(f) for f in each] for b, each in self.deltas.items()},
            }
        )


def _loaded(folder: str, text: str) -> Snapshot:
    m = json.loads(text)
    return Snapshot(
        folder,
        m["upto"],
        tuple(m["keys"]),
        m["buckets"],
        m["columns"],
        {int(b): Files(**f) for b, f in m["base"].items()},
        {int(b): [Files(**f) for f in each] for b, each in m["deltas"].items()},
    )


def _manifest(folder: str, upto: int) -> str:
    return f"{folder}/_manifests/{upto:012d}.json"


def open_snapshot(
    spark: SparkSession, folder: str, upto: int, cfg: JobConfig = JobConfig(), buckets: int | None = None
) -> Snapshot:
    """A snapshot written before, by this session or another, after a check that all of it is there. `buckets` may be
    given to make sure of their number; the manifest knows it."""
    path = _manifest(folder, upto)
    if not any_path(spark, path):
        raise ValueError(f"{folder} has no snapshot up to batch {upto}")
    found = _loaded(folder, get_text(spark, path))
    if found.keys != tuple(cfg.key_cols):
        raise ValueError(f"the snapshot is kept by {found.keys}, not by {tuple(cfg.key_cols)}")
    if buckets is not None and found.buckets != buckets:
        raise ValueError(f"the snapshot has {found.buckets} buckets, not {buckets}")
    if found.columns != S.SINK_TYPES:
        raise ValueError("the snapshot has other columns")
    listed: dict[str, dict[str, int]] = {}
    for part in [*found.base.values(), *(f for each in found.deltas.values() for f in each)]:
        if part.folder not in listed:
            there = any_path(spark, f"{folder}/{part.folder}")
            listed[part.folder] = files_below(spark, f"{folder}/{part.folder}") if there else {}
        for name, size in part.files.items():
            if listed[part.folder].get(name) != size:
                raise ValueError(f"{folder}/{part.folder}/{name} is missing or cut short")
    return found


# --- reading


def _bucket(keys: tuple[str, ...], buckets: int) -> str:
    """The number of a row's bucket, as a bucketed table counts them."""
    return f"pmod(hash({', '.join(keys)}), {buckets})"


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns.items())


def _base_table(snapshot: Snapshot, used: dict[int, Files]) -> str:
    """A name that stands for these files, so the same base is the same table however often it is asked for."""
    places = sorted((b, f.folder) for b, f in used.items())
    return f"base_{sha256(repr((snapshot.folder, places)).encode()).hexdigest()[:32]}"


def base_rows(spark: SparkSession, snapshot: Snapshot, only: set[int] | None = None) -> DataFrame | None:
    """The base, or some of its buckets, as a table bucketed by the key; none if it has no rows. The table's files are
    the snapshot's own, and stay when it is dropped (`release`)."""
    used = {b: f for b, f in snapshot.base.items() if only is None or b in only}
    if not used:
        return None
    name, keys = _base_table(snapshot, used), ", ".join(snapshot.keys)
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} ({_columns(snapshot.columns)}, bucket int) USING parquet
        PARTITIONED BY (bucket) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {snapshot.buckets} BUCKETS
        LOCATION '{snapshot.folder}/none'"""
    )
    places = " ".join(
        f"PARTITION (bucket = {b}) LOCATION '{snapshot.folder}/{f.folder}/bucket={b}'" for b, f in sorted(used.items())
    )
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    return spark.table(name).drop("bucket")


def release(spark: SparkSession, snapshot: Snapshot) -> None:
    """Take the snapshot's table out of the catalog; it comes back when the snapshot is read again."""
    spark.sql(f"DROP TABLE IF EXISTS {_base_table(snapshot, snapshot.base)}")


def _delta_rows(spark: SparkSession, snapshot: Snapshot, only: set[int] | None = None) -> list[DataFrame]:
    """The deltas with `level`, which counts up with their age falling, run by run."""
    runs: dict[str, list[int]] = {}
    for b, each in snapshot.deltas.items():
        if only is None or b in only:
            for part in each:
                runs.setdefault(part.folder, []).append(b)
    out = []
    for folder, used in sorted(runs.items()):  # folders are numbered in the order they were made
        top = f"{snapshot.folder}/{folder}"
        rows = spark.read.schema(_columns(snapshot.columns)).parquet(*[f"{top}/bucket={b}" for b in used])
        out.append(rows.select(*S.SINK_COLUMNS, F.lit(len(out)).alias("level")))
    return out


def state_rows(
    spark: SparkSession,
    snapshot: Snapshot,
    changes: DataFrame | None = None,
    cfg: JobConfig = JobConfig(),
    only: set[int] | None = None,
) -> DataFrame:
    """The state a snapshot holds, upserted with changes (one row per key), of all its buckets or some."""
    apart = cfg.null_text is None
    levels = _delta_rows(spark, snapshot, only)
    if changes is not None:
        levels.append(changes.select(*S.SINK_COLUMNS, F.lit(len(levels)).alias("level")))
    base = base_rows(spark, snapshot, only)
    if not levels:
        return spark.createDataFrame([], _columns(snapshot.columns)) if base is None else base.select(*S.SINK_COLUMNS)
    rows = reduce(DataFrame.unionAll, levels)
    if len(levels) == 1:
        reduced = rows.select(*S.SINK_COLUMNS)
    elif apart:  # rows with a NULL in the key are rows by themselves, on whatever level
        loose = loose_keys(snapshot.keys)
        reduced = latest_state(rows.where(f"not ({loose})"), snapshot.keys, ["level"])
        reduced = reduced.unionAll(rows.where(loose).select(*S.SINK_COLUMNS))
    else:
        reduced = latest_state(rows, snapshot.keys, ["level"])
    return reduced if base is None else merge_snapshot(base, reduced, snapshot.keys, apart)


# --- writing


def _written(df: DataFrame, snapshot: Snapshot, folder: str, bucketed: bool) -> dict[int, Files]:
    """Write rows by bucket into a folder; each bucket's files. The files of a base are named as those of a bucketed
    table, and a task that has a bucket's rows writes them as one file."""
    spark, keys = df.sparkSession, snapshot.keys
    top = f"{snapshot.folder}/{folder}"
    rows = df.select(*S.SINK_COLUMNS, F.expr(_bucket(keys, snapshot.buckets)).alias("bucket"))
    if bucketed:
        name = f"written_{uuid.uuid4().hex}"
        rows.write.partitionBy("bucket").bucketBy(snapshot.buckets, *keys).sortBy(*keys).option("path", top).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")  # the files stay
    else:
        rows.repartition("bucket").write.partitionBy("bucket").parquet(top)
    found: dict[int, dict[str, int]] = {}
    for path, size in files_below(spark, top).items():
        place, _, name = path.partition("/")
        if place.startswith("bucket=") and name.endswith(".parquet") and not name.startswith((".", "_")):
            found.setdefault(int(place.removeprefix("bucket=")), {})[path] = size
    if not found:
        return {}
    counts = spark.read.schema(f"{_columns(snapshot.columns)}, bucket int").parquet(top).groupBy("bucket").count()
    rows_of = {r["bucket"]: r["count"] for r in counts.collect()}
    return {b: Files(folder, files, rows_of[b]) for b, files in found.items()}


def fold(
    spark: SparkSession,
    changes: DataFrame,
    upto: int,
    folder: str,
    snapshot: Snapshot | None = None,
    cfg: JobConfig = JobConfig(),
    buckets: int = 64,
    merge_share: float = MERGE_SHARE,
) -> Snapshot:
    """A new snapshot: an old one, or nothing, upserted with changes (one row per key) that bring it up to a batch."""
    keys = tuple(cfg.key_cols)
    old = snapshot or Snapshot(folder, -1, keys, buckets, S.SINK_TYPES, {}, {})
    if old.keys != keys:
        raise ValueError(f"the snapshot is kept by {old.keys}, not by {keys}")
    if old.folder != folder:
        raise ValueError("snapshots that build on each other share a folder")
    run = f"run-{upto:012d}-{uuid.uuid4().hex}"
    if not old.base and not old.deltas:  # all buckets are new, and the changes are their base
        base = _written(changes.repartition(old.buckets, *keys), old, f"{run}/base", bucketed=True)
        made = Snapshot(folder, upto, keys, old.buckets, old.columns, base, {})
        put_text(spark, _manifest(folder, upto), made.dumped())
        return made
    dealt = changes.select(*S.SINK_COLUMNS, F.expr(_bucket(keys, old.buckets)).alias("bucket"))
    kept, place = dealt.drop("bucket"), f"{run}/changes"
    arrived = _written(kept, old, place, bucketed=False)

    def grown(b: int) -> bool:
        rows = sum(f.rows for f in old.deltas.get(b, [])) + arrived[b].rows
        return b not in old.base or rows > merge_share * old.base[b].rows

    merged = {b for b in arrived if grown(b)}
    base, deltas = dict(old.base), {b: list(each) for b, each in old.deltas.items()}
    for b in arrived.keys() - merged:
        deltas.setdefault(b, []).append(arrived[b])
    if merged:
        paths = [f"{folder}/{place}/bucket={b}" for b in sorted(merged)]
        coming = spark.read.schema(_columns(old.columns)).parquet(*paths)
        rows = state_rows(spark, old, coming, cfg, merged)
        if not merged & old.base.keys():  # no join has dealt them out yet
            rows = rows.repartition(old.buckets, *keys)
        fresh = _written(rows, old, f"{run}/base", bucketed=True)
        for b in merged:
            base[b] = fresh[b]
            deltas.pop(b, None)
    made = Snapshot(folder, upto, keys, old.buckets, old.columns, base, deltas)
    put_text(spark, _manifest(folder, upto), made.dumped())
    return made
