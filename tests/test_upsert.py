"""Upserts against a row-by-row reading of the same rows."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from orderloom import schemas as S
from orderloom.config import JobConfig
from orderloom.operators.upsert import latest_state, merge_snapshot
from orderloom.plans.registered import QUERIES
from orderloom.session import files_below
from orderloom.streaming.snapshots import fold, state_rows

KEYS = ["id", "remote_order_item_id"]
TYPES = {c: "string" if t == "timestamp_ntz" else t for c, t in S.SINK_TYPES.items()}
DDL = "batch_id bigint, seq bigint, " + ", ".join(f"{c} {t}" for c, t in TYPES.items())


def rows(n, seed, hot=0.34, null_keys=0.0):
    rng = random.Random(seed)

    def value(c):
        if c in KEYS and rng.random() < null_keys:
            return None
        if c == "id":
            return "hot" if rng.random() < hot else f"o{rng.randrange(40)}"
        if c == "remote_order_item_id":
            return str(rng.randrange(3))
        kind = TYPES[c]
        number = rng.randrange(1000)
        other = None if rng.random() < 0.1 else number
        if other is None:
            return None
        return number if kind == "int" else float(number) if kind == "double" else f"{c[:2]}{number}"

    out = [(rng.randrange(4), i, *[value(c) for c in S.SINK_COLUMNS]) for i in range(n)]
    rng.shuffle(out)
    return out


def upserted(data, keys):
    """What a table with a unique key holds after the rows were upserted one by one."""
    table, loose = {}, []
    for row in sorted(data, key=lambda r: r[:2]):
        new = dict(zip(S.SINK_COLUMNS, row[2:]))
        key = tuple(new[k] for k in keys)
        if None in key:
            loose.append(new)
        elif key in table:
            table[key] |= {c: new[c] for c in S.LAST_WINS if c not in keys}
        else:
            table[key] = new
    return sorted(str(tuple(r[c] for c in S.SINK_COLUMNS)) for r in [*table.values(), *loose])


def shown(df):
    assert df.columns == S.SINK_COLUMNS
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.mark.parametrize("keys", [KEYS, ["id"], ["id", "brand_id", "line_number"], S.FIRST_WINS])
def test_latest_state(spark, keys):
    data = [r for r in rows(2000, 1) if None not in r]
    df = spark.createDataFrame(data, DDL).repartition(6)
    assert shown(latest_state(df, keys, ["batch_id", "seq"])) == upserted(data, keys)


def test_null_keys_stay_apart(spark):
    data = rows(1000, 2, null_keys=0.3)
    df = spark.createDataFrame(data, DDL)
    assert shown(latest_state(df, KEYS, ["batch_id", "seq"], null_keys_distinct=True)) == upserted(data, KEYS)


@pytest.mark.parametrize("keys", [KEYS, ["id"]])
@pytest.mark.parametrize("null_keys", [0.0, 0.3])
def test_batch_after_batch(spark, keys, null_keys):
    data = rows(1500, 3, null_keys=null_keys)
    df = spark.createDataFrame(data, DDL)
    state, apart = None, null_keys > 0
    for batch in range(4):
        changes = latest_state(df.where(f"batch_id = {batch}"), keys, ["seq"], apart)
        state = changes if state is None else merge_snapshot(state, changes, keys, apart)
    assert shown(state) == upserted(data, keys) == shown(latest_state(df, keys, ["batch_id", "seq"], apart))


def test_merging_the_same_changes_again_changes_nothing(spark):
    df = spark.createDataFrame(rows(400, 4), DDL)
    state = latest_state(df.where("batch_id < 2"), KEYS, ["batch_id", "seq"])
    changes = latest_state(df.where("batch_id >= 2"), KEYS, ["batch_id", "seq"])
    once = merge_snapshot(state, changes, KEYS)
    assert shown(merge_snapshot(once, changes, KEYS)) == shown(once)


def test_columns_of_each_kind():
    assert len(S.SINK_COLUMNS) == 20 and len(S.APPEND_COLUMNS) == 19
    assert len(S.LAST_WINS) == 15 and set(S.FIRST_WINS) | set(S.LAST_WINS) == set(S.SINK_COLUMNS)


@pytest.mark.parametrize("query", ["upsert_latest", "upsert_null_keys", "upsert_first_last_policy", "upsert_touched_buckets"])
@pytest.mark.parametrize("set_to, read_in", [("128m", str(16 << 20)), ("1m", "1m")])
def test_rows_to_reduce_are_read_in_fine_splits(spark, tmp_path, conf, query, set_to, read_in):
    """A task that reads 128 MB has gigabytes of rows to sort before the shuffle, and spills most of them."""
    spark.createDataFrame(
        [(1, n, 3, 4, 5.0, 6.0, 0.1, "A", "F", datetime(2024, 1, 1)) for n in range(3)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    split = "spark.sql.files.maxPartitionBytes"
    conf(split, set_to)
    conf("spark.sql.shuffle.partitions", "5")
    found = QUERIES[query](spark, str(tmp_path))
    shown = found.select("id", "customer_reference", "product_code").collect()
    assert [tuple(r) for r in shown] == [("1", "C0", "2")]
    assert found.sparkSession.conf.get(split) == read_in and spark.conf.get(split) == set_to
    assert found.sparkSession.conf.get("spark.sql.shuffle.partitions") == "5"


def test_first_snapshot_is_written_once(spark, tmp_path):
    """Its rows went through a delta of every bucket before, shuffled and written once more than needed."""
    data = [r for r in rows(300, 6) if None not in r]
    typed = spark.createDataFrame(data, DDL).selectExpr(
        "batch_id", "seq", *[f"cast({c} as {t}) as {c}" if c != "load_timestamp" else f"cast(null as {t}) as {c}" for c, t in S.SINK_TYPES.items()]
    )
    changes = latest_state(typed, ["id"], ["batch_id", "seq"])
    folder = str(tmp_path / "state")
    made = fold(spark, changes, 0, folder, cfg=JobConfig(key_cols=("id",)), buckets=4)
    assert not [f for f in files_below(spark, folder) if "/changes/" in f]
    assert not made.deltas and sum(f.rows for f in made.base.values()) == changes.count()
    assert shown(state_rows(spark, made, cfg=JobConfig(key_cols=("id",)))) == shown(changes)
    empty = fold(spark, changes.limit(0), 0, str(tmp_path / "none"), cfg=JobConfig(key_cols=("id",)), buckets=4)
    assert not empty.base and not empty.deltas
    again = fold(spark, changes, 1, str(tmp_path / "none"), empty, JobConfig(key_cols=("id",)))
    assert again.buckets == 4 and shown(state_rows(spark, again, cfg=JobConfig(key_cols=("id",)))) == shown(changes)
