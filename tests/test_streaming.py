"""The job on streams: same rows as in batch, however often a batch is run."""

from __future__ import annotations

import datetime
import time

import pytest
from builders import body, channels, line, message, messages
from conftest import SMALL

from pyspark.sql import functions as F

from orderloom import fixtures as fx
from orderloom import schemas as S
from orderloom.config import JdbcConfig, JobConfig
from orderloom.operators import dimensions
from orderloom.operators.dimensions import channel_lookups
from orderloom.operators.upsert import latest_state
from orderloom.plans.order_lines import build
from orderloom.plans.registered import CHECKED
from orderloom.sources.files import attempt_path, committed, new_attempt, read_log, write_append, write_batch
from orderloom.sources.streams import parquet_messages, text_messages
from orderloom.streaming import job, snapshots
from orderloom.streaming.snapshots import release, state_rows

CHANNELS = [("BR1_SHPE", "Shopee - Official")]
NOW = {"availableNow": True}


def shown(df, columns=CHECKED):
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


def write_text(folder, name, values):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(values) + "\n")


def targets_of(tmp_path):
    return job.Targets(
        lines=str(tmp_path / "lines"), checkpoint=str(tmp_path / "progress"), rejects=str(tmp_path / "rejects")
    )


def run(spark, tmp_path, cfg=JobConfig(), reader=text_messages, table=None, **kw):
    targets = targets_of(tmp_path)
    query = job.run_stream(
        spark,
        lambda s: reader(s, str(tmp_path / "in"), **kw),
        table or (lambda s: channels(s, CHANNELS)),
        targets,
        cfg,
        NOW,
    )
    query.awaitTermination()
    return read_log(spark, targets.lines)


@pytest.mark.parametrize("cfg", [JobConfig(), JobConfig(on_error="quarantine"), JobConfig(refresh="per_batch")])
def test_stream_equals_batch(spark, tmp_path, cfg):
    messages = fx.messages(spark, SMALL)
    messages.repartition(5).write.parquet(str(tmp_path / "in"))
    log = run(
        spark, tmp_path, cfg, parquet_messages, lambda s: fx.oms_channel(s, SMALL), max_files=2
    )
    assert log.select("batch_id").distinct().count() == 3
    assert shown(log) == shown(build(messages, fx.oms_channel(spark, SMALL)))


def test_streaming_frame_goes_through_the_same_function(spark, tmp_path):
    fx.messages(spark, SMALL).write.parquet(str(tmp_path / "in"))
    stream = build(parquet_messages(spark, str(tmp_path / "in")), fx.oms_channel(spark, SMALL))
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(**NOW)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    batch = build(fx.messages(spark, SMALL), fx.oms_channel(spark, SMALL))
    assert shown(spark.read.parquet(str(tmp_path / "out"))) == shown(batch)


def test_rejects_are_set_aside(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message(), "{bad", message(body(lines=[line(quantity=None)]))])
    log = run(spark, tmp_path, JobConfig(on_error="quarantine"))
    assert log.count() == 2
    rejects = read_log(spark, str(tmp_path / "rejects"), commits=str(tmp_path / "lines"), output="rejects").collect()
    assert [(r.value, r.error_reason) for r in rejects] == [("{bad", "envelope_not_json")]


def test_malformed_message_stops_the_job(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message(), "{bad"])
    with pytest.raises(Exception, match="envelope_not_json"):
        run(spark, tmp_path)


def test_later_rows_win_across_and_within_batches(spark, tmp_path):
    def order(status, customer, *prices):
        lines = [line(raw_price=p) for p in prices]
        return message(body(lines=lines, order={"order_status": status, "customer_reference": customer}))

    write_text(tmp_path / "in", "a.txt", [order("A", "first", 1), order("B", "second", 2, 3)])
    run(spark, tmp_path)
    write_text(tmp_path / "in", "b.txt", [order("C", "third", 4), order("D", "fourth", 5, 6)])
    log = run(spark, tmp_path)
    (row,) = job.current_state(spark, str(tmp_path / "lines")).collect()
    assert log.count() == 6
    assert (row.order_status, row.customer_reference, row.raw_price) == ("D", "first", 6.0)


def test_batch_run_again_changes_nothing(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message()])
    log = run(spark, tmp_path)
    before = shown(log)
    for _ in range(3):
        write_batch(log.drop("batch_id"), str(tmp_path / "copy"), 0)
    assert shown(read_log(spark, str(tmp_path / "copy"))) == before


@pytest.mark.parametrize("lost", ["after lines", "after rejects", "in the commit"])
def test_batch_that_failed_between_its_writes_is_not_seen_and_made_again(spark, tmp_path, monkeypatch, lost):
    write_text(tmp_path / "in", "a.txt", [message(), "{bad"])
    quarantine, targets = JobConfig(on_error="quarantine"), targets_of(tmp_path)
    run(spark, tmp_path, quarantine)
    write_text(tmp_path / "in", "b.txt", [message(body(id="2")), "{worse"])
    before = (shown(read_log(spark, targets.lines)), job.read_rejects(spark, targets).count())
    write, calls = job._write, []

    def failing_write(rows, path, *rest):
        out = write(rows, path, *rest)
        calls.append(path)
        if len(calls) == (1 if lost == "after lines" else 2) and lost != "in the commit":
            raise RuntimeError("lost")
        return out

    def failing_commit(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(job, "_write", failing_write)
    if lost == "in the commit":
        monkeypatch.setattr(job, "commit", failing_commit)
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, quarantine)
    assert (shown(read_log(spark, targets.lines)), job.read_rejects(spark, targets).count()) == before
    assert shown(job.current_state(spark, targets.lines)) == before[0]

    monkeypatch.undo()
    log = run(spark, tmp_path, quarantine)
    assert sorted((r.batch_id, r.id) for r in log.collect()) == [(0, "1"), (1, "2")]
    assert sorted((r.batch_id, r.value) for r in job.read_rejects(spark, targets).collect()) == [(0, "{bad"), (1, "{worse")]


def test_batch_run_again_after_its_commit_is_left_as_it_is(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message()])
    first = committed(spark, targets_of(tmp_path).lines) if run(spark, tmp_path).count() else None
    lookups = channel_lookups(channels(spark, CHANNELS), 1 << 20)
    other = spark.createDataFrame([(message(body(id="9")), 1)], "value string, message_seq long")
    job._process(other, 0, *lookups, targets_of(tmp_path), JobConfig())
    assert committed(spark, targets_of(tmp_path).lines) == first
    assert [r.id for r in read_log(spark, targets_of(tmp_path).lines).collect()] == ["1"]


def test_a_log_without_batches_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="no committed batch"):
        read_log(spark, str(tmp_path))
    spark.range(3).write.parquet(attempt_path(str(tmp_path), 0, new_attempt()))
    with pytest.raises(ValueError, match="no committed batch"):
        read_log(spark, str(tmp_path))


def test_batches_out_of_range_give_no_rows(spark, tmp_path):
    for batch in range(4):
        write_batch(spark.range(batch, batch + 1), str(tmp_path), batch)
    assert [r.id for r in read_log(spark, str(tmp_path), after=0, upto=2).orderBy("id").collect()] == [1, 2]
    none = read_log(spark, str(tmp_path), after=3)
    assert none.columns == ["id", "batch_id"] and none.count() == 0


@pytest.mark.parametrize("refresh, second", [("never", "Official"), ("per_batch", "New")])
def test_channels_are_frozen_or_read_per_batch(spark, tmp_path, refresh, second):
    reads = []

    def table(session):
        reads.append(1)
        return channels(session, CHANNELS if len(reads) == 1 else [("BR1_SHPE", "Shopee - New")])

    write_text(tmp_path / "in", "a.txt", [message()])
    write_text(tmp_path / "in", "b.txt", [message(body(id="2"))])
    log = run(spark, tmp_path, JobConfig(refresh=refresh), table=table, max_files=1)
    assert [r.shop_name for r in log.orderBy("batch_id").collect()] == ["Official", second]


def test_unchanged_channels_leave_one_version(spark, tmp_path, monkeypatch):
    made = []

    def noted(*args):
        made.append(channel_lookups(*args))
        return made[-1]

    monkeypatch.setattr(dimensions, "channel_lookups", noted)
    for i in range(3):
        write_text(tmp_path / "in", f"{i}.txt", [message(body(id=str(i)))])
    log = run(spark, tmp_path, JobConfig(refresh="per_batch"), max_files=1)
    assert log.select("batch_id").distinct().count() == 3 and len(made) == 1


def batch_log(spark, log):
    rows = fx.line_batches(spark, SMALL).selectExpr(
        "*", "seq as message_seq", "0L as message_row", "0 as line_pos"
    )
    for batch in range(fx.BATCHES):
        write_batch(rows.where(f"batch_id = {batch}").drop("batch_id", "seq"), log, batch)
    return rows


ONE_KEY = JobConfig(key_cols=("id",))


def test_compaction(spark, tmp_path, conf):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    rows = batch_log(spark, log)
    want = latest_state(rows, ONE_KEY.key_cols, job.ORDER)
    first = job.compact(spark, log, 0, folder, cfg=ONE_KEY, buckets=4)
    assert first.upto == 0 and set(first.base) == set(range(4)) and not first.deltas
    later = job.current_state(spark, log, ONE_KEY, first)
    assert shown(later, want.columns) == shown(want, want.columns)
    assert shown(job.current_state(spark, log, ONE_KEY), want.columns) == shown(want, want.columns)

    # Of the snapshot and the later batches, only the latter are read from the log, and only they are shuffled.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    later = job.current_state(spark, log, ONE_KEY, first)
    assert not any("batch_id=0" in file for file in later.inputFiles())
    text = later._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in text.splitlines()) == 1
    assert "Exchange" not in text[text.index("SortMergeJoin") : text.index("SortAggregate")]
    assert "Bucketed: true" in text

    # All buckets have grown by more than their share: they are merged.
    second = job.compact(spark, log, fx.BATCHES - 1, folder, first, ONE_KEY)
    assert not second.deltas and second.buckets == 4
    assert shown(state_rows(spark, second, cfg=ONE_KEY), want.columns) == shown(want, want.columns)
    with pytest.raises(ValueError, match="already"):
        job.compact(spark, log, fx.BATCHES - 1, folder, second, ONE_KEY)
    with pytest.raises(ValueError, match="no committed batch 9"):
        job.compact(spark, log, 9, folder, second, ONE_KEY)

    # Another session finds the snapshots in their folder; the first one is as it was.
    assert job.open_snapshot(spark, folder, second.upto, ONE_KEY, buckets=4) == second
    assert job.open_snapshot(spark, folder, 0, ONE_KEY) == first
    release(spark, second)
    assert shown(state_rows(spark, second, cfg=ONE_KEY), want.columns) == shown(want, want.columns)


def small_batches(spark, log, *batches):
    """A log of lines by id; the price tells the batch."""
    for number, ids in enumerate(batches):
        rows = [(f"k{i}", str(number), float(number), 0, 0, i) for i in ids]
        made = spark.createDataFrame(rows, "id string, customer_reference string, raw_price double, message_seq int, message_row int, line_pos int")
        others = [F.lit(None).cast(t).alias(c) for c, t in S.SINK_TYPES.items() if c not in made.columns]
        write_batch(made.select("*", *others).select(*job.LOGGED, *S.SINK_COLUMNS), log, number)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    small_batches(spark, log, range(400), [3, 4], [3, 1000], range(0, 400, 2))
    state = {f"k{i}": ("0", 0.0) for i in range(400)}

    def held(snapshot):
        rows = state_rows(spark, snapshot, cfg=ONE_KEY).collect()
        return {r.id: (r.customer_reference, r.raw_price) for r in rows}

    one = job.compact(spark, log, 0, folder, cfg=ONE_KEY, buckets=16)
    assert held(one) == state and sum(f.rows for f in one.base.values()) == 400
    two = job.compact(spark, log, 1, folder, one, ONE_KEY)
    state |= {"k3": ("0", 1.0), "k4": ("0", 1.0)}
    # Few rows for large buckets: no file of the base is written anew, and only their buckets have deltas.
    assert held(two) == state and two.base == one.base and 1 <= len(two.deltas) <= 2
    three = job.compact(spark, log, 2, folder, two, ONE_KEY, merge_share=0.0)
    state |= {"k3": ("0", 2.0), "k1000": ("2", 2.0)}
    changed = {b for b in three.base if three.base[b] != two.base[b]}
    assert held(three) == state and 1 <= len(changed) <= 2
    assert set(three.deltas) == set(two.deltas) - changed
    four = job.compact(spark, log, 3, folder, three, ONE_KEY)
    state |= {f"k{i}": ("0", 3.0) for i in range(0, 400, 2)}
    assert held(four) == state and not four.deltas
    # Older snapshots read as before.
    assert held(one) == {f"k{i}": ("0", 0.0) for i in range(400)}


def test_null_keys_stay_apart_through_compactions(spark, tmp_path):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    cfg = JobConfig(key_cols=("id",), null_text=None)
    small_batches(spark, log, range(50), range(5), range(5))
    for batch in range(3):
        rows = read_log(spark, log).where(F.col("batch_id") == batch).drop("batch_id")
        loose = rows.where("line_pos < 3").withColumn("id", F.lit(None).cast("string"))
        write_batch(rows.unionAll(loose), str(tmp_path / "loose"), batch)
    log, snapshot = str(tmp_path / "loose"), None
    for batch in range(3):
        snapshot = job.compact(spark, log, batch, folder, snapshot, cfg, buckets=4, merge_share=[0.25, 9.0, 0.0][batch])
        got = state_rows(spark, snapshot, cfg=cfg)
        want = latest_state(read_log(spark, log, upto=batch), cfg.key_cols, job.ORDER, True)
        assert shown(got, want.columns) == shown(want, want.columns)


def test_a_wrong_or_partial_snapshot_is_refused(spark, tmp_path):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    batch_log(spark, log)
    with pytest.raises(ValueError, match="no snapshot up to batch 0"):
        job.open_snapshot(spark, folder, 0, ONE_KEY)
    made = job.compact(spark, log, 0, folder, cfg=ONE_KEY, buckets=4)
    with pytest.raises(ValueError, match="no snapshot up to batch 1"):
        job.open_snapshot(spark, folder, 1, ONE_KEY)
    with pytest.raises(ValueError, match="4 buckets, not 8"):
        job.open_snapshot(spark, folder, 0, ONE_KEY, buckets=8)
    with pytest.raises(ValueError, match="kept by"):
        job.open_snapshot(spark, folder, 0)
    with pytest.raises(ValueError, match="kept by"):
        job.compact(spark, log, 1, folder, made)
    part = made.base[0]
    file = tmp_path / "state" / part.folder / next(iter(part.files))
    whole = file.read_bytes()
    file.write_bytes(whole[:-10])
    with pytest.raises(ValueError, match="missing or cut short"):
        job.open_snapshot(spark, folder, 0, ONE_KEY)
    file.unlink()
    with pytest.raises(ValueError, match="missing or cut short"):
        job.open_snapshot(spark, folder, 0, ONE_KEY)
    file.write_bytes(whole)
    assert job.open_snapshot(spark, folder, 0, ONE_KEY) == made


@pytest.mark.parametrize("lost", ["_written", "put_text"])
def test_a_compaction_that_died_can_be_made_again(spark, tmp_path, monkeypatch, lost):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    rows = batch_log(spark, log)
    want = latest_state(rows.where("batch_id < 2"), ONE_KEY.key_cols, job.ORDER)
    first = job.compact(spark, log, 0, folder, cfg=ONE_KEY, buckets=4)
    done = getattr(snapshots, lost)

    def dies(*args, **kw):
        if lost == "_written":
            done(*args, **kw)
        raise RuntimeError("lost")

    monkeypatch.setattr(snapshots, lost, dies)
    with pytest.raises(RuntimeError, match="lost"):
        job.compact(spark, log, 1, folder, first, ONE_KEY)
    monkeypatch.undo()
    with pytest.raises(ValueError, match="no snapshot up to batch 1"):
        job.open_snapshot(spark, folder, 1, ONE_KEY)
    job.compact(spark, log, 1, folder, job.open_snapshot(spark, folder, 0, ONE_KEY), ONE_KEY)
    again = job.open_snapshot(spark, folder, 1, ONE_KEY)
    assert shown(state_rows(spark, again, cfg=ONE_KEY), want.columns) == shown(want, want.columns)


def test_snapshot_without_rows(spark, tmp_path):
    log, folder = str(tmp_path / "lines"), str(tmp_path / "state")
    small_batches(spark, log, [], range(3), [])
    none = job.compact(spark, log, 0, folder, cfg=ONE_KEY, buckets=4)
    assert not none.base and state_rows(spark, none, cfg=ONE_KEY).count() == 0
    assert job.current_state(spark, log, ONE_KEY, job.open_snapshot(spark, folder, 0, ONE_KEY)).count() == 3
    some = job.compact(spark, log, 1, folder, none, ONE_KEY)
    same = job.compact(spark, log, 2, folder, some, ONE_KEY)
    assert same.base == some.base and state_rows(spark, same, cfg=ONE_KEY).count() == 3


def test_append(spark, tmp_path):
    rows = fx.line_batches(spark, SMALL)
    for _ in range(2):
        write_append(rows, str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert table.count() == 2 * rows.count() and "line_number" not in table.columns


def test_the_same_append_counts_once(spark, tmp_path):
    rows, path = fx.line_batches(spark, SMALL), str(tmp_path / "table")
    for run_number in (1, 1, 2, 1):
        write_append(rows.where(F.col("batch_id") == run_number), path, run_number)
    table = read_log(spark, path)
    assert table.count() == rows.where("batch_id > 0").count()
    assert table.columns == [*S.APPEND_COLUMNS, "batch_id"]


def test_quarantine_needs_a_folder(spark, tmp_path):
    targets = job.Targets(lines=str(tmp_path / "l"), checkpoint=str(tmp_path / "c"))
    with pytest.raises(ValueError, match="rejects"):
        job.run_stream(
            spark, lambda s: None, lambda s: None, targets, JobConfig(on_error="quarantine")
        )


def test_empty_folders_are_no_hindrance(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message()])
    (tmp_path / "lines").mkdir()
    (tmp_path / "progress").mkdir()
    assert run(spark, tmp_path).count() == 1


def test_new_checkpoint_needs_a_new_folder(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message()])
    (tmp_path / "lines" / "batch_id=0").mkdir(parents=True)
    with pytest.raises(ValueError, match="another run"):
        run(spark, tmp_path)


def test_new_checkpoint_needs_a_new_folder_for_rejects(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", [message(), "{"])
    quarantine = JobConfig(on_error="quarantine")

    def start(checkpoint, lines):
        targets = job.Targets(str(tmp_path / lines), str(tmp_path / checkpoint), str(tmp_path / "rejects"))
        query = job.run_stream(
            spark,
            lambda s: text_messages(s, str(tmp_path / "in")),
            lambda s: channels(s, CHANNELS),
            targets,
            quarantine,
            {"availableNow": True},
        )
        query.awaitTermination()

    start("c1", "l1")
    first = job.read_rejects(spark, job.Targets(str(tmp_path / "l1"), "", str(tmp_path / "rejects"))).collect()
    assert [r.value for r in first] == ["{"]
    with pytest.raises(ValueError, match="rejects has batches of another run"):
        start("c2", "l2")
    assert job.read_rejects(spark, job.Targets(str(tmp_path / "l1"), "", str(tmp_path / "rejects"))).collect() == first


def test_a_database_needs_a_text_for_null(spark, tmp_path):
    database = JdbcConfig(url="jdbc:x", table="t", username="u", password="p")
    targets = job.Targets(str(tmp_path / "l"), str(tmp_path / "c"), database=database)
    with pytest.raises(ValueError, match="null_text"):
        job.run_stream(spark, lambda s: None, lambda s: None, targets, JobConfig(null_text=None))


def test_lines_of_a_message_share_their_load_time_and_messages_need_not(spark):
    @F.udf("string")
    def slowly(value):
        time.sleep(0.8)
        return value

    values = [message(body(id=str(i), lines=[line(remote_order_item_id=str(k)) for k in range(3)])) for i in range(4)]
    slow = messages(spark, values).coalesce(1).withColumn("value", slowly.asNondeterministic()("value"))
    before = datetime.datetime.now().replace(microsecond=0)
    # Two readings one after the other: Python rows are handed over in batches.
    halves = slow.where("message_seq < 2").unionAll(slow.where("message_seq >= 2")).coalesce(1)
    rows = build(halves, channels(spark, CHANNELS)).collect()
    times = {}
    for r in rows:
        times.setdefault(r.id, set()).add(r.load_timestamp)
    assert len(rows) == 12 and all(len(t) == 1 for t in times.values())
    assert len(set().union(*times.values())) > 1
    assert min(min(t) for t in times.values()) >= before
