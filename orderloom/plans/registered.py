"""The queries registered for checking, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixtures as fx
from orderloom import schemas as S
from orderloom.config import JobConfig
from orderloom.functions import rules
from orderloom.functions.json_values import as_double, as_int, as_text
from orderloom.functions.text import quote_escape
from orderloom.functions.times import normalize_ts
from orderloom.operators import dimensions as dims
from orderloom.operators import enrich as en
from orderloom.operators import messages as msg
from orderloom.operators.upsert import latest_state
from orderloom.plans.order_lines import build, build_with_rejects
from orderloom.session import fresh_dir
from orderloom.sources.files import append_lines as append_columns
from orderloom.sources.files import attempt_path, committed, new_attempt, read_log, write_batch
from orderloom.sources.streams import parquet_messages, text_messages
from orderloom.streaming.job import Targets, compact, current_state, open_snapshot, read_rejects, run_stream

Query = Callable[[SparkSession, str], DataFrame]

# Processing time differs from run to run, so results under check leave it out unless it is given.
CHECKED = [c for c in S.SINK_COLUMNS if c != "load_timestamp"]
LOADED = "2024-02-29 12:34:56"


def _loaded() -> Column:
    return F.lit(LOADED).cast("timestamp_ntz")


PLAIN = JobConfig(line_number="position", escape_quotes=False, null_text=None, to_utc=True)


def _timestamps_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("load_timestamp", F.col("load_timestamp").cast("string"))


# --- lookup tables

def oms_channel_clean(spark, sf_dir):
    return dims.oms_channel_clean(fx.oms_channel(spark, sf_dir))


def master_store(spark, sf_dir):
    return dims.master_store_windowed(fx.oms_channel(spark, sf_dir))


def master_store_agg(spark, sf_dir):
    return dims.master_store(fx.oms_channel(spark, sf_dir))


def master_store_any_case(spark, sf_dir):
    return dims.master_store(fx.oms_channel(spark, sf_dir), case_insensitive=True)


def _any_case(spark, sf_dir):
    """The channels as they are, in capitals and in small letters."""
    channels = fx.oms_channel(spark, sf_dir)
    shown = [channels.selectExpr(*[f"{fold}({c}) as {c}" for c in channels.columns]) for fold in ("upper", "lower")]
    return channels.unionAll(shown[0]).unionAll(shown[1])


def oms_channel_any_case(spark, sf_dir):
    return dims.oms_channel_clean(_any_case(spark, sf_dir), case_insensitive=True)


def master_store_any_case_windowed(spark, sf_dir):
    return dims.master_store_windowed(_any_case(spark, sf_dir), case_insensitive=True)


def master_marketplace_any_case(spark, sf_dir):
    return dims.master_marketplace(_any_case(spark, sf_dir), case_insensitive=True)


def master_marketplace(spark, sf_dir):
    return dims.master_marketplace_windowed(fx.oms_channel(spark, sf_dir))


def master_marketplace_agg(spark, sf_dir):
    return dims.master_marketplace(fx.oms_channel(spark, sf_dir))


def dimension_key_check(spark, sf_dir):
    """Brands with several names before one is chosen."""
    pairs = dims.oms_channel_clean(fx.oms_channel(spark, sf_dir))
    return dims.duplicate_keys(
        pairs.select(F.col("channel_code").alias("brand_id"), "official_store"), "brand_id"
    )


# --- messages

def envelope_filter(spark, sf_dir):
    kept = msg.envelope_filter(fx.messages(spark, sf_dir))
    body_id = F.get_json_object("request_body", "$.id").alias("id")
    return kept.select("message_seq", "channel", "remote_order_status", body_id)


# Channels and statuses that meet in every combination.
TRIED_CHANNELS = ["blib", "lzda", "shpe", "tkpd", "tktk", "zlra", "SHPE"]
TRIED_STATUSES = [
    "PU", "FP", "unpaid", "pending", "packed", "PROCESSED", "READY_TO_SHIP", "UNPAID", "220", "accepted", "pu",
]


def first_status_filter(spark, sf_dir):
    def pick(values: list[str]) -> Column:
        return F.array(*map(F.lit, values))[(F.col("o_orderkey") % len(values)).cast("int")]

    tried = fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", pick(TRIED_CHANNELS).alias("channel"), pick(TRIED_STATUSES).alias("status")
    )
    return tried.where(rules.first_status("channel", "status"))


def order_headers(spark, sf_dir):
    return msg.order_headers(fx.messages(spark, sf_dir)).select("message_seq", *S.HEADER_COLUMNS)


def order_lines(spark, sf_dir):
    lines = msg.order_lines(fx.messages(spark, sf_dir))
    return lines.select("line_pos", *[c for c in CHECKED if c != "marketplace"])


def quarantine_split(spark, sf_dir):
    """Every wanted or malformed message and its reason."""
    judged = msg.classify_messages(fx.dirty_messages(spark, sf_dir))
    return judged.select("message_seq", F.coalesce("error_reason", F.lit("sound")).alias("outcome"))


def quarantine_lines(spark, sf_dir):
    """Lines of the messages that remain when malformed ones are set aside."""
    lines = build(
        fx.dirty_messages(spark, sf_dir), fx.oms_channel(spark, sf_dir), JobConfig(on_error="quarantine")
    )
    return lines.select(*CHECKED)


def quarantine_rejects(spark, sf_dir):
    """The messages that are set aside; their text goes along."""
    _, rejects = build_with_rejects(fx.dirty_messages(spark, sf_dir), fx.oms_channel(spark, sf_dir))
    return rejects.select("message_seq", (F.length("value") > 0).alias("has_text"), "error_reason")


def envelope_repeated_fields(spark, sf_dir):
    """Lines of messages in which fields repeat, and the messages set aside."""
    cfg = JobConfig(on_error="quarantine")
    judged = msg.classify_messages(fx.repeated_messages(spark, sf_dir), cfg)
    lines = msg.explode_lines(msg.sound_headers(judged), cfg)
    columns = ["message_seq", "line_pos", "id", "customer_reference", "quantity", "line_number"]
    aside = msg.rejected(judged).select("message_seq", F.col("error_reason").alias("id"))
    return lines.select(*columns).unionByName(aside, allowMissingColumns=True)


# --- value functions, on JSON made of varied values

JSON_VALUES = [
    '"text"', '"[1]"', "12", "1.50", "2.0", "1e3", "12345678901234567890", "true", "null", '{"a":1}', "[1,2]",
    '"12.5"', '"abc"', '"3.7"', "3.7", "-7", '" 7 "', "99999999999", '"99999999999"', "1e300", '""',
]


def _leaves(spark, sf_dir) -> DataFrame:
    """A JSON value chosen by order key, and as a number the order's price."""
    which = (F.col("o_orderkey") % len(JSON_VALUES)).cast("int")
    chosen = F.array(*map(F.lit, JSON_VALUES))[which]
    text = F.concat(
        F.lit('{"v":'), chosen, F.lit(',"price":'), F.col("o_totalprice").cast("string"),
        F.lit(',"price_text":"'), F.col("o_totalprice").cast("string"), F.lit('"}'),
    )
    parsed = F.from_json(text, "v variant, price variant, price_text variant, absent variant")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.inline(F.array(parsed)))


def json_as_text(spark, sf_dir):
    return _leaves(spark, sf_dir).selectExpr(
        "o_orderkey",
        f"{as_text('v')} as v",
        f"{as_text('v', None)} as v_or_null",
        f"{as_text('price_text')} as price_text",
        f"{as_text('absent')} as absent",
    )


def numeric_coerce(spark, sf_dir):
    kinds = {"double": as_double, "int": as_int}
    return _leaves(spark, sf_dir).selectExpr(
        "o_orderkey",
        *[f"{read(c)} as {c}_{kind}" for c in ("v", "price", "price_text") for kind, read in kinds.items()],
    )


def quote_escape_text(spark, sf_dir):
    text = "concat(o_orderpriority, \"'\", cast(o_orderkey as string), \"''\", o_orderstatus)"
    return fx.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{quote_escape(text)} as escaped")


# Ends of a date-time text, put behind the order's day.
DATE_TAILS = [
    "T18:47:34.987+07:00", "T18:47Z", "T02:30:00-05:00", "T18:47:34", "", " 18:47:34Z", "T23:59:59.123456789Z",
    "T24:00:00Z", "T18:47:34+19:00", "T18:47:34+07", "T01:02:03+07:00[Asia/Jakarta]", "T18:47:34+00:00[Asia/Jakarta]",
    "T18:47:34Z[Nowhere/Land]",
]


def timestamp_normalize(spark, sf_dir):
    tail = F.array(*map(F.lit, DATE_TAILS))[(F.col("o_orderkey") % len(DATE_TAILS)).cast("int")]
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    text = F.when(F.col("o_orderkey") % 29 == 0, F.lit("0001-01-01T00:00:00Z")).otherwise(F.concat(day, tail))
    texts = fx.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return texts.selectExpr(
        "o_orderkey", f"{normalize_ts('text')} as wall", f"{normalize_ts('text', to_utc=True)} as utc"
    )


# --- lookups and the whole job

def _lookups(spark, sf_dir):
    return dims.channel_lookups(fx.oms_channel(spark, sf_dir), JobConfig().broadcast_limit)


def store_lookup(spark, sf_dir):
    store, _ = _lookups(spark, sf_dir)
    headers = msg.order_headers(fx.messages(spark, sf_dir))
    return en.store_lookup(headers, store).select("id", "brand_id", "shop_name")


def marketplace_lookup(spark, sf_dir):
    _, marketplace = _lookups(spark, sf_dir)
    headers = msg.order_headers(fx.messages(spark, sf_dir))
    return en.marketplace_lookup(headers, marketplace).select("id", "channel_code", "marketplace")


def order_lines_enriched(spark, sf_dir):
    return _timestamps_as_text(build(fx.messages(spark, sf_dir), fx.oms_channel(spark, sf_dir), loaded=_loaded()))


def order_lines_from_lineitem(spark, sf_dir):
    """The same for one message per row of `lineitem`, with all columns of the target."""
    return _timestamps_as_text(build(fx.line_messages(spark, sf_dir), fx.oms_channel(spark, sf_dir), loaded=_loaded()))


def order_lines_shuffled(spark, sf_dir):
    """The same with lookups too large to broadcast."""
    cfg = JobConfig(broadcast_limit=0)
    return build(fx.messages(spark, sf_dir), fx.oms_channel(spark, sf_dir), cfg).select(*CHECKED)


def order_lines_plain(spark, sf_dir):
    """The same with every kept oddity switched off."""
    return build(fx.messages(spark, sf_dir), fx.oms_channel(spark, sf_dir), PLAIN).select(*CHECKED)


# --- sinks and streams

def append_lines(spark, sf_dir):
    return _timestamps_as_text(append_columns(fx.line_batches(spark, sf_dir)))


UPSERT_ORDER = ["batch_id", "seq"]


def upsert_latest(spark, sf_dir):
    rows = fx.line_batches(spark, sf_dir)
    return _timestamps_as_text(latest_state(rows, ["id", "remote_order_item_id"], UPSERT_ORDER))


def upsert_null_keys(spark, sf_dir):
    """Every seventh order has no id: as in a unique index, its lines are kept apart."""
    rows = fx.line_batches(spark, sf_dir).withColumn("id", F.expr("if(cast(id as bigint) % 7 = 0, null, id)"))
    return _timestamps_as_text(latest_state(rows, ["id", "remote_order_item_id"], UPSERT_ORDER, True))


def upsert_first_last_policy(spark, sf_dir):
    """Keyed by order only: one reduce to a row per batch and key, of which the first and last batches decide."""
    rows = fx.line_batches(spark, sf_dir)
    by_batch = latest_state(rows, ["id"], ["seq"], within=["batch_id"])
    return _timestamps_as_text(latest_state(by_batch, ["id"], ["batch_id"]))


def upsert_touched_buckets(spark, sf_dir):
    """The same from a bucketed snapshot of the first batch, the second one as deltas over it, the third one unfolded."""
    log, folder = fresh_dir(spark, "batches"), fresh_dir(spark, "state")
    rows = fx.line_batches(spark, sf_dir).selectExpr("*", "seq as message_seq", "0L as message_row", "0 as line_pos")
    for batch in range(fx.BATCHES):
        write_batch(rows.where(F.col("batch_id") == batch).drop("batch_id", "seq"), log, batch)
    cfg, snapshot = JobConfig(key_cols=("id",)), None
    for batch in range(fx.BATCHES - 1):
        snapshot = compact(spark, log, batch, folder, snapshot, cfg, buckets=16, merge_share=10.0)
    return _timestamps_as_text(current_state(spark, log, cfg, open_snapshot(spark, folder, snapshot.upto, cfg)))


def _stream(spark, sf_dir, reader, targets, cfg=JobConfig()):
    """Run the job on what has arrived, to its end."""
    query = run_stream(
        spark, reader, lambda s: fx.oms_channel(s, sf_dir), targets, cfg, trigger={"availableNow": True}
    )
    query.awaitTermination()


def stream_order_lines(spark, sf_dir):
    """The job on text files through Structured Streaming, read back from its log."""
    inbox, log, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "lines", "progress"))
    fx.messages(spark, sf_dir).select("value").write.text(inbox)
    _stream(spark, sf_dir, lambda s: text_messages(s, inbox), Targets(log, checkpoint))
    return read_log(spark, log).select(*CHECKED)


def stream_committed_batches(spark, sf_dir):
    """What readers see of a quarantine stream in two batches beside the leavings of attempts that failed: lines and rejects
    of committed batches, with the batch of each message."""
    inbox, log, checkpoint, rejects = (fresh_dir(spark, n) for n in ("inbox", "lines", "progress", "rejects"))
    targets, cfg = Targets(log, checkpoint, rejects), JobConfig(on_error="quarantine")
    dirty = fx.dirty_messages(spark, sf_dir)
    for batch in range(2):
        part = dirty.where(F.col("message_seq") % 2 == batch)
        part.write.mode("append").parquet(inbox)
        _stream(spark, sf_dir, lambda s: parquet_messages(s, inbox), targets, cfg)
        # Attempts at this batch and the next that got no further, with rows that are not true.
        for tried in (batch, batch + 1):
            part.selectExpr("cast(message_seq as string) as id").write.parquet(attempt_path(log, tried, new_attempt()))
    lines = read_log(spark, log).select("batch_id", F.col("id").cast("bigint").alias("message_seq"))
    lines = lines.groupBy("batch_id", "message_seq").agg(F.count(F.lit(1)).alias("n_lines"))
    aside = read_rejects(spark, targets).select("batch_id", "message_seq", F.lit(0).cast("bigint").alias("n_lines"))
    return lines.unionAll(aside)


def stream_upsert_state(spark, sf_dir):
    """The upserted table after a stream that brings second messages about half of the orders."""
    inbox, log, checkpoint = (fresh_dir(spark, n) for n in ("inbox", "lines", "progress"))
    for arriving in (fx.messages(spark, sf_dir), fx.later_messages(spark, sf_dir)):
        arriving.write.mode("append").parquet(inbox)
        _stream(spark, sf_dir, lambda s: parquet_messages(s, inbox), Targets(log, checkpoint))
    return current_state(spark, log).select(*CHECKED)


def stream_state_after_compaction(spark, sf_dir):
    """The same state from a snapshot of the first stream's batches and what the second one adds."""
    inbox, log, checkpoint, folder = (fresh_dir(spark, n) for n in ("inbox", "lines", "progress", "state"))
    snapshot = None
    for arriving in (fx.messages(spark, sf_dir), fx.later_messages(spark, sf_dir)):
        arriving.write.mode("append").parquet(inbox)
        _stream(spark, sf_dir, lambda s: parquet_messages(s, inbox), Targets(log, checkpoint))
        if snapshot is None:
            snapshot = compact(spark, log, max(committed(spark, log)), folder, buckets=8)
    return current_state(spark, log, snapshot=snapshot).select(*CHECKED)


QUERIES: dict[str, Query] = {
    "oms_channel_clean": oms_channel_clean,
    "master_store": master_store,
    "master_store_agg": master_store_agg,
    "master_store_any_case": master_store_any_case,
    "oms_channel_any_case": oms_channel_any_case,
    "master_store_any_case_windowed": master_store_any_case_windowed,
    "master_marketplace_any_case": master_marketplace_any_case,
    "master_marketplace": master_marketplace,
    "master_marketplace_agg": master_marketplace_agg,
    "dimension_key_check": dimension_key_check,
    "envelope_filter": envelope_filter,
    "first_status_filter": first_status_filter,
    "order_headers": order_headers,
    "order_lines": order_lines,
    "quarantine_split": quarantine_split,
    "quarantine_lines": quarantine_lines,
    "quarantine_rejects": quarantine_rejects,
    "envelope_repeated_fields": envelope_repeated_fields,
    "json_as_text": json_as_text,
    "numeric_coerce": numeric_coerce,
    "quote_escape": quote_escape_text,
    "timestamp_normalize": timestamp_normalize,
    "store_lookup": store_lookup,
    "marketplace_lookup": marketplace_lookup,
    "order_lines_enriched": order_lines_enriched,
    "order_lines_from_lineitem": order_lines_from_lineitem,
    "order_lines_shuffled": order_lines_shuffled,
    "order_lines_plain": order_lines_plain,
    "append_lines": append_lines,
    "upsert_latest": upsert_latest,
    "upsert_null_keys": upsert_null_keys,
    "upsert_first_last_policy": upsert_first_last_policy,
    "upsert_touched_buckets": upsert_touched_buckets,
    "stream_order_lines": stream_order_lines,
    "stream_committed_batches": stream_committed_batches,
    "stream_upsert_state": stream_upsert_state,
    "stream_state_after_compaction": stream_state_after_compaction,
}
