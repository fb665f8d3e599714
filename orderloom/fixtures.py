"""Channel and message tables derived from the TPC-H-like test tables.

Derivations are row by row: an order becomes one message with up to seven lines computed from it,
a supplier becomes four channels. Nothing is collected or shuffled, whatever the size or skew of
the tables. The expressions are SQL that Spark and DuckDB both read, so an expected result can be
stated on the tables without going through JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.functions.rules import ACTION, URL
from orderloom.session import with_fine_splits


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- channels ---------------------------------------------------------------------------------

MARKETPLACES = [("SHPE", "Shopee"), ("SHPE", "Shopee Mall"), ("LZDA", "Lazada"), ("TKPD", "Tokopedia")]

# `mp`, `mk`: marketplace code and name.
CHANNEL_CODE = """concat('BR', cast(s_suppkey - s_suppkey % 2 as string),
    case s_suppkey % 5 when 0 then ' ' else '' end, '_',
    case when s_suppkey % 11 = 3 then 'OFFLINE' when s_suppkey % 11 = 5 then 'Non Event' else mp end)"""
CHANNEL_NAME = """case s_suppkey % 7 when 0 then concat(mk, ' - Sleek ', s_name)
    when 1 then concat(mk, ' - ellips ', s_name)
    when 2 then 'B2B JNS Store'
    when 3 then concat(mk, '-', s_name, ' [x]! & (Co)')
    when 4 then concat(mk, ' - ')
    when 5 then concat('B2B Beauty - ', s_name) else mk end"""


def oms_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(mp).alias("mp"), F.lit(mk).alias("mk")) for mp, mk in MARKETPLACES])
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_name", F.inline(pairs))
        .select(F.expr(CHANNEL_CODE).alias("channel_code"), F.expr(CHANNEL_NAME).alias("channel_name"))
    )


# --- messages ---------------------------------------------------------------------------------

CHANNEL = """case o_orderkey % 5 when 0 then 'shpe' when 1 then 'lzda' when 2 then 'tkpd'
    when 3 then 'tktk' else 'SHPE' end"""
STATUS = "case o_orderkey % 3 when 0 then 'UNPAID' when 1 then 'unpaid' else '220' end"
EVENT_URL = "case when o_orderkey % 13 = 0 then 'other' else 'order-fetched' end"
_DAY = "substring(cast(o_orderdate as string), 1, 10)"

HEADER = {
    "id": "cast(o_orderkey as string)",
    "brand_id": "concat('BR', cast(o_custkey % 60 as string))",
    "shop_name": "concat('Shop ', cast(o_custkey as string))",
    "order_status": "o_orderstatus",
    "order_date": f"concat({_DAY}, 'T00:00:00+07:00')",
    "paid_at": f"""case o_orderkey % 4 when 0 then '0001-01-01T00:00:00Z' when 1 then null
        when 2 then concat({_DAY}, 'T10:11:12.345Z') else concat({_DAY}, 'T23:59-05:00') end""",
    "customer_reference": """case when o_orderkey % 17 = 0 then null
        else concat('C''', cast(o_custkey as string)) end""",
    "channel_code": f"case when o_orderkey % 10 = 7 then upper({CHANNEL}) else {CHANNEL} end",
    "remote_order_id": "concat('R', cast(o_orderkey as string))",
    "remote_warehouse_id": "concat('W', cast(o_orderkey % 10 as string))",
}

# Lines 1 to `o_orderkey % 8`, numbered `i`.
MAX_LINES = 7
LINE_COUNT = "o_orderkey % 8"
LINE = {
    "product_code": "concat('P', cast((o_orderkey * 7 + i) % 1000 as string))",
    "product_description": "concat('Item''s ', cast(i as string))",
    "raw_price": "o_totalprice / i",
    "quantity": "cast((o_orderkey + i) % 50 as int)",
    "line_total": "o_totalprice",
    "discount_amount": "cast(i as double) / 100",
    "remote_order_item_id": "cast(i as string)",
}


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


# What a second message about an order says differently; every other order has one.
LATER = {
    "order_status": "concat(o_orderstatus, ' later')",
    "customer_reference": "concat('later ', cast(o_custkey as string))",
    "remote_order_id": "concat('later ', cast(o_orderkey as string))",
}
LATER_LINE = {
    "raw_price": "o_totalprice * i",
    "quantity": "cast(100 + i as int)",
}
HAS_LATER = "o_orderkey % 2 = 0"


def _body(header: dict[str, str] = HEADER, line: dict[str, str] = LINE, lines: str | None = None) -> Column:
    lines = lines or (
        f"transform(slice(sequence(1, {MAX_LINES}), 1, cast({LINE_COUNT} as int)), i -> {_struct(line)})"
    )
    order = _struct({f: header[f] for f in S.ORDER_FIELDS} | {"line_items": lines})
    body = _struct({f: header[f] for f in S.BODY_FIELDS} | {"order": order})
    return F.expr(f"to_json({body}, map('ignoreNullFields', 'false'))")


def _envelope(body: Column, url: str = EVENT_URL, channel: str = CHANNEL, status: str = STATUS) -> Column:
    return F.to_json(
        F.struct(
            F.lit(ACTION).alias("action"),
            F.expr(url).alias("url"),
            F.expr(channel).alias("channel"),
            F.expr(status).alias("remote_order_status"),
            body.alias("request_body"),
        )
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per order, with `message_seq`."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.col("o_orderkey").alias("message_seq"), _envelope(_body()).alias("value"))


def later_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second messages."""
    orders = table(spark, sf_dir, "orders").where(HAS_LATER)
    body = _body(HEADER | LATER, LINE | LATER_LINE)
    return orders.select(F.col("o_orderkey").alias("message_seq"), _envelope(body).alias("value"))


# A message per row of `lineitem`, which is never gathered by order.
_SHIP_DAY = "substring(cast(l_shipdate as string), 1, 10)"
ITEM_HEADER = {
    "id": "cast(l_orderkey as string)",
    "brand_id": "concat('BR', cast(l_suppkey % 60 as string))",
    "shop_name": "concat('Shop ', cast(l_suppkey as string))",
    "order_status": "l_linestatus",
    "order_date": f"concat({_SHIP_DAY}, 'T00:00:00+07:00')",
    "paid_at": f"concat({_SHIP_DAY}, 'T10:11:12.345Z')",
    "customer_reference": "concat('C''', cast(l_partkey as string))",
    "channel_code": "case l_suppkey % 3 when 0 then 'shpe' when 1 then 'lzda' else 'tktk' end",
    "remote_order_id": "concat('R', cast(l_suppkey as string), '-', cast(l_partkey as string))",
    "remote_warehouse_id": "concat('W', cast(l_suppkey % 10 as string))",
}
ITEM_LINE = {
    "product_code": "cast(l_partkey as string)",
    "product_description": "concat('Item''s ', l_returnflag)",
    "raw_price": "l_extendedprice",
    "quantity": "cast(l_quantity as int)",
    "line_total": "l_extendedprice * (1 - l_discount)",
    "discount_amount": "l_discount",
    "remote_order_item_id": "cast(l_linenumber as string)",
}


def line_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wanted message with one line for each row of `lineitem`, read in fine splits: a message costs far more time than its
    row has bytes, so coarse ones leave cores idle at the end."""
    body = _body(ITEM_HEADER, lines=f"array({_struct(ITEM_LINE)})")
    value = _envelope(body, "'order-fetched'", "'lzda'", "'unpaid'")
    rows = table(with_fine_splits(spark), sf_dir, "lineitem")
    return rows.select(F.col("l_orderkey").alias("message_seq"), value.alias("value"))


# --- messages with faults ---------------------------------------------------------------------

# One fault per remainder of `o_orderkey` by DIRTY_MODULUS; other remainders are sound.
DIRTY_MODULUS = 19
CUT_SHORT, NO_CHANNEL, BODY_OBJECT, NO_LINES, LINES_OBJECT, NO_PRODUCT = 0, 1, 2, 3, 4, 5
UNZONED_DATE, NULL_BRAND, NUMBER_STATUS, BLANK, ARRAY, NO_BODY = 6, 7, 8, 9, 10, 11
NO_WAREHOUSE, NO_ACTION, DATE_WORD, BODY_CUT_SHORT, LINE_NUMBER_ONLY = 12, 13, 14, 15, 16


def _by_remainder(modulus: int, plain: Column, changed: dict[int, Column]) -> Column:
    which = F.col("o_orderkey") % modulus
    out = None
    for k, text in changed.items():
        out = (F if out is None else out).when(which == k, text)
    return out.otherwise(plain)


def dirty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sub(text: Column, pattern: str, new: str) -> Column:
        return F.regexp_replace(text, pattern, new)

    plain = F.col("body")
    body = _by_remainder(
        DIRTY_MODULUS,
        plain,
        {
            NO_LINES: sub(plain, r',"line_items":\[.*\]', ""),
            LINES_OBJECT: sub(plain, r'"line_items":\[.*\]', '"line_items":{}'),
            NO_PRODUCT: sub(plain, r'"product_code":"[^"]*",("product_description":"Item.s 1")', "$1"),
            UNZONED_DATE: sub(plain, r"T00:00:00\+07:00", "T00:00:00"),
            NULL_BRAND: sub(plain, r'"brand_id":"[^"]*"', '"brand_id":null'),
            NO_WAREHOUSE: sub(plain, r'"remote_warehouse_id":"[^"]*",', ""),
            DATE_WORD: sub(plain, r"\d{4}-\d\d-\d\dT00:00:00\+07:00", "yesterday"),
            BODY_CUT_SHORT: F.expr("substring(body, 1, 30)"),
            LINE_NUMBER_ONLY: sub(plain, r'"line_items":\[\{', '"line_items":[5,{'),
        },
    )
    envelope = F.col("envelope")
    value = _by_remainder(
        DIRTY_MODULUS,
        envelope,
        {
            CUT_SHORT: F.expr("substring(envelope, 1, 40)"),
            NO_CHANNEL: sub(envelope, r'"channel":"[^"]*",', ""),
            BODY_OBJECT: sub(envelope, r'"request_body":.*$', '"request_body":{"id":1}}'),
            NUMBER_STATUS: sub(envelope, r'"remote_order_status":"220"', '"remote_order_status":220'),
            BLANK: F.lit(""),
            ARRAY: F.lit("[1,2]"),
            NO_BODY: sub(envelope, r',"request_body":.*$', "}"),
            NO_ACTION: sub(envelope, r'"action":"[^"]*",', ""),
        },
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("body", _body())
        .withColumn("envelope", _envelope(body))
        .select(F.col("o_orderkey").alias("message_seq"), value.alias("value"))
    )


# --- messages in which a field repeats --------------------------------------------------------

# What repeats, by remainder of `o_orderkey` by REPEAT_MODULUS; nothing for other remainders.
REPEAT_MODULUS = 11
IN_OTHER, IN_CHANNEL, CHANNEL_TWICE, IN_REFERENCE, IN_QUANTITY, ID_TWICE, IN_ID, IN_CUT_SHORT = range(8)
REPEATING = '{"x":1,"x":{"y":2,"y":3}}'


def repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`messages` with fields that repeat: at the top, where the last value counts, or inside a value that should be a
    scalar, which then has no text and is 0 as a number."""
    def sub(text: Column, pattern: str, new: str) -> Column:
        return F.regexp_replace(text, pattern, new)

    plain, envelope = F.col("body"), F.col("envelope")
    body = _by_remainder(
        REPEAT_MODULUS,
        plain,
        {
            IN_REFERENCE: sub(plain, r'"customer_reference":("[^"]*"|null)', f'"customer_reference":{REPEATING}'),
            IN_QUANTITY: sub(plain, r'"quantity":\d+', f'"quantity":{REPEATING}'),
            ID_TWICE: sub(plain, r'^\{"id":', '{"id":"first","id":'),
            IN_ID: sub(plain, r'^\{"id":"[^"]*"', f'{{"id":{REPEATING}'),
        },
    )
    value = _by_remainder(
        REPEAT_MODULUS,
        envelope,
        {
            IN_OTHER: sub(envelope, r"^\{", f'{{"other":{REPEATING},'),
            IN_CHANNEL: sub(envelope, r'"channel":"[^"]*"', f'"channel":{REPEATING}'),
            CHANNEL_TWICE: sub(envelope, r'"channel":', f'"channel":{REPEATING},"channel":'),
            IN_CUT_SHORT: F.lit(f'{{"channel":{REPEATING},"url'),
        },
    )
    return (
        table(spark, sf_dir, "orders")
        .withColumn("body", _body())
        .withColumn("envelope", _envelope(body))
        .select(F.col("o_orderkey").alias("message_seq"), value.alias("value"))
    )


# --- line batches for upserts -----------------------------------------------------------------

BATCHES = 3
BATCH_ID = f"l_partkey % {BATCHES}"
_SHIPPED = "substring(cast(l_shipdate as string), 1, 19)"
BATCH_LINE = {
    "load_timestamp": "l_shipdate",
    "id": "cast(l_orderkey as string)",
    "brand_id": "concat('BR', cast(l_suppkey % 60 as string))",
    "shop_name": "concat('Shop ', cast(l_suppkey as string))",
    "order_date": _SHIPPED,
    "customer_reference": "concat('C', cast(l_partkey as string))",
    "order_status": "l_linestatus",
    "paid_at": _SHIPPED,
    "channel_code": "case l_suppkey % 3 when 0 then 'shpe' when 1 then 'lzda' else 'tktk' end",
    "remote_order_id": "concat('R', cast(l_suppkey as string), '-', cast(l_partkey as string))",
    "remote_warehouse_id": "concat('W', cast(l_suppkey % 10 as string))",
    "product_code": "cast(l_partkey as string)",
    "product_description": "concat('Item ', cast(l_partkey as string))",
    "raw_price": "l_extendedprice",
    "quantity": "cast(l_quantity as int)",
    "line_total": "l_extendedprice * (1 - l_discount)",
    "discount_amount": "l_discount",
    "marketplace": "l_returnflag",
    "remote_order_item_id": "cast(l_linenumber as string)",
    "line_number": "cast(cast(l_quantity as int) as string)",
}
# With the key, these tell any two lines of a batch apart.
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def line_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sink rows in three batches, many keys coming more than once; ordered by `batch_id, seq`. They are read for upserts,
    which sort what a task reads."""
    columns = [F.expr(sql).cast(S.SINK_TYPES[c]).alias(c) for c, sql in BATCH_LINE.items()]
    return table(with_fine_splits(spark), sf_dir, "lineitem").select(
        F.expr(BATCH_ID).alias("batch_id"), F.struct(*LINE_ORDER).alias("seq"), *columns
    )
