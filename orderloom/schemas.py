"""Column lists shared by the steps, the sinks and the tests."""

from __future__ import annotations

# Field names of the message format, in the order they are stored.
ENVELOPE_FIELDS = ["action", "url", "channel", "remote_order_status", "request_body"]
BODY_FIELDS = ["id", "brand_id", "shop_name"]
ORDER_FIELDS = [
    "order_status", "order_date", "paid_at", "customer_reference",
    "channel_code", "remote_order_id", "remote_warehouse_id",
]
LINE_FIELDS = [
    "product_code", "product_description", "raw_price", "quantity",
    "line_total", "discount_amount", "remote_order_item_id",
]

# The target table, column by column.
SINK_TYPES = {
    "load_timestamp": "timestamp_ntz",
    "id": "string",
    "brand_id": "string",
    "shop_name": "string",
    "order_date": "string",
    "customer_reference": "string",
    "order_status": "string",
    "paid_at": "string",
    "channel_code": "string",
    "remote_order_id": "string",
    "remote_warehouse_id": "string",
    "product_code": "string",
    "product_description": "string",
    "raw_price": "double",
    "quantity": "int",
    "line_total": "double",
    "discount_amount": "double",
    "marketplace": "string",
    "remote_order_item_id": "string",
    "line_number": "string",
}
SINK_COLUMNS = list(SINK_TYPES)

# The append-only table has no line_number.
APPEND_COLUMNS = [c for c in SINK_COLUMNS if c != "line_number"]

# Columns an upsert leaves as first written; it renews the others.
FIRST_WINS = ["id", "customer_reference", "remote_order_id", "remote_order_item_id", "line_number"]
LAST_WINS = [c for c in SINK_COLUMNS if c not in FIRST_WINS]

HEADER_COLUMNS = BODY_FIELDS + ORDER_FIELDS


def variants(fields: list[str]) -> str:
    """DDL for fields whose JSON type is known only per message."""
    return ", ".join(f"`{f}` variant" for f in fields)


# `_bad` receives the text of a value that is not JSON of the shape asked for.
BAD = "_bad"
ENVELOPE_DDL = f"{variants(ENVELOPE_FIELDS)}, {BAD} string"
BODY_DDL = (
    f"{variants(BODY_FIELDS)}, "
    f"`order` struct<{variants(ORDER_FIELDS).replace('` ', '`: ')}, "
    f"line_items: array<struct<{variants(LINE_FIELDS).replace('` ', '`: ')}>>>, "
    f"{BAD} string"
)


def plain_texts(ddl: str) -> str:
    """The same fields with plain texts as leaves."""
    return ddl.replace(" variant", " string")
