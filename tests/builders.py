"""Messages and channel tables for tests, as Python values."""

from __future__ import annotations

import json

ABSENT = object()

LINE = {
    "product_code": "P1",
    "product_description": "One",
    "raw_price": 10.5,
    "quantity": 2,
    "line_total": 21.0,
    "discount_amount": 0.5,
    "remote_order_item_id": "1",
}
ORDER = {
    "order_status": "F",
    "order_date": "2023-12-20T18:47:34+07:00",
    "paid_at": "2023-12-20T19:00:00Z",
    "customer_reference": "C1",
    "channel_code": "shpe",
    "remote_order_id": "R1",
    "remote_warehouse_id": "W1",
}
BODY = {"id": "1", "brand_id": "BR1", "shop_name": "Shop"}
ENVELOPE = {
    "action": "interior_fetch_order_detail_pubsub_success",
    "url": "order-fetched",
    "channel": "shpe",
    "remote_order_status": "UNPAID",
}


def _without_absent(fields: dict) -> dict:
    return {k: v for k, v in fields.items() if v is not ABSENT}


def line(**changes) -> dict:
    return _without_absent(LINE | changes)


def body(lines=None, order=None, **changes) -> dict:
    items = [line()] if lines is None else lines
    inner = _without_absent(ORDER | {"line_items": items} | (order or {}))
    return _without_absent(BODY | {"order": inner} | changes)


def message(request_body=None, **changes) -> str:
    content = body() if request_body is None else request_body
    if content is not ABSENT and not isinstance(content, str):
        content = json.dumps(content)
    return json.dumps(_without_absent(ENVELOPE | {"request_body": content} | changes))


def messages(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "message_seq bigint, value string")


def channels(spark, pairs):
    return spark.createDataFrame(pairs, "channel_code string, channel_name string")
