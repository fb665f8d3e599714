"""Batch runs that return what they set aside."""

from __future__ import annotations

from builders import body, channels, line, message, messages
from conftest import SMALL

from orderloom import fixtures as fx
from orderloom.config import JobConfig
from orderloom.operators.messages import classify_messages, rejected
from orderloom.plans.order_lines import build, build_with_rejects
from orderloom.plans.registered import CHECKED

CHANNELS = [("BR1_SHPE", "Shopee - Official")]


def test_lines_and_rejects_come_from_one_reading(spark):
    broken = ["{", message(body(lines=[line(product_code=None), 5]))]
    values = [message(body()), *broken, message(body(id="2"))]
    lines, rejects = build_with_rejects(messages(spark, values), channels(spark, CHANNELS))
    assert sorted(r.id for r in lines.collect()) == ["1", "2"]
    got = {r.value: r.error_reason for r in rejects.collect()}
    assert got == {"{": "envelope_not_json", broken[1]: "body_malformed"}
    for df in (lines, rejects):
        assert "from_json" not in df._jdf.queryExecution().executedPlan().toString()


def test_nothing_is_lost(spark):
    source, table = fx.dirty_messages(spark, SMALL), fx.oms_channel(spark, SMALL)
    lines, rejects = build_with_rejects(source, table)
    want = rejected(classify_messages(source)).select("message_seq", "value", "error_reason")
    key = lambda rows: sorted(map(str, rows))
    assert key(rejects.select("message_seq", "value", "error_reason").collect()) == key(want.collect())
    plain = build(source, table, JobConfig(on_error="quarantine"))
    assert key(lines.select(*CHECKED).collect()) == key(plain.select(*CHECKED).collect())
    texts = {r.message_seq: r.value for r in source.collect()}
    assert all(texts[r.message_seq] == r.value for r in rejects.collect()) and rejects.count() > 100
