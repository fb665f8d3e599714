"""Which messages are kept, dropped or rejected, and what becomes of their fields."""

from __future__ import annotations

import json

import pytest
from builders import ABSENT, body, line, message, messages

from orderloom.config import JobConfig
from orderloom.operators import messages as m

FINE, DROPPED = "fine", "dropped"

CASES = {
    "plain": (message(), FINE),
    "status as number": (message(channel="tkpd", remote_order_status=220), FINE),
    "status as decimal": (message(channel="tkpd", remote_order_status=220.0), DROPPED),
    "channel in capitals": (message(channel="SHPE"), DROPPED),
    "later status": (message(remote_order_status="DONE"), DROPPED),
    "status null": (message(remote_order_status=None), DROPPED),
    "other url": (message(url="other"), DROPPED),
    "url null": (message(url=None), DROPPED),
    "no action": (message(action=ABSENT), DROPPED),
    "no url": ('{"action":"x"}', DROPPED),
    "empty text": ("", DROPPED),
    "blank text": ("  ", DROPPED),
    "no text": (None, DROPPED),
    "array": ("[1]", DROPPED),
    "array with object": ('[{"action":"a"}]', DROPPED),
    "number": ("5", DROPPED),
    "JSON null": ("null", DROPPED),
    "text after the object": (message() + " tail", FINE),
    "repeated field": ('{"url":"other",' + message()[1:], FINE),
    "body is an object": (message(url="order-fetched").replace('"request_body": "', '"x": "')[:-1]
                          + ', "request_body": {"id": 1}}', DROPPED),
    "body empty": (message(""), DROPPED),
    "not JSON": ("{bad", m.NOT_JSON),
    "cut short": (message()[:50], m.NOT_JSON),
    "single quotes": ("{'action':'a'}", m.NOT_JSON),
    "no channel": (message(channel=ABSENT), m.ENVELOPE_FIELD_MISSING),
    "no channel, other event": ('{"action":"x","url":"y"}', m.ENVELOPE_FIELD_MISSING),
    "no status": (message(remote_order_status=ABSENT), m.ENVELOPE_FIELD_MISSING),
    "no body": (message(ABSENT), m.BODY_MISSING),
    "no body, other event": (message(ABSENT, url="other"), DROPPED),
    "body null": (message("null"), m.BODY_MALFORMED),
    "body blank": (message("  "), m.BODY_MALFORMED),
    "body cut short": (message('{"id": 1, "order": {'), m.BODY_MALFORMED),
    "body is a number": (message().split(', "request_body"')[0] + ', "request_body": 5}', m.BODY_MALFORMED),
    "body is an array": (message("[]"), m.BODY_MALFORMED),
    "no order": (message(body() | {"order": None}), m.BODY_MALFORMED),
    "order is text": (message(body() | {"order": "x"}), m.BODY_MALFORMED),
    "no order status": (message(body(order={"order_status": ABSENT})), m.BODY_MALFORMED),
    "no order date": (message(body(order={"order_date": ABSENT})), m.BODY_MALFORMED),
    "no paid date": (message(body(order={"paid_at": ABSENT})), m.BODY_MALFORMED),
    "no lines field": (message(body(order={"line_items": ABSENT})), m.BODY_MALFORMED),
    "lines null": (message(body(order={"line_items": None})), m.BODY_MALFORMED),
    "lines an object": (message(body(order={"line_items": {}})), m.BODY_MALFORMED),
    "line a number": (message(body(lines=[line(), 5])), m.BODY_MALFORMED),
    "line null": (message(body(lines=[line(), None])), m.LINE_FIELD_MISSING),
    "date without zone": (message(body(order={"order_date": "2023-12-20T18:47:34"})), m.BAD_DATE),
    "paid date blank": (message(body(order={"paid_at": ""})), m.BAD_DATE),
    "date a number": (message(body(order={"order_date": 5})), m.BAD_DATE),
    "date null": (message(body(order={"order_date": None, "paid_at": None})), FINE),
    "no id": (message(body(id=ABSENT)), m.HEADER_FIELD_MISSING),
    "no warehouse": (message(body(order={"remote_warehouse_id": ABSENT})), m.HEADER_FIELD_MISSING),
    "no id, no lines": (message(body(lines=[], id=ABSENT)), FINE),
    "no lines": (message(body(lines=[])), FINE),
    "line without price": (message(body(lines=[line(), line(raw_price=ABSENT)])), m.LINE_FIELD_MISSING),
    "price null": (message(body(lines=[line(raw_price=None)])), FINE),
}
REASONS = {name: outcome for name, (_, outcome) in CASES.items() if outcome not in (FINE, DROPPED)}


def test_classification(spark):
    judged = m.classify_messages(messages(spark, [v for v, _ in CASES.values()])).collect()
    names = list(CASES)
    got = {names[r.message_seq]: r.error_reason or FINE for r in judged}
    want = {name: outcome for name, (_, outcome) in CASES.items() if outcome != DROPPED}
    assert got == want
    for r in judged:
        assert r.value == (CASES[names[r.message_seq]][0] if r.error_reason else None)


def test_classification_splits(spark):
    judged = m.classify_messages(messages(spark, [v for v, _ in CASES.values()]))
    bad, good = m.rejected(judged), m.sound_headers(judged)
    assert bad.columns == ["message_seq", "value", "error_reason"]
    assert bad.count() == len(REASONS)
    assert good.count() == sum(outcome == FINE for _, outcome in CASES.values())
    quarantined = m.order_headers(
        messages(spark, [v for v, _ in CASES.values()]), JobConfig(on_error="quarantine")
    )
    assert sorted(r.message_seq for r in quarantined.collect()) == sorted(r.message_seq for r in good.collect())


@pytest.mark.parametrize("name", list(REASONS))
def test_malformed_message_stops_the_query(spark, name):
    value = CASES[name][0]
    with pytest.raises(Exception, match=REASONS[name]):
        m.order_lines(messages(spark, [message(), value])).collect()


def test_sound_messages_do_not_stop_it(spark):
    values = [v for v, outcome in CASES.values() if outcome in (FINE, DROPPED)]
    lines = m.order_lines(messages(spark, values)).collect()
    assert len(lines) == sum(o == FINE and "no lines" not in n for n, (_, o) in CASES.items())


def one(spark, value, cfg=JobConfig()):
    return m.order_lines(messages(spark, [value]), cfg).collect()


def test_lines_of_an_order(spark):
    lines = [line(product_code="A", quantity=7), line(product_code="B", quantity=3, remote_order_item_id=2)]
    rows = sorted(one(spark, message(body(lines=lines))), key=lambda r: r.line_pos)
    assert [(r.product_code, r.quantity, r.line_number, r.remote_order_item_id) for r in rows] == [
        ("A", 7, "7", "1"),
        ("B", 3, "3", "2"),
    ]
    assert {(r.id, r.order_date, r.paid_at) for r in rows} == {
        ("1", "2023-12-20 18:47:34", "2023-12-20 19:00:00")
    }


def test_line_number_by_position(spark):
    rows = one(spark, message(body(lines=[line(quantity=7), line(quantity=7)])), JobConfig(line_number="position"))
    assert sorted(r.line_number for r in rows) == ["1", "2"]


def test_quotes_and_nulls(spark):
    value = message(body(brand_id="O'X", order={"customer_reference": None, "order_status": {"a": 1}}))
    (row,) = one(spark, value)
    assert (row.brand_id, row.customer_reference, row.order_status) == ("O''X", "null", "")
    (row,) = one(spark, value, JobConfig(escape_quotes=False, null_text=None))
    assert (row.brand_id, row.customer_reference, row.order_status) == ("O'X", None, "")


def test_null_text_does_not_hide_a_missing_field(spark):
    value = message(body(brand_id=ABSENT))
    with pytest.raises(Exception, match=m.HEADER_FIELD_MISSING):
        one(spark, value, JobConfig(null_text=None))


def test_dirty_numbers(spark):
    (row,) = one(spark, message(body(lines=[line(raw_price="12.5", quantity="3.7", line_total="abc", discount_amount=None)])))
    assert (row.raw_price, row.quantity, row.line_total, row.discount_amount) == (12.5, 3, 0.0, 0.0)


def test_dates_to_utc(spark):
    (row,) = one(spark, message(), JobConfig(to_utc=True))
    assert (row.order_date, row.paid_at) == ("2023-12-20 11:47:34", "2023-12-20 19:00:00")


def test_order_with_very_many_lines(spark):
    rows = m.order_lines(messages(spark, [message(body(lines=[line(quantity=i) for i in range(5000)]))]))
    assert rows.count() == 5000 and rows.selectExpr("sum(quantity)").first()[0] == sum(range(5000))


# --- repeated fields


REPEATING = '{"x": 1, "x": {"y": 2, "y": 3}}'


def read(spark, *values):
    judged = m.classify_messages(messages(spark, values), JobConfig(on_error="quarantine"))
    return {r.message_seq: r for r in judged.collect()}


def test_repeated_fields_of_the_envelope(spark):
    whole, shpe = message(), '"channel": "shpe"'
    assert shpe in whole
    got = read(
        spark,
        whole[:-1] + f', "other": {REPEATING}}}',
        whole.replace(shpe, f'"channel": {REPEATING}'),
        whole.replace(shpe, f'"channel": {REPEATING}, {shpe}'),
        whole.replace(shpe, f'{shpe}, "channel": {REPEATING}'),
        whole.replace(shpe, f'"channel": [{REPEATING}], "channel": null'),
        f"[{REPEATING}]",
        REPEATING,
        REPEATING[:-2],
        whole.replace(shpe, f"'channel': {REPEATING}, {shpe}"),
        whole.replace(shpe, f'"channel": {REPEATING}, "remote": NaN, {shpe}'),
        whole.replace('"action"', f'"url": {REPEATING}, "action"'),
        message(None, remote_order_status=220, channel="tkpd")[:-1] + f', "x": {REPEATING}, "url": "order-fetched"}}',
    )
    reasons = {i: r.error_reason for i, r in got.items()}
    assert reasons == {0: None, 2: None} | dict.fromkeys((7, 8, 9), "envelope_not_json") | {10: None, 11: None}


def test_repeated_fields_of_the_order(spark):
    whole = json.dumps(body())

    def put(old, new):
        assert old in whole
        return message(whole.replace(old, new))

    got = read(
        spark,
        put('"id": "1"', f'"id": {REPEATING}'),
        put('"id": "1"', f'"id": "0", "id": {REPEATING}, "id": 7'),
        put('"customer_reference": "C1"', f'"customer_reference": [{REPEATING}]'),
        put('"raw_price": 10.5', f'"raw_price": {REPEATING}'),
        put('"product_code": "P1"', f'"product_code": "{{}}", "remote": {REPEATING}'),
        put('"product_code": "P1", ', f'"remote": {REPEATING}, '),
        put('"order_status": "F", ', f'"other": {REPEATING}, '),
        put('"line_items": [', f'"line_items": [5, {REPEATING}, '),
        message(whole.replace('"id": "1"', f'"id": {REPEATING}')[:-3]),
        put('"quantity": 2', f'"quantity": {REPEATING}, "quantity": 99999999999'),
    )
    assert [r.error_reason for _, r in sorted(got.items())] == [
        None, None, None, None, None, "line_field_missing", "body_malformed", "body_malformed", "body_malformed", None
    ]
    assert (got[0].id, got[1].id, got[2].customer_reference) == ("", "7", "")
    cfg = JobConfig(on_error="quarantine")
    values = [put('"raw_price": 10.5', f'"raw_price": {REPEATING}'), put('"quantity": 2', f'"quantity": {REPEATING}, "quantity": "12"')]
    values.append(put('"product_code": "P1"', f'"product_code": "{{}}", "remote": {REPEATING}'))
    lines = m.order_lines(messages(spark, values), cfg).orderBy("message_seq").collect()
    assert [(r.raw_price, r.quantity, r.product_code) for r in lines] == [(0.0, 2, "P1"), (10.5, 12, "P1"), (10.5, 2, "{}")]
