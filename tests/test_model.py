"""Randomly damaged messages against a plain Python reading of the same rules."""

from __future__ import annotations

import json
import random

from builders import BODY, ENVELOPE, LINE, ORDER, messages

from orderloom.config import JobConfig
from orderloom.functions.rules import ACTION, FIRST_STATUSES, URL
from orderloom.operators import messages as m

# JSON text of odd values, with their reading as text, double and int.
ODD = {
    '"O\'X"': ("O'X", 0.0, 0),
    '"null"': ("null", 0.0, 0),
    '"[1]"': ("[1]", 0.0, 0),
    '"{}"': ("{}", 0.0, 0),
    '"1.50"': ("1.50", 1.5, 1),
    '"\\u0041b"': ("Ab", 0.0, 0),
    "220": ("220", 220.0, 220),
    "220.0": ("220.0", 220.0, 220),
    "1e2": ("100.0", 100.0, 100),
    "true": ("true", 1.0, 1),
    "null": ("null", 0.0, 0),
    "{}": ("", 0.0, 0),
    '{"a": [1]}': ("", 0.0, 0),
    "[]": ("", 0.0, 0),
    '""': ("", 0.0, 0),
}


def field(rng, plain, chance):
    """JSON text of a field, or None for one left out."""
    draw = rng.random()
    if draw < chance / 4:
        return None
    return rng.choice(list(ODD)) if draw < chance else json.dumps(plain)


def as_text(raw):
    if raw in ODD:
        return ODD[raw][0]
    value = json.loads(raw)
    return value if isinstance(value, str) else raw


def as_number(raw, place):
    if raw in ODD:
        return ODD[raw][place]
    value = json.loads(raw)
    return (float if place == 1 else int)(value) if isinstance(value, (int, float)) else 0


def as_json(fields):
    return "{" + ", ".join(f"{json.dumps(k)}: {v}" for k, v in fields.items() if v is not None) + "}"


def random_case(rng):
    """A message's text and what should become of it."""
    chance = rng.choice([0.0, 0.0, 0.05, 0.2])
    header = {k: field(rng, v, chance) for k, v in BODY.items()}
    order = {k: field(rng, v, chance if k not in ("order_date", "paid_at") else chance / 3) for k, v in ORDER.items()}
    lines = [{k: field(rng, v, chance / 2) for k, v in LINE.items()} for _ in range(rng.randrange(4))]
    raw_lines = [as_json(x) for x in lines]
    odd_line = rng.random() < chance / 4
    if odd_line:
        raw_lines.append(rng.choice(["5", "null", '"x"', "[]"]))
    items = "[" + ", ".join(raw_lines) + "]"
    if rng.random() < chance / 4:
        items = rng.choice(["{}", "null", '"x"', None])
    order_text = as_json(order | {"line_items": items})
    if rng.random() < chance / 8:
        order_text = rng.choice(["null", "5", "[]", None])
    request = as_json(header | {"order": order_text})
    sound_body = True
    if rng.random() < chance / 8:
        request, sound_body = request[: rng.randrange(1, len(request) - 1)], False

    channel = rng.choice([*FIRST_STATUSES, "SHPE"])
    status = rng.choice(FIRST_STATUSES.get(channel, ["UNPAID"]) * 3 + ["DONE"])
    envelope = {
        "action": field(rng, ENVELOPE["action"], chance),
        "url": field(rng, ENVELOPE["url"], chance),
        "channel": field(rng, channel, chance),
        "remote_order_status": field(rng, status, chance),
        "request_body": json.dumps(request),
    }
    if channel == "tkpd" and rng.random() < 0.5 and status == "220":
        envelope["remote_order_status"] = "220"
    odd_body = rng.random() < chance / 4
    if odd_body:
        envelope["request_body"] = rng.choice([None, "{}", '{"a": 1}', "[1]", "5", "null", '""', '" "', '"[]"'])
    return as_json(envelope), envelope, (header, order, lines, items, order_text, sound_body and not odd_body)


def expected(envelope, parts):
    """(outcome, lines) by the rules, one after the other."""
    e = envelope
    if e["action"] is None or e["url"] is None:
        return "dropped", None
    if e["channel"] is None or e["remote_order_status"] is None:
        return m.ENVELOPE_FIELD_MISSING, None
    channel, status = as_text(e["channel"]), as_text(e["remote_order_status"])
    if as_text(e["action"]) != ACTION or as_text(e["url"]) != URL or status not in FIRST_STATUSES.get(channel, []):
        return "dropped", None
    body = e["request_body"]
    if body is None:
        return m.BODY_MISSING, None
    if body[0] in "{[" or body == '""':
        return "dropped", None
    header, order, lines, items, order_text, sound = parts
    if not sound or order_text in ("null", "5", "[]", None) or items in ("{}", "null", '"x"', None):
        return m.BODY_MALFORMED, None
    others = json.loads(items)[len(lines):]
    if any(x is not None and not isinstance(x, dict) for x in others):
        return m.BODY_MALFORMED, None
    if any(order[k] is None for k in ("order_status", "order_date", "paid_at")):
        return m.BODY_MALFORMED, None
    dates = {}
    for k in ("order_date", "paid_at"):
        text = as_text(order[k])
        if text == ORDER[k]:
            dates[k] = text[:19].replace("T", " ")
        elif text == "null":
            dates[k] = "0000-01-01 00:00:00"
        else:
            return m.BAD_DATE, None
    fields = header | order
    if (lines or others) and None in fields.values():
        return m.HEADER_FIELD_MISSING, None
    if others or any(None in x.values() for x in lines):
        return m.LINE_FIELD_MISSING, None

    def text(raw):
        return as_text(raw).replace("'", "''")

    shared = {k: dates[k] if k in dates else text(v) for k, v in fields.items()} if lines else {}
    return "fine", [
        shared
        | {
            k: as_number(v, 1) if k in ("raw_price", "line_total", "discount_amount")
            else as_number(v, 2) if k == "quantity" else text(v)
            for k, v in x.items()
        }
        | {"line_number": str(as_number(x["quantity"], 2)), "line_pos": i}
        for i, x in enumerate(lines)
    ]


def test_random_messages(spark):
    rng = random.Random(11)
    cases = [random_case(rng) for _ in range(6000)]
    want = [expected(envelope, parts) for _, envelope, parts in cases]
    assert len({outcome for outcome, _ in want}) == 8
    frame = messages(spark, [text for text, _, _ in cases]).repartition(4)

    judged = m.classify_messages(frame).select("message_seq", "error_reason").collect()
    got = {r.message_seq: r.error_reason or "fine" for r in judged}
    for i, (outcome, _) in enumerate(want):
        assert got.get(i, "dropped") == outcome, cases[i][0]

    lines = m.order_lines(frame, JobConfig(on_error="quarantine")).collect()
    found = {(r.message_seq, r.line_pos): r.asDict() for r in lines}
    listed = {(i, x["line_pos"]): x | {"message_seq": i} for i, (_, rows) in enumerate(want) for x in rows or []}
    assert len(listed) > 2000
    assert found == listed
