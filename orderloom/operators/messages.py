"""From JSON message texts to typed order lines.

A message is a JSON envelope whose `request_body` is the order, again as JSON text. A quick reading of
four texts drops sound messages of other events; what is left is parsed strictly, once as an envelope and
once as an order, by `from_json` with VARIANT leaves, which tell a value's kind. The strict
reading of an envelope is spared where the quick one leaves nothing open. The values of an order come from a plain
reading beside the strict one, which costs far less than to take each string out of its VARIANT.

Values that are tested and then used are to be computed once, but Catalyst copies a plainly projected
expression into every filter above it. It does not copy out of a generator, so the strict readings are
generators (`inline` of a one-element array); these are evaluated without code generation, however. What
follows them are projections, kept apart from filters by `_settled`.

Input frames have a `value` column; all other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom import schemas as S
from orderloom.config import JobConfig
from orderloom.functions import rules
from orderloom.functions.json_values import as_int, as_number, as_text, finite, kind_of
from orderloom.functions.text import quote_escape
from orderloom.functions.times import normalize_ts

# Reasons a message is rejected for.
NOT_JSON = "envelope_not_json"
ENVELOPE_FIELD_MISSING = "envelope_field_missing"
BODY_MISSING = "request_body_missing"
BODY_MALFORMED = "body_malformed"
BAD_DATE = "date_not_iso_zoned"
HEADER_FIELD_MISSING = "header_field_missing"
LINE_FIELD_MISSING = "line_field_missing"

_STRICT_JSON = f"""map('columnNameOfCorruptRecord', '{S.BAD}',
    'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"""
_DATES = ("order_date", "paid_at")
_AMOUNTS = ("raw_price", "line_total", "discount_amount")


def _once(df: DataFrame, keep: list[str], row: str) -> DataFrame:
    """`keep` and the fields of the struct `row`, each computed a single time."""
    return df.selectExpr(*keep, f"inline(array({row}))")


def _struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{name.strip('`')!r}, {sql}' for name, sql in fields.items())})"


def _parse(df: DataFrame, column: str, ddl: str, keep: list[str]) -> DataFrame:
    return _once(df, keep, f"from_json({column}, '{ddl}', {_STRICT_JSON})")


def _field(text: str, name: str, kind: str) -> str:
    return f"from_json({text}, '`{name}` {kind}', {_STRICT_JSON}).`{name}`"


def _reread(text: str, name: str, plain: str) -> str:
    """A field of an object's JSON text, by itself: the last value if the field repeats, which `plain` is the text of. An
    object or array in which a field repeats is not read as a value; as any other, it counts as an empty object."""
    pair = f"named_struct('v', {_field(text, name, 'variant')}, 's', {plain})"
    there = f"array_contains(json_object_keys({text}), {name!r})"
    # What has been read may be a value that another one has followed.
    last = "try_variant_get(p.v, '$', 'string') = p.s"
    value = f"""case when p.s is null then if({there}, parse_json('null'), null) when {last} then p.v
        when p.s like '{{%' or p.s like '[%' then parse_json('{{}}') else cast(p.s as variant) end"""
    return f"get(transform(array({pair}), p -> {value}), 0)"


def _let(name: str, value: str, result: str) -> str:
    """`result`, in which `name` stands for `value`."""
    return f"get(transform(array({value}), {name} -> {result}), 0)"


def _settled(sql: str) -> str:
    """The same value, but not deterministic to Catalyst, which then leaves filters on it above the projection it is in."""
    return f"if(spark_partition_id() < 0, null, {sql})"


def _tolerant(parsed: DataFrame, keep: list[str], plain: str, fields: list[str], again: str) -> DataFrame:
    """A strict reading in which sound JSON is not flagged because a field repeats inside a value. What is flagged is read
    once more with plain texts as leaves (`plain`), which tells whether it is sound, and then field by field.
    `again`: a struct of `fields` read so; it may refer to the plain reading as `_plain`. `_exact`: not flagged by the first reading."""
    sound = f"_plain is not null and _plain.{S.BAD} is null"
    told = parsed.selectExpr(
        *dict.fromkeys([*keep, *fields]),
        S.BAD,
        f"if({S.BAD} is null, null, {_let('_plain', plain, f'if({sound}, {again}, null)')}) as _again",
    )
    return told.selectExpr(
        *keep,
        *[f"if(_again is null, {f}, _again.{f}) as {f}" for f in fields],
        f"if(_again is null, {S.BAD}, null) as {S.BAD}",
        f"{S.BAD} is null as _exact",
    )


def _any_missing(fields: list[str]) -> str:
    return f"({' or '.join(f'{f} is null' for f in fields)})"


def _carried(messages: DataFrame) -> list[str]:
    return [c for c in messages.columns if c != "value"]


_EVENT_FIELDS = [f for f in S.ENVELOPE_FIELDS if f != "request_body"]
_WANTED = rules.wanted_event(*_EVENT_FIELDS)


# The fields of the quick reading.
_QUICK = {f: f"_{f}_quick" for f in S.ENVELOPE_FIELDS}


def _candidates(messages: DataFrame, keep: list[str]) -> DataFrame:
    """Leave out sound messages of other events, after a parse that reads four plain texts. These are kept, and the body.

    Plain texts do not tell a JSON null from a missing field, so messages lacking one stay, as do
    those that do not parse; the strict reading decides on them. It has nothing to add where the four texts are
    those of a wanted event (`_sure`), as each of these texts has only one reading.
    """
    ddl = ", ".join(f"{f} string" for f in _EVENT_FIELDS)
    read = _parse(messages, "value", f"{ddl}, request_body variant, {S.BAD} string", keep)
    found = read.where(f"{S.BAD} is not null or {_any_missing(_EVENT_FIELDS)} or ({_WANTED})")
    sure = f"{S.BAD} is null and not {_any_missing(_EVENT_FIELDS)} as _sure"
    return found.selectExpr(*keep, *[f"{f} as {q}" for f, q in _QUICK.items()], sure)


def _read_envelopes(messages: DataFrame, keep: list[str]) -> DataFrame:
    """Messages that are wanted or rejected; the others are dropped here."""
    kept = [*keep, *({"value"} - set(keep))]
    quick = [*_QUICK.values(), "_sure"]
    parsed = _parse(_candidates(messages, kept), "if(_sure, null, value)", S.ENVELOPE_DDL, [*kept, *quick])
    plain = f"from_json(value, '{S.plain_texts(S.ENVELOPE_DDL)}', {_STRICT_JSON})"
    again = _struct({f: _reread("value", f, f"_plain.{f}") for f in S.ENVELOPE_FIELDS})
    told = _tolerant(parsed, [*kept, *quick], plain, S.ENVELOPE_FIELDS, again)
    body = f"if(_sure, {_QUICK['request_body']}, request_body)"
    known = told.selectExpr(
        *kept,
        S.BAD,
        "_sure",
        *[_QUICK[f] for f in _EVENT_FIELDS],
        *_EVENT_FIELDS,
        *[f"{kind_of(f)} as _{f}_kind" for f in _EVENT_FIELDS],
        f"{body} as request_body",
        f"{kind_of(body)} as _request_body_kind",
    )
    texts = {f: as_text(f, kind=f"_{f}_kind") for f in S.ENVELOPE_FIELDS}
    texts |= {f: f"if(_sure, {_QUICK[f]}, {texts[f]})" for f in _EVENT_FIELDS}
    read = known.selectExpr(*kept, S.BAD, *[f"{sql} as {f}" for f, sql in texts.items()])

    # Flagged values that still parse are JSON of another kind than an object: not for us.
    other = f"(try_parse_json(value) is not null or from_json(value, 'array<string>', {_STRICT_JSON}) is not null)"
    not_json = f"({S.BAD} is not null and not {other})"
    addressed = "(action is not null and url is not null)"
    wanted = f"({addressed} and {_WANTED})"
    reason = f"""case when {not_json} then '{NOT_JSON}'
        when {addressed} and {_any_missing(['channel', 'remote_order_status'])} then '{ENVELOPE_FIELD_MISSING}'
        when {wanted} and request_body is null then '{BODY_MISSING}' end"""
    shown = [*keep, "channel", "remote_order_status", "request_body"]
    # A body that is an object or array has no text, and a message without text is dropped.
    judged = read.selectExpr(*shown, f"{_settled(reason)} as error_reason", f"{wanted} and request_body <> '' as _asked")
    return judged.where("error_reason is not null or _asked").select(*shown, "error_reason")


def _admit(df: DataFrame, reason: str, on_error: str) -> DataFrame:
    if on_error == "quarantine":
        return df.where(f"{reason} is null")
    stop = f"cast(raise_error(concat('malformed message: ', {reason})) as boolean)"
    return df.where(f"case when {reason} is null then true else {stop} end")


def envelope_filter(messages: DataFrame, on_error: str = "fail") -> DataFrame:
    """Messages of the wanted event and a first status, with the order's JSON text."""
    read = _read_envelopes(messages, _carried(messages))
    return _admit(read, "error_reason", on_error).drop("error_reason")


def _text(x: str, cfg: JobConfig, kind: str, plain: str) -> str:
    text = as_text(x, cfg.null_text, kind, plain)
    return quote_escape(text) if cfg.escape_quotes else text


def _read_bodies(envelopes: DataFrame, keep: list[str], cfg: JobConfig) -> DataFrame:
    """`keep`, the ten header columns, `line_items` and what is wrong with the body, if anything. A line item has its
    strict reading, `_lines`, and its plain one, `_texts`, whose fields are NULL where the strict one does not hold."""
    plain = f"from_json(request_body, '{S.plain_texts(S.BODY_DDL)}', {_STRICT_JSON})"
    both = envelopes.selectExpr(*keep, "request_body", f"{plain} as _body")
    parsed = _parse(both, "request_body", S.BODY_DDL, [*keep, "request_body", "_body"])
    order = {c: _reread("_order", c, f"_plain.`order`.{c}") for c in S.ORDER_FIELDS}
    line = _struct({f: _reread("t", f, f"_plain.`order`.line_items[i].{f}") for f in S.LINE_FIELDS})
    order["line_items"] = f"transform({_field('_order', 'line_items', 'array<string>')}, (t, i) -> {line})"
    again = {c: _reread("request_body", c, f"_plain.{c}") for c in S.BODY_FIELDS}
    again["`order`"] = _let("_order", _field("request_body", "order", "string"), _struct(order))
    told = _tolerant(parsed, [*keep, "_body"], "_body", list(again), _struct(again))
    exact = f"(_exact and _body.{S.BAD} is null)"
    header = {c: c for c in S.BODY_FIELDS} | {c: f"`order`.{c}" for c in S.ORDER_FIELDS}
    known = told.selectExpr(
        *keep,
        S.BAD,
        *[f"{x} as {c}" for c, x in header.items()],
        *[f"{kind_of(x)} as _{c}_kind" for c, x in header.items()],
        *[f"if({exact}, _body.{x}, null) as _{c}_text" for c, x in header.items()],
        "`order`.line_items as _lines",
        f"coalesce(if({exact}, _body.`order`.line_items, null), array()) as _texts",
    )
    texts = {
        c: as_text(c, kind=f"_{c}_kind", plain=f"_{c}_text") if c in _DATES else _text(c, cfg, f"_{c}_kind", f"_{c}_text")
        for c in header
    }
    required = ["order_status", *_DATES, "_lines"]
    line_lacks = _any_missing(["li", *[f"li.{f}" for f in S.LINE_FIELDS]])
    read = known.selectExpr(
        *keep,
        *[f"{sql} as {c}" for c, sql in texts.items()],
        "arrays_zip(_lines, _texts) as line_items",
        f"{S.BAD} is not null or {_any_missing(required)} as malformed",
        # Header fields are read line by line: an order without lines is not asked for them.
        f"size(_lines) > 0 and {_any_missing(list(header))} as header_lacks",
        f"exists(_lines, li -> {line_lacks}) as line_lacks",
    )
    others = [c for c in read.columns if c not in _DATES]
    dated = read.selectExpr(*others, *[f"{normalize_ts(c, cfg.to_utc)} as {c}" for c in _DATES])
    reason = f"""case when malformed then '{BODY_MALFORMED}' when {_any_missing(_DATES)} then '{BAD_DATE}'
        when header_lacks then '{HEADER_FIELD_MISSING}' when line_lacks then '{LINE_FIELD_MISSING}' end"""
    return dated.selectExpr(*keep, *S.HEADER_COLUMNS, "line_items", f"{_settled(reason)} as body_reason")


def order_headers(messages: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """One row per wanted order: its ten header columns and `line_items`, still to be exploded."""
    read = _read_bodies(envelope_filter(messages, cfg.on_error), _carried(messages), cfg)
    return _admit(read, "body_reason", cfg.on_error).drop("body_reason")


def explode_lines(headers: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """One typed row per line item; an order without lines gives none.

    The outer generator and the filter after it keep Catalyst from testing `line_items` before the
    check that stops at malformed messages.
    """
    header = [c for c in headers.columns if c != "line_items"]
    lines = headers.selectExpr(*header, "posexplode_outer(line_items) as (line_pos, line)")
    known = lines.where("line_pos is not null").selectExpr(
        *header,
        "line_pos",
        *[f"line._lines.{f} as _{f}" for f in S.LINE_FIELDS],
        *[f"{kind_of(f'line._lines.{f}')} as _{f}_kind" for f in S.LINE_FIELDS],
        *[f"line._texts.{f} as _{f}_text" for f in S.LINE_FIELDS],
    )
    leaves = {f: (f"_{f}", f"_{f}_kind", f"_{f}_text") for f in S.LINE_FIELDS}
    read = {f: as_number(*leaf) if f in _AMOUNTS else _text(leaf[0], cfg, *leaf[1:]) for f, leaf in leaves.items()}
    # Also keeps this projection, which is large, out of the methods compiled for the steps around it.
    read["quantity"] = _let("n", as_number(*leaves["quantity"]), as_int(*leaves["quantity"], "n"))
    typed = known.selectExpr(*header, "line_pos", *[f"{sql} as {f}" for f, sql in read.items()])
    number = "quantity" if cfg.line_number == "quantity" else "line_pos + 1"
    shown = [f"{finite(f)} as {f}" if f in _AMOUNTS else f for f in S.LINE_FIELDS]
    return typed.selectExpr(*header, "line_pos", *shown, f"cast({number} as string) as line_number")


def order_lines(messages: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    return explode_lines(order_headers(messages, cfg), cfg)


def classify_messages(messages: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Wanted and malformed messages with `error_reason` (NULL: sound), parsed once.

    The result holds what both outcomes need: keep it (`persist`) to write the two without
    parsing again, then take `sound_headers` and `rejected`.
    """
    envelopes = _read_envelopes(messages, messages.columns)
    read = _read_bodies(envelopes, [*messages.columns, "error_reason"], cfg)
    reason = "coalesce(error_reason, body_reason)"
    return read.selectExpr(
        *_carried(messages),
        f"if({reason} is null, null, value) as value",
        f"{reason} as error_reason",
        *S.HEADER_COLUMNS,
        "line_items",
    )


def sound_headers(classified: DataFrame) -> DataFrame:
    return classified.where("error_reason is null").drop("value", "error_reason")


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where("error_reason is not null").drop(*S.HEADER_COLUMNS, "line_items")
