"""Expected results in SQL, stated on the tables; none of them sees a JSON text."""

from __future__ import annotations

from orderloom import fixtures as fx
from orderloom import schemas as S
from orderloom.plans import registered as R

# --- lookup tables

_MARKETPLACES = ", ".join(f"('{mp}', '{mk}')" for mp, mk in fx.MARKETPLACES)
CHANNELS = f"""channels as (
  select {fx.CHANNEL_CODE} as channel_code, {fx.CHANNEL_NAME} as channel_name
  from supplier cross join (values {_MARKETPLACES}) v(mp, mk))"""


# Channels that are no shops, and stores that go by another name.
_NO_SHOPS = "request|interco|csr|nonevent|reclass|non event|offline"
_B2B = "B2B Beauty|B2B JNS|B2BJNS"
_RENAMED = """(values ('sleek', 'Kino Baby & Kids Official Store'),
  ('ellip', 'Kino Hair & Beauty Care Official Store')) r(prefix, name)"""


def _split(b2b: str) -> str:
    return f"""parts as (
  select string_split(channel_code, '_') as c, string_split(channel_name, '-') as n,
         len(string_split(channel_name, '-')) = 1 and regexp_matches(channel_name, '{b2b}') as by_code
  from channels where not regexp_matches(lower(channel_code), '{_NO_SHOPS}')
), split as (
  select trim(c[1]) as channel_code, lower(trim(c[-1])) as mp_code, trim(n[1]) as marketplace,
         trim(if(by_code, c[-1], n[-1])) as official_store
  from parts)"""


SPLIT = _split(_B2B)


def _stores(greatest: str, grouped: str) -> str:
    """`greatest` gives the brand and the store chosen for each group."""
    return f"""select brand_id,
    coalesce(name, trim(regexp_replace(chosen, '[^-0-9A-Za-z&() ]', '', 'g'))) as official_store
  from (select {greatest} from split where official_store is not null group by {grouped})
  left join {_RENAMED} on starts_with(lower(chosen), prefix)"""


_STORE = _stores("channel_code as brand_id, max(official_store) as chosen", "channel_code")
_LAST_BY = "row(lower(official_store), official_store, channel_code)"
_STORE_ANY_CASE = _stores(
    f"arg_max(channel_code, {_LAST_BY}) as brand_id, arg_max(official_store, {_LAST_BY}) as chosen",
    "lower(channel_code)",
)
_MARKETPLACE = """select mp_code, max(marketplace) as marketplace from split
  where mp_code is not null group by mp_code"""

_DIMENSIONS = f"with {CHANNELS}, {SPLIT}"
_ANY_CASE = f"""with {CHANNELS.replace("channels as", "told as", 1)}, channels as (
  select * from told union all select upper(channel_code), upper(channel_name) from told
  union all select lower(channel_code), lower(channel_name) from told), {_split(f"(?i){_B2B}")}"""

# --- messages

# The channels' first statuses.
_PAIRS = """(('blib','PU'), ('blib','FP'), ('lzda','unpaid'), ('lzda','pending'), ('lzda','packed'),
  ('shpe','PROCESSED'), ('shpe','READY_TO_SHIP'), ('shpe','UNPAID'), ('tkpd','220'),
  ('tktk','accepted'), ('tktk','packed'), ('tktk','unpaid'), ('zlra','pending'))"""
_WANTED = f"{fx.EVENT_URL} = 'order-fetched' and ({fx.CHANNEL}, {fx.STATUS}) in {_PAIRS}"
_DAY = "substring(cast(o_orderdate as varchar), 1, 10)"

_ORDER_DATE = f"concat({_DAY}, ' 00:00:00')"
_PAID_AT = f"""case o_orderkey % 4 when 2 then concat({_DAY}, ' 10:11:12')
    when 3 then concat({_DAY}, ' 23:59:00') else '0000-01-01 00:00:00' end"""
_DAY_TS = "date_trunc('day', o_orderdate)"
_ORDER_DATE_UTC = f"substring(cast({_DAY_TS} - interval 7 hour as varchar), 1, 19)"
_PAID_AT_UTC = f"""case o_orderkey % 4 when 2 then concat({_DAY}, ' 10:11:12')
    when 3 then substring(cast({_DAY_TS} + interval 1 day + interval 4 hour + interval 59 minute as varchar), 1, 19)
    else '0000-01-01 00:00:00' end"""


def _text(sql: str, plain: bool) -> str:
    return sql if plain else f"replace(coalesce({sql}, 'null'), '''', '''''')"


def _headers(plain: bool = False, brand: str | None = None) -> dict[str, str]:
    shown = {f: _text(sql, plain) for f, sql in fx.HEADER.items()}
    shown["order_date"] = _ORDER_DATE_UTC if plain else _ORDER_DATE
    shown["paid_at"] = _PAID_AT_UTC if plain else _PAID_AT
    if brand:
        shown["brand_id"] = brand
    return shown


def _named(shown: dict[str, str]) -> str:
    return ", ".join(f"{sql} as {f}" for f, sql in shown.items())


def _lines(
    wanted: str = _WANTED, plain: bool = False, brand: str | None = None, changed: dict[str, str] | None = None
) -> str:
    texts = ("product_code", "product_description", "remote_order_item_id")
    line = {f: _text(sql, plain) if f in texts else sql for f, sql in fx.LINE.items()}
    line["line_number"] = f"cast({'i' if plain else fx.LINE['quantity']} as varchar)"
    shown = _headers(plain, brand) | line
    shown |= {f: f"case when {fx.HAS_LATER} then {sql} else {shown[f]} end" for f, sql in (changed or {}).items()}
    return f"""lines as (
  select o_orderkey, cast(i - 1 as integer) as line_pos, {_named(shown)}
  from orders, (select cast(unnest(range(1, {fx.MAX_LINES + 1})) as integer) as i)
  where i <= {fx.LINE_COUNT} and {wanted})"""


def _enriched(lines: str, no_marketplace: str = "'null'", loaded: bool = False) -> str:
    shown = {
        "shop_name": "coalesce(s.official_store, l.shop_name)",
        "marketplace": f"coalesce(m.marketplace, {no_marketplace})",
    }
    columns = ", ".join(f"{shown.get(c, 'l.' + c)} as {c}" for c in R.CHECKED)
    columns += f", '{R.LOADED}' as load_timestamp" if loaded else ""
    return f"""{_DIMENSIONS}, store as ({_STORE}), marketplace as ({_MARKETPLACE}), {lines}
select {columns} from lines l left join store s on l.brand_id = s.brand_id
left join marketplace m on l.channel_code = m.mp_code"""


ENRICHED = _enriched(_lines())

_SHIP_DAY = "substring(cast(l_shipdate as varchar), 1, 10)"
_ITEMS = {f: _text(sql, False) for f, sql in (fx.ITEM_HEADER | fx.ITEM_LINE).items()}
_ITEMS |= {f: fx.ITEM_LINE[f] for f in ("raw_price", "quantity", "line_total", "discount_amount")}
_ITEMS |= {"order_date": f"concat({_SHIP_DAY}, ' 00:00:00')", "paid_at": f"concat({_SHIP_DAY}, ' 10:11:12')"}
_ITEMS |= {"line_number": f"cast({fx.ITEM_LINE['quantity']} as varchar)"}

# Of what a second message says, these take effect; references and line number stay as first told.
_RENEWED = {f: (fx.LATER | fx.LATER_LINE)[f] for f in ("order_status", "raw_price", "quantity")}

_FAULT = f"o_orderkey % {fx.DIRTY_MODULUS}"
_HAS_LINES = f"{fx.LINE_COUNT} > 0"
_OUTCOME = f"""case when {_FAULT} = {fx.CUT_SHORT} then 'envelope_not_json'
    when {_FAULT} = {fx.NO_CHANNEL} then 'envelope_field_missing'
    when {_FAULT} in ({fx.BODY_OBJECT}, {fx.BLANK}, {fx.ARRAY}, {fx.NO_ACTION}) or not ({_WANTED}) then 'dropped'
    when {_FAULT} = {fx.NO_BODY} then 'request_body_missing'
    when {_FAULT} in ({fx.NO_LINES}, {fx.LINES_OBJECT}, {fx.BODY_CUT_SHORT}) then 'body_malformed'
    when {_FAULT} = {fx.LINE_NUMBER_ONLY} and {_HAS_LINES} then 'body_malformed'
    when {_FAULT} in ({fx.UNZONED_DATE}, {fx.DATE_WORD}) then 'date_not_iso_zoned'
    when {_FAULT} = {fx.NO_WAREHOUSE} and {_HAS_LINES} then 'header_field_missing'
    when {_FAULT} = {fx.NO_PRODUCT} and {_HAS_LINES} then 'line_field_missing'
    else 'sound' end"""
_DIRTY_BRAND = f"case when {_FAULT} = {fx.NULL_BRAND} then 'null' else {fx.HEADER['brand_id']} end"


_REPEATS = f"o_orderkey % {fx.REPEAT_MODULUS}"


def _choice(values: list[str], by: str = "o_orderkey") -> str:
    cases = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"case {by} % {len(values)} {cases} end"


def _quoted(values: list[str]) -> list[str]:
    return ["'" + v.replace("'", "''") + "'" for v in values]


# --- value functions: what each of R.JSON_VALUES reads as

_AS_TEXT = [
    "text", "[1]", "12", "1.5", "2.0", "1000.0", "12345678901234567890", "true", "null", "", "",
    "12.5", "abc", "3.7", "3.7", "-7", " 7 ", "99999999999", "99999999999", "1.0E300", "",
]
_AS_DOUBLE = [
    "0.0", "0.0", "12.0", "1.5", "2.0", "1000.0", "12345678901234567890.0", "1.0", "0.0", "0.0", "0.0",
    "12.5", "0.0", "3.7", "3.7", "-7.0", "7.0", "99999999999.0", "99999999999.0", "1e300", "0.0",
]
_AS_INT = [
    "0", "0", "12", "1", "2", "1000", "-350287150", "1", "0", "0", "0",
    "12", "0", "3", "3", "-7", "7", "1215752191", "0", "2147483647", "0",
]
_NULL_AT = R.JSON_VALUES.index("null")

# --- date-time texts: what each of R.DATE_TAILS reads as, behind the day
_WALL_TAILS = [
    "' 18:47:34'", "' 18:47:00'", "' 02:30:00'", "null", "null", "null", "' 23:59:59'",
    "null", "null", "' 18:47:34'", "' 01:02:03'", "+1 01:47:34", "null",
]
_NEXT_DAY = "substring(cast(date_trunc('day', o_orderdate) + interval 1 day as varchar), 1, 10)"
_LAST_DAY = "substring(cast(date_trunc('day', o_orderdate) - interval 1 day as varchar), 1, 10)"


def _on(tail: str) -> str:
    if tail.startswith("+1"):
        return f"concat({_NEXT_DAY}, '{tail[2:]}')"
    if tail.startswith("-1"):
        return f"concat({_LAST_DAY}, '{tail[2:]}')"
    return "null" if tail == "null" else f"concat({_DAY}, {tail})"


_UTC_TAILS = [
    "' 11:47:34'", "' 18:47:00'", "' 07:30:00'", "null", "null", "null", "' 23:59:59'",
    "null", "null", "' 11:47:34'", "-1 18:02:03", "' 18:47:34'", "null",
]


def _date_choice(tails: list[str]) -> str:
    return (
        "case when o_orderkey % 29 = 0 then '0000-01-01 00:00:00' else "
        f"{_choice([_on(t) for t in tails])} end"
    )


# --- upserts

_BATCHED = f"""rows as (select {fx.BATCH_ID} as batch_id,
  {", ".join(f"{'cast(l_shipdate as varchar)' if c == 'load_timestamp' else sql} as {c}"
             for c, sql in fx.BATCH_LINE.items())},
  {", ".join(fx.LINE_ORDER)} from lineitem)"""


def _upserted(keys: list[str], apart: str | None = None) -> str:
    """The state by `keys`; the id is NULL, and the row kept apart, where `apart` holds."""
    by = ", ".join(keys)
    order = ["batch_id", *fx.LINE_ORDER]
    up, down = ", ".join(order), ", ".join(f"{c} desc" for c in order)
    columns = ", ".join(f"{'f' if c in S.FIRST_WINS else 'l'}.{c} as {c}" for c in S.SINK_COLUMNS)
    joined = " and ".join(f"f.{k} = l.{k}" for k in keys)
    loose = "" if apart is None else f"""
union all select {", ".join("null as id" if c == "id" else c for c in S.SINK_COLUMNS)} from rows where {apart}"""
    return f"""with {_BATCHED},
  ranked as (select *, row_number() over (partition by {by} order by {up}) as from_first,
                       row_number() over (partition by {by} order by {down}) as from_last
             from rows where not ({apart or "false"}))
select {columns} from ranked f join ranked l on {joined} where f.from_first = 1 and l.from_last = 1{loose}"""


ORACLES: dict[str, str] = {
    "oms_channel_clean": f"{_DIMENSIONS} select distinct * from split",
    "master_store": f"{_DIMENSIONS} {_STORE}",
    "master_store_agg": f"{_DIMENSIONS} {_STORE}",
    "master_store_any_case": (
        f"with {CHANNELS}, {_split(f'(?i){_B2B}')} {_STORE_ANY_CASE}"
    ),
    "oms_channel_any_case": f"""{_ANY_CASE} select unnest(row) from (
  select min({{'channel_code': channel_code, 'mp_code': mp_code, 'official_store': official_store,
               'marketplace': marketplace}}) as row from split
  group by lower(channel_code), lower(mp_code), lower(official_store), lower(marketplace))""",
    "master_store_any_case_windowed": f"{_ANY_CASE} {_STORE_ANY_CASE}",
    "master_marketplace_any_case": f"""{_ANY_CASE}
select mp_code, arg_max(marketplace, row(lower(marketplace), marketplace)) as marketplace
from split where mp_code is not null group by mp_code""",
    "master_marketplace": f"{_DIMENSIONS} {_MARKETPLACE}",
    "master_marketplace_agg": f"{_DIMENSIONS} {_MARKETPLACE}",
    "dimension_key_check": f"""{_DIMENSIONS}, pairs as (select distinct * from split)
select channel_code as brand_id, count(*) as n_rows from pairs group by 1 having count(*) > 1""",
    "envelope_filter": f"""select o_orderkey as message_seq, {fx.CHANNEL} as channel,
  {fx.STATUS} as remote_order_status, cast(o_orderkey as varchar) as id from orders where {_WANTED}""",
    "first_status_filter": f"""select * from (select o_orderkey, {_choice(_quoted(R.TRIED_CHANNELS))} as channel,
  {_choice(_quoted(R.TRIED_STATUSES))} as status from orders) where (channel, status) in {_PAIRS}""",
    "order_headers": f"select o_orderkey as message_seq, {_named(_headers())} from orders where {_WANTED}",
    "order_lines": f"with {_lines()} select * exclude (o_orderkey) from lines",
    "quarantine_split": f"""select * from (select o_orderkey as message_seq, {_OUTCOME} as outcome
  from orders) where outcome <> 'dropped'""",
    "quarantine_rejects": f"""select message_seq, true as has_text, outcome as error_reason from (
  select o_orderkey as message_seq, {_OUTCOME} as outcome from orders) where outcome not in ('dropped', 'sound')""",
    "quarantine_lines": _enriched(_lines(f"{_OUTCOME} = 'sound'", brand=_DIRTY_BRAND)),
    "envelope_repeated_fields": f"""with {_lines()}
select o_orderkey as message_seq, line_pos, case {_REPEATS} when {fx.IN_ID} then '' else id end as id,
  case {_REPEATS} when {fx.IN_REFERENCE} then '' else customer_reference end as customer_reference,
  case {_REPEATS} when {fx.IN_QUANTITY} then 0 else quantity end as quantity,
  case {_REPEATS} when {fx.IN_QUANTITY} then '0' else line_number end as line_number
from lines where {_REPEATS} not in ({fx.IN_CHANNEL}, {fx.IN_CUT_SHORT})
union all select o_orderkey, null, 'envelope_not_json', null, null, null from orders
where {_REPEATS} = {fx.IN_CUT_SHORT}""",
    "json_as_text": f"""select o_orderkey, {_choice(_quoted(_AS_TEXT))} as v,
  case when o_orderkey % {len(_AS_TEXT)} <> {_NULL_AT} then {_choice(_quoted(_AS_TEXT))} end as v_or_null,
  cast(o_totalprice as varchar) as price_text, cast(null as varchar) as absent from orders""",
    "numeric_coerce": f"""select o_orderkey, cast({_choice(_AS_DOUBLE)} as double) as v_double,
  cast({_choice(_AS_INT)} as integer) as v_int, o_totalprice as price_double,
  cast(trunc(o_totalprice) as integer) as price_int, o_totalprice as price_text_double,
  cast(trunc(o_totalprice) as integer) as price_text_int from orders""",
    "quote_escape": """select o_orderkey,
  concat(o_orderpriority, '''''', cast(o_orderkey as varchar), '''''''''', o_orderstatus) as escaped from orders""",
    "timestamp_normalize": f"""select o_orderkey, {_date_choice(_WALL_TAILS)} as wall,
  {_date_choice(_UTC_TAILS)} as utc from orders""",
    "store_lookup": f"""{_DIMENSIONS}, store as ({_STORE}),
  headers as (select {_named(_headers())} from orders where {_WANTED})
select h.id, h.brand_id, coalesce(s.official_store, h.shop_name) as shop_name
from headers h left join store s on h.brand_id = s.brand_id""",
    "marketplace_lookup": f"""{_DIMENSIONS}, marketplace as ({_MARKETPLACE}),
  headers as (select {_named(_headers())} from orders where {_WANTED})
select h.id, h.channel_code, coalesce(m.marketplace, 'null') as marketplace
from headers h left join marketplace m on h.channel_code = m.mp_code""",
    "order_lines_enriched": _enriched(_lines(), loaded=True),
    "order_lines_from_lineitem": _enriched(f"lines as (select {_named(_ITEMS)} from lineitem)", loaded=True),
    "order_lines_shuffled": ENRICHED,
    "order_lines_plain": _enriched(_lines(plain=True), "null"),
    "append_lines": f"with {_BATCHED} select {', '.join(S.APPEND_COLUMNS)} from rows",
    "upsert_latest": _upserted(["id", "remote_order_item_id"]),
    "upsert_null_keys": _upserted(["id", "remote_order_item_id"], "cast(id as bigint) % 7 = 0"),
    "upsert_first_last_policy": _upserted(["id"]),
    "upsert_touched_buckets": _upserted(["id"]),
    "stream_order_lines": ENRICHED,
    "stream_committed_batches": f"""select o_orderkey % 2 as batch_id, o_orderkey as message_seq,
  case when outcome = 'sound' then {fx.LINE_COUNT} else 0 end as n_lines
  from (select *, {_OUTCOME} as outcome from orders)
  where outcome not in ('dropped', 'sound') or outcome = 'sound' and {_HAS_LINES}""",
    "stream_upsert_state": _enriched(_lines(changed=_RENEWED)),
    "stream_state_after_compaction": _enriched(_lines(changed=_RENEWED)),
}
