"""Date-time text expressions. All work on wall clocks, so the session time zone plays no part."""

from __future__ import annotations

from orderloom.functions import quoted

# The date that stands for "none" in a message, and its text in the table.
NO_DATE_IN = "0001-01-01T00:00:00Z"
NO_DATE_OUT = "0000-01-01 00:00:00"

# An ISO date-time with an offset and perhaps a region: seconds, a fraction of up to nine digits
# and the offset's minutes may be left out; the offset is at most 18 hours; letters in any case.
ISO_ZONED = (
    r"^(?i)\d{4}-\d\d-\d\dT\d\d:\d\d(:\d\d(\.\d{0,9})?)?"
    r"(Z|[+-]((0\d|1[0-7])(:[0-5]\d(:[0-5]\d)?)?|18(:00(:00)?)?))"
    r"(\[[^\]]+\])?$"
)
_OFFSET = r"([Zz]|[+-][\d:]+)$"


def _wall(text: str) -> str:
    seconds = f"if(substring({text}, 17, 1) = ':', substring({text}, 17, 3), ':00')"
    return f"concat(substring({text}, 1, 10), ' ', substring({text}, 12, 5), {seconds})"


def _utc_wall(text: str, wall: str) -> str:
    """The wall clock in UTC, as TIMESTAMP_NTZ."""
    offset = f"upper(regexp_extract(substring_index({text}, '[', 1), r'{_OFFSET}', 1))"
    seconds = f"unix_seconds(try_cast(concat({wall}, {offset}) as timestamp))"
    return f"(timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


def _four_digit_year(instant: str) -> str:
    """Its text, NULL if a shift has taken it out of the years of four digits."""
    return rf"get(regexp_extract_all(cast({instant} as string), r'^\d{{4}}-.*$', 0), 0)"


def normalize_ts(text: str, to_utc: bool = False) -> str:
    """`yyyy-MM-dd HH:mm:ss` of a zoned ISO date-time, or NULL if the text is not one.

    Keeps the text's own wall clock and drops the offset; `to_utc` shifts to UTC instead. A region
    in brackets decides the wall clock of the instant the offset gives, as zoned parsing does.
    """
    wall = _wall(text)
    region = f"regexp_extract({text}, r'\\[(.*)\\]$', 1)"
    # The cast is NULL for a region nobody knows, where the conversion would fail.
    known = f"(not endswith({text}, ']') or try_cast(concat({wall}, ' ', {region}) as timestamp) is not null)"
    valid = f"{text} rlike r'{ISO_ZONED}' and try_cast({wall} as timestamp_ntz) is not null and {known}"
    if to_utc:
        shown = _four_digit_year(_utc_wall(text, wall))
    else:
        rebased = _four_digit_year(f"convert_timezone('UTC', {region}, {_utc_wall(text, wall)})")
        shown = f"if(endswith({text}, ']'), {rebased}, {wall})"
    # The year is printed within its era, so year 0 reads 1.
    shown = f"replace({shown}, '0000-', '0001-')"
    return f"""case when {text} is null or {text} in ('null', {quoted(NO_DATE_IN)}) then {quoted(NO_DATE_OUT)}
        when {valid} then {shown} end"""


def load_ts() -> str:
    """Processing time to the second, taken anew for each row. It is not the same when asked twice, so take it once, where
    a row is a message; Spark leaves such a value where it stands."""
    millis = "cast(java_method('java.lang.System', 'currentTimeMillis') as bigint)"
    return f"cast(date_trunc('second', timestamp_millis({millis})) as timestamp_ntz)"
