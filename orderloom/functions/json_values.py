"""Coercion of JSON leaf values.

A leaf arrives as VARIANT, which keeps three things apart that a plain string does not: SQL NULL
is a field that is missing, a VARIANT null is a JSON null, and every value still has its JSON type.

Taking a value out of a VARIANT makes a cast for each one, and its kind is asked for several times. Where they are
at hand, `kind` is a column with the result of `kind_of`, and `plain` one with the same leaf read as a plain string, or
NULL: texts and numbers are then taken from that string.
"""

from __future__ import annotations

from orderloom.functions import quoted

INT_MIN, INT_MAX = -2147483648, 2147483647

# Whole numbers beyond 64 bits are held as wide decimals.
_WIDE_WHOLE = r"rlike r'^DECIMAL\((19|[23]\d),0\)$'"


def _get(x: str, kind: str) -> str:
    return f"try_variant_get({x}, '$', '{kind}')"


def _low_bits(number: str) -> str:
    return f"cast(shiftright(shiftleft({number}, 32), 32) as int)"


def kind_of(x: str) -> str:
    return f"schema_of_variant({x})"


def as_text(x: str, null_text: str | None = "null", kind: str | None = None, plain: str | None = None) -> str:
    """Text of a scalar, '' for an object or array, `null_text` for JSON null, NULL if missing."""
    kind = kind or kind_of(x)
    null = "null" if null_text is None else quoted(null_text)
    # A decimal point or exponent makes a double, printed as such: 1.50 -> 1.5, 2.0 -> 2.0.
    text = f"""case
        when {kind} in ('STRING', 'BIGINT', 'BOOLEAN') or {kind} {_WIDE_WHOLE} then {_get(x, 'string')}
        when {kind} = 'VOID' then {null}
        when {kind} like 'D%' then cast({_get(x, 'double')} as string)
        when {x} is not null then '' end"""
    if not plain:
        return text
    return f"""coalesce(case when {kind} in ('STRING', 'BOOLEAN') then {plain}
        when {kind} = 'BIGINT' then cast(try_cast({plain} as bigint) as string) end, {text})"""


def as_number(x: str, kind: str | None = None, plain: str | None = None) -> str:
    """Number, numeric text or boolean as double, NULL for anything else."""
    number = _get(x, "double")
    if not plain:
        return number
    # Whole numbers and decimals have no negative zero.
    return f"""coalesce(case when {kind} = 'STRING' then try_cast({plain} as double)
        when {kind} = 'BIGINT' or {kind} like 'DECIMAL%' then try_cast({plain} as double) + 0D end, {number})"""


def finite(number: str) -> str:
    """0 for NULL and for what is not finite."""
    return f"case when abs({number}) < double('infinity') then {number} else 0D end"


def as_double(x: str) -> str:
    """Number, numeric text or boolean as double; anything else, and what is not finite, as 0."""
    return finite(as_number(x))


def as_int(x: str, kind: str | None = None, plain: str | None = None, number: str | None = None) -> str:
    """Like `as_double`, cut to an int: whole numbers keep their low 32 bits, fractions saturate. `number`: what
    `as_number` gives, if at hand."""
    kind, text, number, whole = kind or kind_of(x), _get(x, "string"), number or _get(x, "double"), _get(x, "bigint")
    if plain:
        text, whole = f"coalesce({plain}, {text})", f"coalesce(try_cast({plain} as bigint), {whole})"
    wide = f"cast(pmod({_get(x, 'decimal(38,0)')}, 4294967296) as bigint)"
    # Spark reads more words as infinity than the one spelling that counts here.
    other_infinity = f"{text} rlike r'(?i)^\\s*[+-]?inf' and not contains({text}, 'Infinity')"
    return f"""case
        when {kind} = 'BIGINT' then {_low_bits(whole)}
        when {kind} {_WIDE_WHOLE} then {_low_bits(wide)}
        when {kind} = 'STRING' and trim({text}) rlike r'^[+-]?\\d+$' then coalesce(try_cast({text} as int), 0)
        when {kind} = 'STRING' and {other_infinity} then 0
        when {number} is null or isnan({number}) then 0
        else cast(least(greatest({number}, {INT_MIN}D), {INT_MAX}D) as int) end"""
