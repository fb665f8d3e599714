"""Sets of hashes as bitmaps of a fixed size, which go along with a scan as a constant.

A bitmap tells for sure that a hash is not in the set. What it lets through has to be verified; a set too large
for it lets more through and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 20


def bit_of(*values: Column, bits: int = BITS) -> Column:
    return F.xxhash64(*values).bitwiseAND(F.lit(bits - 1))


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))


def _place(bit: Column) -> Column:
    return F.shiftright(bit, 6).cast("int")


def gathered(rows: DataFrame, bit: Column, bits: int = BITS) -> list[int]:
    """The bitmap of all rows, as 64-bit numbers. The driver gets at most bits / 64 rows."""
    parts = rows.select(bit.alias("bit")).groupBy(_place(F.col("bit")).alias("place"))
    out = [0] * (bits // 64)
    for row in parts.agg(F.bit_or(_mask(F.col("bit"))).alias("mask")).collect():
        out[row["place"]] = row["mask"]
    return out


def constant(bitmap: list[int]) -> Column:
    """The bitmap as an array that is folded to one literal when the plan is made."""
    return F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")


def holds(table: Column, bit: Column) -> Column:
    return table[_place(bit)].bitwiseAND(_mask(bit)) != 0
