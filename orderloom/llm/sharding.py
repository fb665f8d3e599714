"""Shards by a lookup table that the shards fill in turns.

Each shard has a preference order over the slots of a table of prime size: it starts at an offset and
goes on by a stride, both hashed from its name, and so meets every slot once. The shards take turns, and
at its turn a shard claims the first slot in its order that is still free. Shares of slots differ by one
at most, and when a shard is added or removed most slots keep their shard.

The table is a fixed number of entries, whatever the data, so it is built once by the driver and
broadcast. A document's slot is a hash of its id: one probe, no shuffle, and a hot source or group of
copies spreads like any other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import boxed, unboxed

SHARDS = 32
SLOTS = 4099
MOST_SLOTS = 1_000_003


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:03d}" for i in range(n)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(names: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The number of the shard that owns each slot."""
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need distinct names")
    if not _is_prime(slots) or not len(names) <= slots <= MOST_SLOTS:
        raise ValueError(f"the table's size must be a prime from the number of shards to {MOST_SLOTS}")
    at = [_number(f"{name}/offset") % slots for name in names]
    stride = [_number(f"{name}/stride") % (slots - 1) + 1 for name in names]
    owner: list[int | None] = [None] * slots
    for turn in range(slots):
        shard = turn % len(names)
        while owner[at[shard]] is not None:
            at[shard] = (at[shard] + stride[shard]) % slots
        owner[at[shard]] = shard
    return owner


def lookup_table(spark: SparkSession, names: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard."""
    owners = F.lit(",".join(map(str, fill(names, slots))))
    return spark.range(1).select(F.posexplode(F.split(owners, ",")).alias("slot", "shard")).select(
        F.col("slot").cast("bigint").alias("slot"), F.col("shard").cast("int").alias("shard")
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; a null has the slot of the empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots).cast("bigint"))


def place(
    docs: DataFrame, names: Sequence[str] | None = None, slots: int = SLOTS, id_col: str = "doc_id"
) -> DataFrame:
    """All rows and columns, with `slot` and `shard` (which replace columns of these names).

    Equal ids, repeated rows among them, have one shard; null ids share that of the empty text. An empty
    table stays empty.
    """
    owners = lookup_table(docs.sparkSession, names or shard_names(), slots)
    keyed = boxed(docs, key=id_col).select("row", slot_of(F.col("key"), slots).alias("slot"))
    return unboxed(keyed.join(F.broadcast(owners), "slot"), docs, "slot", "shard", without=("slot", "shard"))
