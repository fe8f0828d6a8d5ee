"""The reference's polynomial string hash, as a JVM-side expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: multiplier 61 and a 65536-bit table (hashed distinct count)
HASH_BASE = 61
HASH_SIZE = 65536


def string_hash(s: Column, base: int = HASH_BASE, size: int = HASH_SIZE) -> Column:
    """h = h * base + code(c) over the characters, kept modulo ``size`` (a
    power of two, so masking at each step equals masking at the end)."""
    mask = size - 1
    chars = F.split(s, "")
    return F.aggregate(
        chars,
        F.lit(0).cast("bigint"),
        lambda acc, c: (acc * base + F.ascii(c)).bitwiseAND(F.lit(mask).cast("bigint")),
    )
