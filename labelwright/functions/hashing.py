"""Seeded hashing of row ids: the only source of randomness.

A value depends on (seed, id) alone, so results do not change when the table
is repartitioned, re-read or recomputed after an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def row_hash(id_col: Column | str, seed: int | str) -> Column:
    """32 hexadecimal digits for the row."""
    text = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    return F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))


def digits(h: Column, start: int, length: int = 8) -> Column:
    """Hexadecimal digits of the hash as a whole number."""
    return F.conv(F.substring(h, start, length), 16, 10).cast("bigint")


def uniform(h: Column, start: int) -> Column:
    """A number strictly between 0 and 1 from eight digits."""
    return (digits(h, start) + F.lit(0.5)) / F.lit(float(2**32))


def normal(h: Column) -> Column:
    """A standard normal draw from digits 1-16 (Box and Muller)."""
    return F.sqrt(F.lit(-2.0) * F.log(uniform(h, 1))) * F.cos(
        F.lit(2.0) * F.pi() * uniform(h, 9)
    )
