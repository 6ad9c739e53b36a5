"""Rows carried as one column, so that no column of theirs can clash with ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def packed(docs: DataFrame) -> DataFrame:
    """One column _row with everything a row holds; ``select("_row.*")`` gives it back."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


BROADCAST_BYTES = 32 << 20


def small_side(table: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, to be broadcast if its counted rows fit the limit; else it is shuffled."""
    return F.broadcast(table) if table.count() * row_bytes <= limit else table
