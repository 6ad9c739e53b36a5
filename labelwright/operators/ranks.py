"""Exact positions of all rows in an order, without a window over the whole table.

The rows are range-partitioned by the order, each range is sorted and numbered on its own and
written, and the rows of the ranges before it are added. The driver holds one count per range.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from labelwright.functions.local import local_table
from labelwright.sources.scratch import store

_LOCAL = 33  # bits that monotonically_increasing_id keeps for the row within its partition


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """Add the position from 1 on of each row; the order must be one of unique keys."""
    place = F.monotonically_increasing_id()
    numbered = store(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", place), "ranks")
    part = F.shiftright("_at", _LOCAL)
    sizes = sorted(numbered.groupBy(part.alias("p")).count().collect())
    before = accumulate((n for _, n in sizes), initial=0)
    offsets = local_table(df.sparkSession, [(p, b) for (p, _), b in zip(sizes, before)], "_part bigint, _before bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    joined = numbered.withColumn("_p", part).join(F.broadcast(offsets), F.col("_p") == F.col("_part"))
    return joined.withColumn(name, F.col("_before") + inside + 1).select(*df.columns, name)
