"""Exact order statistics without a global sort.

Selecting exactly k rows, exact quotas per class and equal-sized folds all ask
for the row at a given rank. Its place is found by counting: rows are counted
per bucket of a whole-number key, the bucket that holds the rank is counted
again in finer buckets, and only a bucket that is small enough is sorted. The
answer is a *cut*; belonging to the first k rows is then a comparison per row,
with no shuffle of the table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from labelwright.functions.local import local_table

COUNTED_BUCKETS = 1 << 15
SORTABLE_ROWS = 20_000


@dataclass(frozen=True)
class Cut:
    """Order values of the row at ``rank`` within ``group``."""

    group: str
    rank: int
    values: tuple[Any, ...]


def rank_cuts(
    df: DataFrame,
    key: Column,
    bits: int,
    order: list[Column],
    ranks: dict[str, list[int]],
    group: Column | None = None,
    largest: int | None = None,
) -> list[Cut]:
    """Order values of the rows at the wanted ranks (1 is the smallest).

    ``key`` is a whole number in [0, 2**bits) that never decreases along
    ``order``; the order must be total. Equal order values are an error where they stand
    at a cut, as they would make the count wrong there; elsewhere they change nothing and
    are not looked for. ``ranks`` has one entry per group ("" when there is no grouping). The driver holds about ``COUNTED_BUCKETS`` counts per round,
    shared by the groups, whatever the number of rows. ``largest`` is the size of the
    largest group where it is known; counting is skipped if that can be sorted.
    """
    spark = df.sparkSession
    wanted = [(g, r) for g, rs in ranks.items() for r in sorted(set(rs)) if r > 0]
    if not wanted:
        return []
    names = [f"_o{i}" for i in range(len(order))]
    base = df.select(
        (group if group is not None else F.lit("")).alias("_g"),
        key.cast("bigint").alias("_key"),
        *[o.alias(n) for o, n in zip(order, names)],
    )
    schema = "_g string, _bucket bigint, _need bigint, _rank bigint"
    targets = [(g, 0, r, r) for g, r in wanted]
    shift = bits
    while largest is None or largest > SORTABLE_ROWS:
        shares = max(1, len({(g, b) for g, b, _, _ in targets}), len(ranks))
        finer = max(0, shift - max(2, int(math.log2(COUNTED_BUCKETS / shares))))
        rows = base if shift == bits else _inside(base, shift, targets, schema)
        counts = (
            rows.groupBy("_g", F.shiftright("_key", finer).alias("_fine"))
            .agg(F.count("*").alias("_n"))
            .toPandas()
            .sort_values(["_g", "_fine"])
        )
        counts["_bucket"] = counts["_fine"].to_numpy() >> (shift - finer)
        counts["_upto"] = counts.groupby(["_g", "_bucket"])["_n"].cumsum()
        groups = dict(list(counts.groupby(["_g", "_bucket"])))
        found, largest = [], 0
        for g, bucket, need, rank in targets:
            part = groups.get((g, bucket))
            if part is None or int(part["_upto"].iloc[-1]) < need:
                raise ValueError("a wanted rank exceeds the number of rows of its group")
            hit = part.iloc[int(part["_upto"].searchsorted(need))]
            found.append((g, int(hit["_fine"]), int(need - hit["_upto"] + hit["_n"]), rank))
            largest = max(largest, int(hit["_n"]))
        targets, shift = found, finer
        if shift == 0 and largest > SORTABLE_ROWS:
            raise ValueError("too many rows share one order key; the row id must be unique")
    within = Window.partitionBy("_g", "_bucket").orderBy(*names)
    picked = (
        _inside(base, shift, targets, schema)
        .withColumn("_need", F.row_number().over(within).cast("bigint"))
        .withColumn("_same", F.count("*").over(Window.partitionBy("_g", "_bucket", *names)))
        .join(F.broadcast(local_table(spark, targets, schema)), ["_g", "_bucket", "_need"])
        .collect()
    )
    if len(picked) != len(wanted):
        raise ValueError("a wanted rank exceeds the number of rows of its group")
    if any(r["_same"] > 1 for r in picked):
        raise ValueError("rows at a cut share one order key; the row id must be unique")
    return [Cut(r["_g"], r["_rank"], tuple(r[n] for n in names)) for r in picked]


def _inside(base: DataFrame, shift: int, targets: list[tuple], schema: str) -> DataFrame:
    """Rows of the buckets that hold a wanted rank."""
    held = local_table(base.sparkSession, targets, schema).select("_g", "_bucket").distinct()
    coarse = F.shiftright("_key", shift) if shift < 63 else F.lit(0).cast("bigint")
    return base.withColumn("_bucket", coarse).join(
        F.broadcast(held), ["_g", "_bucket"], "left_semi"
    )


def at_or_before(order: list[Column], values: list[Column]) -> Column:
    """True where the row's order values are not after the given ones."""
    test = order[-1] <= values[-1]
    for o, v in zip(reversed(order[:-1]), reversed(values[:-1])):
        test = (o < v) | ((o == v) & test)
    return test
