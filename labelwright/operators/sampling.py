"""Exact-count selection by hashed id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labelwright.functions.hashing import digits, row_hash
from labelwright.operators.cuts import Cut, at_or_before, rank_cuts

HASH_DIGITS = 15
HASH_BITS = 4 * HASH_DIGITS


def hash_order(id_col: Column | str, seed: int) -> list[Column]:
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return [row_hash(column, seed), column]


def hash_cuts(
    df: DataFrame,
    id_col: str,
    seed: int,
    ranks: dict[str, list[int]],
    group: Column | None = None,
    rows: int | None = None,
) -> list[Cut]:
    order = hash_order(id_col, seed)
    key = digits(order[0], 1, HASH_DIGITS)
    return rank_cuts(df, key, HASH_BITS, order, ranks, group, rows)


def within_cut(id_col: Column | str, seed: int, cut: Cut | None) -> Column:
    """True for the rows of the first ``cut.rank``; no cut selects nothing."""
    if cut is None:
        return F.lit(False)
    return at_or_before(hash_order(id_col, seed), [F.lit(v) for v in cut.values])


def sample_exact(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """Exactly ``int(n * fraction)`` rows, the same ones on every run."""
    return sample_fractions(df, id_col, (fraction,), seed).drop("fraction")


def sample_fractions(
    df: DataFrame, id_col: str, fractions: tuple[float, ...], seed: int = 42
) -> DataFrame:
    """The exact samples of several fractions, each row with the ``fraction`` it is in.

    One search finds all cuts, and one scan deals the rows out: smaller samples lie in larger.
    """
    for fraction in fractions:
        if not 0.0 <= fraction <= 1.0:
            raise ValueError(f"fraction must be between 0.0 and 1.0, got {fraction}")
    n = df.count()
    ranks = {f: int(n * f) for f in fractions}
    cuts = {c.rank: c for c in hash_cuts(df, id_col, seed, {"": list(ranks.values())}, rows=n)}
    inside = [F.when(within_cut(id_col, seed, cuts.get(r)), F.lit(float(f))) for f, r in ranks.items()]
    return df.withColumn("fraction", F.explode(F.array_compact(F.array(*inside))))
