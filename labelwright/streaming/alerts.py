"""Alerts when the share of a class drifts: a cumulative-sum test per class across windows.

Every closed window gives each baseline class one standardised deviation of its share. Two sums
per class, one for growth and one for decline, add up what exceeds an allowance and start again
at zero; a sum beyond the limit is an alert, after which it starts anew. The sums are keyed
streaming state of two numbers per class, so a small lasting shift is found however long it
takes, and a restarted query goes on where it stopped.

Two queries work one behind the other, as keyed state of one's own cannot follow a windowed
aggregation in one query: the first appends the shares of closed windows to a folder, the
second streams that folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from labelwright.streaming.drift import AT_ONCE, append_counts

ALLOWANCE = 0.5
LIMIT = 4.0
SHARES = "window_start timestamp, label string, n long, total long"
STATE = "up double, down double"
ALERTS = "label string, window_start timestamp, n long, total long, direction string, level double"


def shares_by_window(stream: DataFrame, time_col: str, label_col: str, labels: list[str], window: str, delay: str) -> DataFrame:
    """(window_start, label, n, total) of every baseline class in every closed window that has rows.

    A class without rows in a window has n = 0 there; other labels count in the total only.
    """
    label = F.col(label_col).cast("string")
    counts = [F.count_if(F.col("label") == F.lit(c)).alias(f"n{i}") for i, c in enumerate(labels)]
    closed = (
        stream.select(F.col(time_col).cast("timestamp").alias("at"), label.alias("label"))
        .where("label is not null")
        .withWatermark("at", delay)
        .groupBy(F.window("at", window).alias("w"))
        .agg(F.count("*").alias("total"), *counts)
    )
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.col(f"n{i}").alias("n")) for i, c in enumerate(labels)]))
    return closed.select(F.col("w.start").alias("window_start"), "total", each.alias("e")).select("window_start", "e.label", "e.n", "total")


def drift_alerts(shares: DataFrame, baseline: dict[str, float], allowance: float = ALLOWANCE, limit: float = LIMIT) -> DataFrame:
    """Alert rows (label, window_start, n, total, direction, level) of a stream of shares per window.

    Windows of one class have to arrive in their order, as closed windows do; those of one batch
    are sorted. A class whose baseline share is 0 or 1 cannot deviate in a standardised way and
    has no alerts.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        share = baseline[key[0]]
        up, down = state.get if state.exists else (0.0, 0.0)
        rows = pd.concat(list(batches)).sort_values("window_start")
        found = []
        for row in rows.itertuples(index=False):
            if not 0.0 < share < 1.0:
                continue
            z = (row.n / row.total - share) / (share * (1.0 - share) / row.total) ** 0.5
            up, down = max(0.0, up + z - allowance), max(0.0, down - z - allowance)
            if up > limit:
                found.append((key[0], row.window_start, row.n, row.total, "up", up))
                up = 0.0
            if down > limit:
                found.append((key[0], row.window_start, row.n, row.total, "down", down))
                down = 0.0
        state.update((up, down))
        yield pd.DataFrame(found, columns=["label", "window_start", "n", "total", "direction", "level"])

    known = shares.where(F.col("label").isin(list(baseline)))
    return known.groupBy("label").applyInPandasWithState(step, ALERTS, STATE, "append", GroupStateTimeout.NoTimeout)


def append_alerts(
    spark: SparkSession,
    shares: str,
    baseline: dict[str, float],
    path: str,
    checkpoint: str,
    allowance: float = ALLOWANCE,
    limit: float = LIMIT,
    trigger: dict[str, object] = AT_ONCE,
) -> StreamingQuery:
    """Append the alerts of the shares that another query appends to a folder."""
    stream = spark.readStream.schema(SHARES).parquet(shares)
    return append_counts(drift_alerts(stream, baseline, allowance, limit), path, checkpoint, trigger)
