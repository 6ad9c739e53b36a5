"""Label checks on streams.

Suspect scoring is stateless: every micro-batch is searched in a fixed index.
Only the class shares per time window keep state, bounded by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from labelwright.operators.detect import neighbour_suspects
from labelwright.operators.neighbours import NeighbourIndex, search_index
from labelwright.sources.scratch import store, temporary
from labelwright.spec import Params

#: Everything there is, then stop.
AT_ONCE = {"availableNow": True}


def score_suspects(
    stream: DataFrame,
    index: NeighbourIndex,
    path: str,
    checkpoint: str,
    threshold: float = Params.threshold,
    skip_same_id: bool = False,
    trigger: dict[str, object] = AT_ONCE,
) -> StreamingQuery:
    """Write flags of each micro-batch of (id, x, label) under ``path``.

    A batch writes its own folder, so a batch that is repeated after a failure
    replaces what it wrote. What a batch stores on the way is deleted when it is written.
    ``trigger`` is given to the stream writer, as ``{"processingTime": "1 minute"}``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        # The batch plan can be read once only; the search needs it twice.
        with temporary(batch.sparkSession):
            rows = store(batch, "batch")
            near = search_index(index, rows, skip_same_id)
            flags = neighbour_suspects(near, index.k, threshold).drop("neighbours")
            flags.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def class_counts_by_window(
    stream: DataFrame, time_col: str, label_col: str, window: str, delay: str
) -> DataFrame:
    """(window_start, label, n) over tumbling windows; rows later than ``delay`` are dropped."""
    return (
        stream.select(
            F.col(time_col).cast("timestamp").alias("at"),
            F.col(label_col).cast("string").alias("label"),
        )
        .where("label is not null")
        .withWatermark("at", delay)
        .groupBy(F.window("at", window).alias("w"), "label")
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "label", "n")
    )


def append_counts(
    counts: DataFrame, path: str, checkpoint: str, trigger: dict[str, object] = AT_ONCE
) -> StreamingQuery:
    return (
        counts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def class_share_drift(counts: DataFrame, baseline: dict[str, float]) -> DataFrame:
    """Share of each class per window and its difference from the baseline share.

    A baseline class that is absent from a window has a row with n = 0 there.
    """
    expected = F.create_map(*[F.lit(v) for pair in baseline.items() for v in pair])
    classes = F.explode(F.array(*[F.lit(c) for c in baseline])).alias("label")
    grid = counts.select("window_start").distinct().select("window_start", classes)
    whole = grid.join(counts, ["window_start", "label"], "full").na.fill(0, ["n"])
    total = F.sum("n").over(Window.partitionBy("window_start"))
    return whole.withColumn("share", F.col("n") / total).withColumn(
        "drift", F.col("share") - F.coalesce(F.try_element_at(expected, F.col("label")), F.lit(0.0))
    )
