from pyspark.sql import functions as F

from labelwright.operators.detect import neighbour_suspects
from labelwright.operators.neighbours import build_index, feature_vectors, nearest_neighbours
from labelwright.plans import streams
from labelwright.sources import scratch
from labelwright.streaming.drift import (
    append_counts,
    class_counts_by_window,
    class_share_drift,
    score_suspects,
)
from labelwright.streaming.alerts import append_alerts, shares_by_window
from tests.conftest import CLUSTERS


def test_micro_batches_score_like_one_batch(spark, clean, flipped, tmp_path):
    vectors = feature_vectors(flipped, CLUSTERS, normalize=False)
    index = build_index(feature_vectors(clean, CLUSTERS, normalize=False))
    source = str(tmp_path / "in")
    vectors.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(vectors.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    before = sorted(scratch._written[spark.sparkContext.applicationId])
    score_suspects(stream, index, out, progress, skip_same_id=True, trigger={"availableNow": True}).awaitTermination()
    assert sorted(scratch._written[spark.sparkContext.applicationId]) == before
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 3
    want = neighbour_suspects(
        nearest_neighbours(feature_vectors(clean, CLUSTERS, normalize=False))
        .drop("label")
        .join(flipped.select("id", F.col("target").alias("label")), "id")
    )
    pick = lambda df: {(r.id, r.disagreements, r.suspicious) for r in df.collect()}
    assert pick(got) == pick(want)


def test_late_rows_are_dropped_and_only_closed_windows_are_written(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "at timestamp, label string"

    def feed(*rows):
        spark.createDataFrame(rows, "at string, label string").select(
            F.to_timestamp("at").alias("at"), "label"
        ).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        counts = class_counts_by_window(stream, "at", "label", "10 minutes", "5 minutes")
        append_counts(counts, out, str(tmp_path / "progress")).awaitTermination()

    feed(("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "b"), ("2024-01-01 00:16:00", "a"))
    feed(("2024-01-01 00:03:00", "a"), ("2024-01-01 00:30:00", "a"))
    rows = spark.read.parquet(out)
    found = {(str(r.window_start), r.label, r.n) for r in rows.collect()}
    assert found == {
        ("2024-01-01 00:00:00", "a", 1),
        ("2024-01-01 00:00:00", "b", 1),
        ("2024-01-01 00:10:00", "a", 1),
    }
    drift = {r.label: r.drift for r in class_share_drift(rows, {"a": 0.75}).where("minute(window_start) = 0").collect()}
    assert drift == {"a": -0.25, "b": 0.5}
    absent = class_share_drift(rows, {"a": 0.5, "b": 0.25, "c": 0.25}).where("minute(window_start) = 10")
    assert {(r.label, r.n, r.drift) for r in absent.collect()} == {("a", 1, 0.5), ("b", 0, -0.25), ("c", 0, -0.25)}


def test_alerts_go_on_after_a_restart(spark, tmp_path):
    """Sums are kept between runs: the alerts of two feeds are those of one walk over all windows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    baseline = {"a": 0.5, "b": 0.5}
    counts = [(6, 4), (8, 2), (9, 1), (5, 5), (10, 0), (9, 1), (9, 1), (2, 8), (0, 10), (1, 9), (0, 10), (5, 5), (5, 5)]

    def feed(windows):
        rows = [(f"2024-01-01 {10 + w // 6:02}:{w % 6}{i % 10}:00", "a" if i < counts[w][0] else "b") for w in windows for i in range(10)]
        spark.createDataFrame(rows, "at string, label string").select(F.to_timestamp("at").alias("at"), "label").write.mode("append").parquet(source)
        stream = spark.readStream.schema("at timestamp, label string").parquet(source)
        windows = shares_by_window(stream, "at", "label", ["a", "b"], "10 minutes", "0 seconds")
        append_counts(windows, str(tmp_path / "shares"), str(tmp_path / "first")).awaitTermination()
        append_alerts(spark, str(tmp_path / "shares"), baseline, out, str(tmp_path / "second"), limit=3.0).awaitTermination()

    feed(range(0, 4))
    feed(range(4, 7))
    feed(range(7, 13))
    want = set()
    for label, k in (("a", 0), ("b", 1)):
        up = down = 0.0
        for w, n in enumerate(counts[:12]):  # the last window stays open
            z = (n[k] / 10 - 0.5) / (0.25 / 10) ** 0.5
            up, down = max(0.0, up + z - 0.5), max(0.0, down - z - 0.5)
            for name, value in (("up", up), ("down", down)):
                if value > 3.0:
                    want.add((label, f"2024-01-01 {10 + w // 6:02}:{w % 6}0:00", n[k], name, round(value, 9)))
            up, down = (0.0 if up > 3 else up), (0.0 if down > 3 else down)
    got = spark.read.parquet(out).collect()
    assert {(r.label, str(r.window_start), r.n, r.direction, round(r.level, 9)) for r in got} == want
    assert len(got) == len(want) > 4


def test_streams_read_a_table_of_many_files(spark, sf_dir, tmp_path):
    for name, parts in (("embeddings", 3), ("events", 3)):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
    pick = lambda df: sorted(map(tuple, df.collect()))
    for query in (streams.stream_suspects, streams.stream_class_drift):
        assert pick(query(spark, str(tmp_path))) == pick(query(spark, sf_dir)) != []
