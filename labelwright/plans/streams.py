"""Queries: label checks on streams, run to completion over the given files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.functions.labels import class_counts
from labelwright.operators.neighbours import array_vectors, build_index
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.plans.neighbours import EMBEDDING_FLAGS
from labelwright.sources.scratch import new_path
from labelwright.streaming.alerts import ALERTS, ALLOWANCE, LIMIT, append_alerts, shares_by_window
from labelwright.streaming.drift import (
    append_counts,
    class_counts_by_window,
    class_share_drift,
    score_suspects,
)


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of them."""
    sc, text = spark.sparkContext, f"{sf_dir}/{name}.parquet"
    path = sc._jvm.org.apache.hadoop.fs.Path(text)
    reader = spark.readStream.schema(spark.read.parquet(text).schema)
    if path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(text)
    # A stream starts from a folder.
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query(
    "stream_suspects",
    I.with_sql(
        I.EMBEDDING_NEAR_SQL,
        EMBEDDING_FLAGS,
        "SELECT *, disagreement_ratio >= 0.5 AS suspicious FROM flags",
    ),
)
def stream_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches scored against a fixed index."""
    fixed = I.table(spark, sf_dir, "embeddings")
    index = build_index(array_vectors(fixed, "vec_id", "embedding", "label"))
    stream = array_vectors(read_stream(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    out = new_path(spark, "flags")
    score_suspects(stream, index, out, new_path(spark, "progress"), skip_same_id=True).awaitTermination()
    return spark.read.parquet(out).select(
        "id", "label", "disagreements", "disagreement_ratio", "suspicious"
    )


# One class is missing from every third hour, so that absent classes are seen.
HOUR_WITHOUT = "event_type = 'click' AND hour(ts) % 3 = 0"


@query(
    "stream_class_drift",
    f"""WITH seen AS (SELECT * FROM events WHERE NOT ({HOUR_WITHOUT})),
       counted AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type AS label, count(*) AS n FROM seen GROUP BY ALL),
       closed AS (SELECT * FROM counted WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM seen) - INTERVAL 10 MINUTE),
       shares AS (SELECT event_type AS label, count(*) / sum(count(*)) OVER ()::DOUBLE AS s FROM events GROUP BY event_type),
       whole AS (SELECT w, label, s, coalesce(n, 0) AS n FROM (SELECT DISTINCT w FROM closed) CROSS JOIN shares LEFT JOIN closed USING (w, label))
       SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, label, n,
         round(n / sum(n) OVER (PARTITION BY w)::DOUBLE, 6) AS share,
         round(n / sum(n) OVER (PARTITION BY w)::DOUBLE - s, 6) AS drift FROM whole""",
)
def stream_class_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class shares per hour against the shares of the whole table; closed windows only."""
    events = I.table(spark, sf_dir, "events")
    counts = class_counts(events, "event_type")
    shares = {label: n / sum(counts.values()) for label, n in counts.items()}
    arriving = read_stream(spark, sf_dir, "events").where(f"not ({HOUR_WITHOUT})")
    stream = class_counts_by_window(
        arriving, "ts", "event_type", "1 hour", "10 minutes"
    )
    out = new_path(spark, "windows")
    append_counts(stream, out, new_path(spark, "progress")).awaitTermination()
    drift = class_share_drift(spark.read.schema(stream.schema).parquet(out), shares)
    return I.rounded(
        drift.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")),
        "share",
        "drift",
    )


@query(
    "stream_drift_alerts",
    f"""WITH RECURSIVE seen AS (SELECT * FROM events WHERE NOT ({HOUR_WITHOUT})),
       counted AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, event_type AS label, count(*) AS n FROM seen GROUP BY ALL),
       closed AS (SELECT * FROM counted WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM seen) - INTERVAL 10 MINUTE),
       shares AS (SELECT event_type AS label, count(*) / sum(count(*)) OVER ()::DOUBLE AS s FROM events GROUP BY event_type),
       totals AS (SELECT w, sum(n)::BIGINT AS total FROM closed GROUP BY w),
       whole AS (SELECT w, label, coalesce(n, 0) AS n, total, (coalesce(n, 0) / total::DOUBLE - s) / sqrt(s * (1 - s) / total) AS z,
           row_number() OVER (PARTITION BY label ORDER BY w) AS i FROM totals CROSS JOIN shares LEFT JOIN closed USING (w, label)),
       steps AS (SELECT label, 0::BIGINT AS i, NULL::TIMESTAMP AS w, 0::BIGINT AS n, 0::BIGINT AS total, 0::DOUBLE AS u, 0::DOUBLE AS d,
           0::DOUBLE AS up, 0::DOUBLE AS down FROM shares
         UNION ALL SELECT label, i, w, n, total, u, d, CASE WHEN u > {LIMIT} THEN 0 ELSE u END, CASE WHEN d > {LIMIT} THEN 0 ELSE d END
         FROM (SELECT x.label, x.i, x.w, x.n, x.total, greatest(0, p.up + x.z - {ALLOWANCE}::DOUBLE) AS u, greatest(0, p.down - x.z - {ALLOWANCE}::DOUBLE) AS d
               FROM steps p JOIN whole x ON x.label = p.label AND x.i = p.i + 1))
       SELECT label, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, total, 'up' AS direction, round(u, 6) AS level FROM steps WHERE u > {LIMIT}
       UNION ALL SELECT label, strftime(w, '%Y-%m-%d %H:%M:%S'), n, total, 'down', round(d, 6) FROM steps WHERE d > {LIMIT}""",
)
def stream_drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative-sum alerts per class over the hours of the stream; sums are keyed state."""
    counts = class_counts(I.table(spark, sf_dir, "events"), "event_type")
    baseline = {label: n / sum(counts.values()) for label, n in counts.items()}
    arriving = read_stream(spark, sf_dir, "events").where(f"not ({HOUR_WITHOUT})")
    shares, out = new_path(spark, "shares"), new_path(spark, "alerts")
    windows = shares_by_window(arriving, "ts", "event_type", list(baseline), "1 hour", "10 minutes")
    append_counts(windows, shares, new_path(spark, "progress")).awaitTermination()
    append_alerts(spark, shares, baseline, out, new_path(spark, "progress")).awaitTermination()
    found = spark.read.schema(ALERTS).parquet(out)
    return I.rounded(found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")), "level")
