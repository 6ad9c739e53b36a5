"""Queries: neighbour search, suspect labels, detection quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.functions.labels import vocabulary
from labelwright.functions.local import local_table
from labelwright.operators import detect as D
from labelwright.operators.approximate import approximate_search, build_projection_index, recall
from labelwright.operators.metrics import classification_metrics
from labelwright.operators.neighbours import (
    array_vectors,
    build_index,
    feature_vectors,
    nearest_neighbours,
    search_index,
)
from labelwright.operators.noise import LabelNoise, fit_label_noise
from labelwright.operators.sampling import sample_exact
from labelwright.functions.scaling import fit_scaler
from labelwright.operators.split import train_test_split
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.sources.scratch import store


def embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = I.table(spark, sf_dir, "embeddings")
    return nearest_neighbours(array_vectors(rows, "vec_id", "embedding", "label"))


def band_suspects(bands: DataFrame, levels: tuple[float, ...]) -> tuple[DataFrame, LabelNoise]:
    """Flags at every noise level from one neighbour search over a stored table."""
    noise = fit_label_noise(bands, I.BANDS, levels)
    near = nearest_neighbours(feature_vectors(bands, I.BANDS))
    return D.neighbour_suspects(D.relabel(near, noise)), noise


def stored_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(I.part_bands(spark, sf_dir), "bands")


EMBEDDING_FLAGS = """pairs AS (SELECT n.id, n.label, b.label AS nlabel, b.id AS nid, u.d FROM
  (SELECT id, unnest(ns, recursive := true) FROM near) u JOIN near n ON n.id = u.id JOIN base b ON b.id = u.nid),
flags AS (SELECT id, label, (count(*) FILTER (WHERE nlabel <> label))::INT AS disagreements,
  count(*) FILTER (WHERE nlabel <> label) / 5::DOUBLE AS disagreement_ratio FROM pairs GROUP BY ALL)"""


TOPK_SQL = """SELECT id, row_number() OVER (PARTITION BY id ORDER BY d, nid)::INT AS rank, nid AS neighbour_id,
             round(d, 6) AS distance FROM (SELECT id, unnest(ns, recursive := true) FROM near)"""


@query(
    "knn_topk",
    I.with_sql(I.EMBEDDING_NEAR_SQL, TOPK_SQL),
)
def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = embedding_neighbours(spark, sf_dir)
    flat = near.select("id", F.posexplode("neighbours").alias("i", "n"))
    return flat.select(
        "id",
        (F.col("i") + 1).alias("rank"),
        F.col("n.nid").alias("neighbour_id"),
        F.round("n.d", 6).alias("distance"),
    )


@query("knn_topk_blocks", I.with_sql(I.EMBEDDING_NEAR_SQL, TOPK_SQL))
def knn_topk_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search of ``knn_topk`` with blocks of a few points, cut twice where they are crowded."""
    rows = store(array_vectors(I.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label"), "vectors")
    flat = nearest_neighbours(rows, per_cell=4).select("id", F.posexplode("neighbours").alias("i", "n"))
    return flat.select("id", (F.col("i") + 1).alias("rank"), F.col("n.nid").alias("neighbour_id"), F.round("n.d", 6).alias("distance"))


@query(
    "approximate_neighbours",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        """SELECT 'indexed_rows' AS measure, count(*)::DOUBLE AS value FROM base
           UNION ALL SELECT 'queries', count(*) FROM base WHERE id % 20 = 0
           UNION ALL SELECT 'expected', 5 * count(*) FROM base WHERE id % 20 = 0
           UNION ALL SELECT unnest(['recall_bound', 'closer_than_exact']), unnest([1, 0])""",
    ),
)
def approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 20th id against all rows, by random projections and exactly; recall of at least 0.9."""
    vectors = store(feature_vectors(store(I.order_bands(spark, sf_dir), "bands"), I.BANDS), "vectors")
    asked = vectors.where("id % 20 = 0")
    index = build_projection_index(vectors)
    found = store(approximate_search(index, asked, skip_same_id=True), "found")
    exact = store(search_index(build_index(vectors), asked, skip_same_id=True), "exact")
    far = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v["d"])
    ours = found.where(F.size("neighbours") == index.k).select("id", far(F.col("neighbours")).alias("a"))
    closer = ours.join(exact.select("id", far(F.col("neighbours")).alias("b")), "id").agg(F.count_if(F.col("a") < F.col("b") - 1e-6).alias("n"))
    facts = recall(found, exact)
    rows = local_table(spark, [("indexed_rows", float(index.rows))], "measure string, value double")
    each = F.array(
        *[F.struct(F.lit(m).alias("measure"), c.cast("double").alias("value")) for m, c in (("queries", F.col("queries")), ("expected", F.col("expected")), ("recall_bound", F.col("recall") >= 0.9))]
    )
    counted = closer.select(F.lit("closer_than_exact").alias("measure"), F.col("n").cast("double").alias("value"))
    return rows.unionByName(facts.select(F.explode(each).alias("e")).select("e.*")).unionByName(counted)


@query(
    "knn_suspects",
    I.with_sql(
        I.EMBEDDING_NEAR_SQL,
        EMBEDDING_FLAGS,
        "SELECT *, disagreement_ratio >= 0.5 AS suspicious FROM flags",
    ),
)
def knn_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw features, every row."""
    flags = D.neighbour_suspects(embedding_neighbours(spark, sf_dir))
    return flags.select("id", "label", "disagreements", "disagreement_ratio", "suspicious")


@query(
    "knn_suspects_scaled",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        I.SCALED_SQL,
        I.near_sql(),
        """flags AS (SELECT n.id, n.label, (count(*) FILTER (WHERE b.label <> n.label))::INT AS disagreements
             FROM (SELECT id, unnest(ns, recursive := true) FROM near) u
             JOIN near n ON n.id = u.id JOIN base b ON b.id = u.nid GROUP BY ALL)""",
        "SELECT id, label, disagreements, disagreements / 5::DOUBLE >= 0.5 AS suspicious FROM flags",
    ),
)
def knn_suspects_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised features, every row of the larger table."""
    bands = store(I.order_bands(spark, sf_dir), "bands")
    flags = D.neighbour_suspects(nearest_neighbours(feature_vectors(bands, I.BANDS)))
    return flags.select("id", "label", "disagreements", "suspicious")


PART_SQL = (I.PART_BANDS_SQL, I.noisy_sql(I.LEVELS), I.SCALED_SQL, I.near_sql(), I.LONG_SQL)
ONE_LEVEL_SQL = (I.PART_BANDS_SQL, I.noisy_sql((0.1,)), I.SCALED_SQL, I.near_sql(), I.LONG_SQL)


@query(
    "knn_detail",
    I.with_sql(
        *ONE_LEVEL_SQL,
        I.SUSPECTS_SQL,
        """SELECT s.id, s.label AS original_label, s.disagreements::INT AS disagreements, s.ratio AS disagreement_ratio,
             round(1 - s.ratio, 6) AS confidence_score, l.place::INT AS rank, l.nid AS neighbour_id,
             l.nlabel AS neighbour_label, round(l.d, 6) AS distance
           FROM suspects s JOIN long l USING (noise_level, id) WHERE s.suspicious""",
    ),
)
def knn_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags, _ = band_suspects(stored_bands(spark, sf_dir), (0.1,))
    return I.rounded(D.neighbour_detail(flags), "confidence_score", "distance")


@query(
    "suspicion_summary",
    I.with_sql(
        *PART_SQL,
        I.SUSPECTS_SQL,
        """SELECT noise_level, count(*) AS total_rows, count(*) FILTER (WHERE suspicious) AS suspicious_rows,
             round(count(*) FILTER (WHERE suspicious) / count(*)::DOUBLE, 6) AS suspicion_rate
           FROM suspects GROUP BY noise_level""",
    ),
)
def suspicion_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags, _ = band_suspects(stored_bands(spark, sf_dir), I.LEVELS)
    return I.rounded(D.suspicion_summary(flags, ("noise_level",)), "suspicion_rate")


@query(
    "suspicion_by_class",
    I.with_sql(
        *PART_SQL,
        I.SUSPECTS_SQL,
        """SELECT noise_level, label, count(*) FILTER (WHERE suspicious) AS suspicious_rows, count(*) AS class_rows,
             round(count(*) FILTER (WHERE suspicious) / count(*)::DOUBLE, 6) AS ratio
           FROM suspects GROUP BY ALL HAVING count(*) FILTER (WHERE suspicious) > 0""",
    ),
)
def suspicion_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags, _ = band_suspects(stored_bands(spark, sf_dir), I.LEVELS)
    return I.rounded(D.suspicion_by_class(flags, ("noise_level",)), "ratio").orderBy(
        "noise_level", F.col("suspicious_rows").desc()
    )


EFFECT_SQL = """SELECT noise_level, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0)::DOUBLE, 6) AS precision,
  round(tp / nullif(tp + fn, 0)::DOUBLE, 6) AS recall, round(fp / nullif(fp + tn, 0)::DOUBLE, 6) AS false_positive_rate
FROM (SELECT noise_level, count(*) FILTER (WHERE suspicious AND flipped) AS tp,
  count(*) FILTER (WHERE suspicious AND NOT flipped) AS fp, count(*) FILTER (WHERE NOT suspicious AND flipped) AS fn,
  count(*) FILTER (WHERE NOT suspicious AND NOT flipped) AS tn FROM suspects GROUP BY noise_level)"""


@query(
    "detection_effectiveness",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        I.noisy_sql(I.CURVE_LEVELS),
        I.SCALED_SQL,
        I.near_sql(),
        I.LONG_SQL,
        I.SUSPECTS_SQL,
        EFFECT_SQL,
    ),
)
def detection_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags, _ = band_suspects(store(I.order_bands(spark, sf_dir), "bands"), I.CURVE_LEVELS)
    return I.rounded(
        D.detection_effectiveness(flags, ("noise_level",)), "precision", "recall", "false_positive_rate"
    )


@query(
    "detection_roc",
    I.with_sql(
        *PART_SQL,
        I.SUSPECTS_SQL,
        """SELECT noise_level, ratio AS threshold,
             round(sum(hits) OVER down / sum(hits) OVER (PARTITION BY noise_level)::DOUBLE, 6) AS tpr,
             round(sum(misses) OVER down / sum(misses) OVER (PARTITION BY noise_level)::DOUBLE, 6) AS fpr
           FROM (SELECT noise_level, ratio, count(*) FILTER (WHERE flipped) AS hits,
                   count(*) FILTER (WHERE NOT flipped) AS misses FROM suspects GROUP BY ALL)
           WINDOW down AS (PARTITION BY noise_level ORDER BY ratio DESC)""",
    ),
)
def detection_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags, _ = band_suspects(stored_bands(spark, sf_dir), I.LEVELS)
    return I.rounded(D.detection_roc(flags, ("noise_level",)), "tpr", "fpr")


@query(
    "suspects_confirmed",
    I.with_sql(*ONE_LEVEL_SQL, I.SUSPECTS_SQL, "SELECT id FROM suspects WHERE suspicious AND flipped"),
)
def suspects_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = stored_bands(spark, sf_dir)
    flags, noise = band_suspects(bands, (0.1,))
    ledger = noise.flip(bands, 0.1)
    return D.confirmed(flags, ledger)


@query(
    "quarantine",
    I.with_sql(
        *ONE_LEVEL_SQL,
        I.SUSPECTS_SQL,
        """SELECT b.id, b.q, b.p, b.c, s.label, s.original_label FROM base b JOIN suspects s USING (id)
           WHERE NOT s.suspicious""",
    ),
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = stored_bands(spark, sf_dir)
    flags, noise = band_suspects(bands, (0.1,))
    noisy = noise.flip(bands, 0.1).drop("noise_level", "flipped")
    return D.quarantine(noisy, flags, "id")


@query(
    "knn_predict",
    I.with_sql(
        *ONE_LEVEL_SQL,
        I.SCORED_SQL,
        """SELECT id, label, prediction, round(probs[1], 6) AS p1, round(probs[2], 6) AS p2, round(probs[3], 6) AS p3
           FROM scored""",
    ),
)
def knn_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, _ = knn_votes(I.part_bands(spark, sf_dir))
    probs = F.col("probs")
    return scored.select(
        "id", "label", "prediction", *[F.round(probs[i], 6).alias(f"p{i + 1}") for i in range(3)]
    )


def knn_votes(bands: DataFrame, level: float = 0.1) -> tuple[DataFrame, list[str]]:
    """Scored table of the neighbours' votes on noisy labels."""
    bands = store(bands, "bands")
    noise = fit_label_noise(bands, I.BANDS, (level,))
    near = D.relabel(nearest_neighbours(feature_vectors(bands, I.BANDS)), noise)
    labels = list(noise.labels)
    return D.neighbour_votes(near, labels), labels


@query(
    "confident_disagreement",
    I.with_sql(
        *ONE_LEVEL_SQL,
        I.SCORED_SQL,
        """SELECT id, label AS true_label, prediction AS predicted_label, round(top, 6) AS prediction_confidence,
             round(probs[list_position(v, label)], 6) AS true_label_confidence
           FROM scored, vocab WHERE prediction <> label AND top > 0.8::DOUBLE""",
    ),
)
def confident_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored, labels = knn_votes(I.part_bands(spark, sf_dir))
    return I.rounded(
        D.confident_disagreement(scored, labels), "prediction_confidence", "true_label_confidence"
    )


@query(
    "knn_held_out",
    I.with_sql(
        I.PART_BANDS_SQL,
        I.SPLIT_SQL,
        """fit AS (SELECT avg(q) mq, stddev_pop(q) sq, avg(p) mp, stddev_pop(p) sp, avg(c) mc, stddev_pop(c) sc
             FROM split WHERE NOT is_test)""",
        """z AS MATERIALIZED (SELECT id, label, is_test, (q - mq) / sq AS z1, (p - mp) / sp AS z2, (c - mc) / sc AS z3
             FROM split, fit)""",
        """near AS (SELECT id, label, nl FROM (SELECT a.id, a.label, b.label AS nl, row_number() OVER (PARTITION BY a.id
             ORDER BY round(sqrt((a.z1-b.z1)**2 + (a.z2-b.z2)**2 + (a.z3-b.z3)**2), 9), b.id) AS place
             FROM z a JOIN z b ON a.is_test AND NOT b.is_test) WHERE place <= 5)""",
        """votes AS (SELECT id, label, nl, count(*) AS n FROM near GROUP BY ALL)""",
        """scored AS (SELECT 'knn' AS run, id, label, arg_min(nl, {'n': -n, 'nl': nl}) AS prediction
             FROM votes GROUP BY id, label)""",
        I.AVERAGES_SQL,
        "SELECT metric, round(value, 6) AS value FROM metrics",
    ),
)
def knn_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vote of the training neighbours on the held-out rows."""
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    return I.rounded(classification_metrics(held_out_votes(split)), "value")


def held_out_votes(split: DataFrame) -> DataFrame:
    train, test = split.where("not is_test"), split.where("is_test")
    scaler = fit_scaler(train, I.BANDS.feature_cols)
    near = nearest_neighbours(
        feature_vectors(train, I.BANDS, scaler=scaler),
        queries=feature_vectors(test, I.BANDS, scaler=scaler),
    )
    return D.neighbour_votes(near, vocabulary(train, "label"))


@query(
    "validate_subset",
    I.with_sql(
        I.PART_BANDS_SQL,
        I.noisy_sql((0.1,)),
        I.SCALED_SQL,
        I.near_sql(),
        I.LONG_SQL,
        I.SUSPECTS_SQL,
        """SELECT id, label, suspicious FROM suspects JOIN
             (SELECT id, place, n FROM ranked) r USING (id) WHERE r.place <= floor(n * 0.5::DOUBLE)""",
    ),
)
def validate_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact half of the rows, each checked against the full table."""
    bands = store(I.part_bands(spark, sf_dir), "bands")
    noise = fit_label_noise(bands, I.BANDS, (0.1,))
    vectors = store(feature_vectors(noise.flip(bands, 0.1), I.BANDS), "vectors")
    chosen = store(sample_exact(vectors, "id", 0.5), "chosen")
    flags = D.neighbour_suspects(search_index(build_index(vectors), chosen, skip_same_id=True))
    return flags.select("id", "label", "suspicious")
