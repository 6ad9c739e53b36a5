"""Labelled tables made from the given ones, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.spec import LabelledSpec

SEED = 42
LEVELS = (0.05, 0.1, 0.5)
CURVE_LEVELS = (0.0, 0.05, 0.1, 0.5)

ORDERS = LabelledSpec("o_orderkey", ("o_totalprice",), "o_orderstatus")
EVENTS = LabelledSpec("event_id", ("value",), "event_type")
BANDS = LabelledSpec("id", ("q", "p", "c"), "label")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "value", "event_type")


def _bands(spark: SparkSession, sf_dir: str, key: str, small: int, large: int) -> DataFrame:
    n = F.count("*")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col(key).alias("id"))
        .agg(
            F.sum("l_quantity").alias("q"),
            F.round(F.sum("l_extendedprice"), 2).alias("p"),
            n.cast("double").alias("c"),
            F.when(n < small, "small").when(n < large, "mid").otherwise("large").alias("label"),
        )
    )


def order_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by size: the label follows the features."""
    return _bands(spark, sf_dir, "l_orderkey", 3, 6)


def part_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by number of sales: the label follows the features."""
    return _bands(spark, sf_dir, "l_partkey", 28, 33)


def _bands_sql(key: str, small: int, large: int) -> str:
    return f"""base AS (
  SELECT {key} AS id, sum(l_quantity) AS q, round(sum(l_extendedprice), 2) AS p,
         CAST(count(*) AS DOUBLE) AS c,
         CASE WHEN count(*) < {small} THEN 'small' WHEN count(*) < {large} THEN 'mid' ELSE 'large' END AS label
  FROM lineitem GROUP BY {key})"""


ORDER_BANDS_SQL = _bands_sql("l_orderkey", 3, 6)
PART_BANDS_SQL = _bands_sql("l_partkey", 28, 33)
ORDERS_SQL = "base AS (SELECT o_orderkey AS id, o_totalprice AS x, o_orderstatus AS label FROM orders)"
EVENTS_SQL = "base AS (SELECT event_id AS id, value AS x, event_type AS label FROM events)"

# The vocabulary as a sorted list.
VOCAB_SQL = """vocab AS (SELECT list(label ORDER BY label) AS v, count(*) AS c
  FROM (SELECT DISTINCT label FROM base WHERE label IS NOT NULL))"""


def noisy_sql(levels: tuple[float, ...], columns: str = "") -> str:
    """CTEs ``vocab`` and ``noisy`` (noise_level, id, label, original_label, flipped)."""
    listed = ", ".join(str(level) for level in levels)
    more = f", {columns}" if columns else ""
    return f"""{VOCAB_SQL},
ranked AS (SELECT *, md5('{SEED}:' || id) AS h,
  row_number() OVER (ORDER BY md5('{SEED}:' || id), id) AS place, count(*) OVER () AS n FROM base),
noisy AS (SELECT noise_level, id{more}, place <= floor(n * noise_level) AS flipped, label AS original_label,
  CASE WHEN place <= floor(n * noise_level)
    THEN v[((list_position(v, label) - 1 + ('0x' || substr(h, 25, 8))::BIGINT % (c_all - 1) + 1) % c_all + 1)::INT]
    ELSE label END AS label
  FROM ranked, (SELECT v, c AS c_all FROM vocab), (SELECT unnest([{listed}]::DOUBLE[]) AS noise_level))"""


SCALED_SQL = """stats AS (SELECT avg(q) mq, stddev_pop(q) sq, avg(p) mp, stddev_pop(p) sp,
  avg(c) mc, stddev_pop(c) sc FROM base),
z AS MATERIALIZED (SELECT id, label, (q - mq) / sq AS z1, (p - mp) / sp AS z2, (c - mc) / sc AS z3
  FROM base, stats)"""

_DISTANCE = "round(sqrt((a.z1-b.z1)**2 + (a.z2-b.z2)**2 + (a.z3-b.z3)**2), 9)"


def near_sql(k: int = 5) -> str:
    """CTE ``near`` (id, label, ns): the k nearest other rows of ``z``."""
    return f"""near AS MATERIALIZED (SELECT id, label, arg_min({{'nid': nid, 'd': d}}, {{'d': d, 'nid': nid}}, {k}) AS ns
  FROM (SELECT a.id, a.label, b.id AS nid, {_DISTANCE} AS d FROM z a JOIN z b ON a.id <> b.id)
  GROUP BY id, label)"""


EMBEDDING_NEAR_SQL = """base AS (SELECT vec_id AS id, label::VARCHAR AS label, embedding::DOUBLE[] AS x FROM embeddings),
near AS MATERIALIZED (SELECT id, label, arg_min({'nid': nid, 'd': d}, {'d': d, 'nid': nid}, 5) AS ns
  FROM (SELECT a.id, a.label, b.id AS nid, round(list_distance(a.x, b.x), 9) AS d
        FROM base a JOIN base b ON a.id <> b.id)
  GROUP BY id, label)"""

# One row per row and neighbour, with the labels of ``lab`` (id, label, noise_level, …).
LONG_SQL = """long AS MATERIALIZED (SELECT q.noise_level, q.id, q.label, q.original_label, q.flipped, n.label AS nlabel, u.nid, u.d,
  row_number() OVER (PARTITION BY q.noise_level, q.id ORDER BY u.d, u.nid) AS place
  FROM (SELECT id, unnest(ns, recursive := true) FROM near) u
  JOIN noisy q ON q.id = u.id JOIN noisy n ON n.id = u.nid AND n.noise_level = q.noise_level)"""

SUSPECTS_SQL = """suspects AS (SELECT noise_level, id, label, original_label, flipped,
  count(*) FILTER (WHERE nlabel <> label) AS disagreements,
  count(*) FILTER (WHERE nlabel <> label) / 5::DOUBLE AS ratio,
  count(*) FILTER (WHERE nlabel <> label) / 5::DOUBLE >= 0.5 AS suspicious
  FROM long GROUP BY ALL)"""

# Votes of the neighbours: probs in vocabulary order, ties to the smallest label.
SCORED_SQL = """cells AS (SELECT noise_level, id, label, t.cl, count(*) FILTER (WHERE nlabel = t.cl) / 5::DOUBLE AS prob
  FROM long, (SELECT unnest(v) AS cl FROM vocab) t GROUP BY ALL),
scored AS MATERIALIZED (SELECT noise_level, id, label, list(prob ORDER BY cl) AS probs, max(prob) AS top,
  arg_min(cl, {'p': -prob, 'cl': cl}) AS prediction FROM cells GROUP BY noise_level, id, label)"""

SPLIT_SQL = """sizes AS (SELECT label, count(*) AS n FROM base GROUP BY label),
total AS (SELECT sum(n)::BIGINT AS n, ceil(sum(n)::BIGINT * 0.2::DOUBLE)::BIGINT AS t FROM sizes),
share AS (SELECT label, s.n * t // total.n AS q, (s.n * t) % total.n AS r, t FROM sizes s, total),
quota AS (SELECT label, q + CASE WHEN row_number() OVER (ORDER BY r DESC, label)
  <= t - sum(q) OVER () THEN 1 ELSE 0 END AS q FROM share),
split AS (SELECT b.*, row_number() OVER (PARTITION BY b.label ORDER BY md5('42:' || id), id) <= quota.q AS is_test
  FROM base b JOIN quota USING (label))"""


def centroid_sql(name: str = "scored") -> str:
    """Score ``te`` (run, id, label, q, p, c) with class means of ``tr`` of the same run."""
    z = lambda t, f: f"({t}.{f} - s.m{f}) / CASE WHEN s.s{f} = 0 THEN 1 ELSE s.s{f} END"
    gap = " + ".join(f"({z('te', f)} - {z('k', f)})**2" for f in "qpc")
    return f"""fit AS (SELECT run, avg(q) mq, stddev_pop(q) sq, avg(p) mp, stddev_pop(p) sp, avg(c) mc, stddev_pop(c) sc
  FROM tr GROUP BY run),
centres AS (SELECT run, label AS cl, avg(q) q, avg(p) p, avg(c) c FROM tr GROUP BY run, label),
{name} AS MATERIALIZED (SELECT run, id, label, arg_min(cl, {{'d': d, 'cl': cl}}) AS prediction,
  max(exp(-d)) / sum(exp(-d)) AS top
  FROM (SELECT te.run, te.id, te.label, k.cl, round(sqrt({gap}), 9) AS d
        FROM te JOIN fit s USING (run) JOIN centres k USING (run)) GROUP BY run, id, label)"""


# Averages per run from ``scored`` (run, label, prediction).
AVERAGES_SQL = """cm AS (SELECT run, label, prediction, count(*) AS n FROM scored GROUP BY ALL),
pc AS (SELECT run, cl, sum(support)::BIGINT AS support, sum(guessed)::BIGINT AS guessed, sum(hits)::BIGINT AS hits FROM (
  SELECT run, label AS cl, n AS support, 0 AS guessed, CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM cm
  UNION ALL SELECT run, prediction, 0, n, 0 FROM cm) GROUP BY run, cl),
rates AS (SELECT run, cl, support, hits,
  CASE WHEN guessed > 0 THEN hits / guessed::DOUBLE ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN hits / support::DOUBLE ELSE 0 END AS recall,
  CASE WHEN support + guessed > 0 THEN 2 * hits / (support + guessed)::DOUBLE ELSE 0 END AS f1 FROM pc),
averages AS (SELECT run, sum(support)::BIGINT AS samples, sum(hits) / sum(support)::DOUBLE AS accuracy,
  avg(precision) AS precision_macro, sum(hits) / sum(support)::DOUBLE AS precision_micro,
  sum(precision * support) / sum(support)::DOUBLE AS precision_weighted,
  avg(recall) AS recall_macro, sum(hits) / sum(support)::DOUBLE AS recall_micro,
  sum(recall * support) / sum(support)::DOUBLE AS recall_weighted,
  avg(f1) AS f1_macro, sum(hits) / sum(support)::DOUBLE AS f1_micro,
  sum(f1 * support) / sum(support)::DOUBLE AS f1_weighted FROM rates GROUP BY run),
metrics AS (UNPIVOT averages ON accuracy, precision_macro, precision_micro, precision_weighted,
  recall_macro, recall_micro, recall_weighted, f1_macro, f1_micro, f1_weighted INTO NAME metric VALUE value)"""


def with_sql(*parts: str) -> str:
    """The CTEs, then the final SELECT."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})
