"""Queries: data-quality checks and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.operators import checks as K
from labelwright.operators.noise import fit_label_noise, noise_metadata, transitions
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.plans.noise import LEDGER_SQL, METADATA_SQL
from labelwright.plans.reports import CURVE_SQL, level_metrics
from labelwright.sources.scratch import store
from labelwright.spec import LabelledSpec

LINES = LabelledSpec(
    "l_orderkey", ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "l_returnflag"
)


def _nulls(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'no_nulls' AS "check", '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed,
            (count(*) FILTER (WHERE {c} IS NULL))::DOUBLE AS observed, 0::DOUBLE AS "limit" FROM events"""
        for c in columns
    )


EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("check_nulls", _nulls(EVENT_COLUMNS))
def check_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_nulls(I.table(spark, sf_dir, "events"), EVENT_COLUMNS)


@query(
    "check_cardinality",
    """SELECT 'class_cardinality' AS "check", 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) = 3 AS passed,
         count(DISTINCT o_orderstatus)::DOUBLE AS observed, 3::DOUBLE AS "limit" FROM orders""",
)
def check_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_cardinality(I.orders(spark, sf_dir), I.ORDERS, 3)


@query(
    "check_ranges",
    " UNION ALL ".join(
        f"""SELECT 'range_min' AS "check", '{c}' AS "column", min({c}) >= 0 AS passed, min({c}) + 0::DOUBLE AS observed, 0::DOUBLE AS "limit" FROM lineitem
            UNION ALL SELECT 'range_max', '{c}', max({c}) <= 20, max({c}) + 0::DOUBLE, 20::DOUBLE FROM lineitem"""
        for c in LINES.feature_cols
    ),
)
def check_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_ranges(I.table(spark, sf_dir, "lineitem"), LINES)


@query(
    "check_balance",
    """SELECT 'class_balance' AS "check", event_type AS "column", count(*) / sum(count(*)) OVER ()::DOUBLE >= 0.1 AS passed,
         round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS observed, 0.1::DOUBLE AS "limit" FROM events GROUP BY event_type""",
)
def check_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(K.check_balance(I.events(spark, sf_dir), I.EVENTS), "observed")


@query(
    "check_class_variance",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        " UNION ALL ".join(
            f"""SELECT 'class_variance' AS "check", '{c}/' || label AS "column", coalesce(var_samp({c}) <= o, false) AS passed,
                round(var_samp({c}), 3) AS observed, round(o, 3) AS "limit"
                FROM base, (SELECT var_samp({c}) AS o FROM base) GROUP BY label, o"""
            for c in I.BANDS.feature_cols
        ),
    ),
)
def check_class_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(
        K.check_class_variance(I.order_bands(spark, sf_dir), I.BANDS), "observed", "limit", places=3
    )


@query(
    "check_noise_metadata",
    I.with_sql(
        I.ORDERS_SQL,
        I.noisy_sql(I.LEVELS),
        LEDGER_SQL,
        METADATA_SQL,
        """seen AS (SELECT noise_level, count(original_label) AS seen_rows, count(*) FILTER (WHERE label <> original_label) AS changed
             FROM noisy GROUP BY noise_level)""",
        """SELECT 'metadata_level' AS "check", noise_level::VARCHAR AS "column", noise_level BETWEEN 0 AND 1 AS passed,
             noise_level AS observed, 1::DOUBLE AS "limit" FROM metadata
           UNION ALL SELECT 'metadata_total', noise_level::VARCHAR, seen_rows = total_rows, seen_rows::DOUBLE, total_rows::DOUBLE
             FROM metadata JOIN seen USING (noise_level)
           UNION ALL SELECT 'metadata_noisy', noise_level::VARCHAR, changed = noisy_rows, changed::DOUBLE, noisy_rows::DOUBLE
             FROM metadata JOIN seen USING (noise_level)""",
    ),
)
def check_noise_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    noise = fit_label_noise(df, I.ORDERS, I.LEVELS)
    sweep = store(noise.sweep(df), "sweep")
    metadata = noise_metadata(transitions(sweep, I.ORDERS, noise), noise, "orders")
    return K.check_noise_metadata(metadata, sweep, I.ORDERS)


@query(
    "check_metric_bounds",
    I.with_sql(
        *CURVE_SQL,
        "clean AS (SELECT accuracy AS clean FROM averages WHERE run = 0)",
        """SELECT 'accuracy_bounds' AS "check", run::DOUBLE::VARCHAR AS "column", accuracy BETWEEN 0 AND 1 AS passed,
             round(accuracy, 6) AS observed, 1::DOUBLE AS "limit" FROM averages
           UNION ALL SELECT 'better_than_chance', run::DOUBLE::VARCHAR, accuracy > 1 / 3::DOUBLE, round(accuracy, 6), round(1 / 3::DOUBLE, 6) FROM averages
           UNION ALL SELECT 'drop_bound', run::DOUBLE::VARCHAR, clean - accuracy < 0.4, round(clean - accuracy, 6), 0.4::DOUBLE FROM averages, clean""",
    ),
)
def check_metric_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(K.check_metric_bounds(level_metrics(spark, sf_dir), 3), "observed", "limit")


@query(
    "class_histogram",
    """SELECT label, CASE WHEN high > low THEN least(floor((x - low) / (high - low) * 20), 19) ELSE 10 END::INT AS bin,
         count(*) AS n, low, high
       FROM (SELECT lang AS label, n_chars::DOUBLE AS x, min(n_chars) OVER (PARTITION BY lang)::DOUBLE AS low,
               max(n_chars) OVER (PARTITION BY lang)::DOUBLE AS high FROM documents) GROUP BY ALL""",
)
def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.class_histogram(I.table(spark, sf_dir, "documents"), "n_chars", "lang")


HOLES = "CASE WHEN event_id % 7 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 11 = 0 THEN NULL ELSE value END"


def _with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with some values made missing, half of them as not-a-number."""
    id_ = F.col("event_id")
    value = F.when(id_ % 7 == 0, F.lit(float("nan"))).when(id_ % 11 == 0, F.lit(None)).otherwise(F.col("value"))
    return I.events(spark, sf_dir).withColumn("value", value.cast("double"))


@query(
    "check_nulls_nan",
    f"""SELECT 'no_nulls' AS "check", 'value' AS "column", count(*) = 0 AS passed, count(*)::DOUBLE AS observed, 0::DOUBLE AS "limit"
        FROM (SELECT {HOLES} AS x FROM events) WHERE x IS NULL OR isnan(x)
        UNION ALL SELECT 'no_nulls', 'event_type', count(*) = 0, count(*)::DOUBLE, 0::DOUBLE FROM events WHERE event_type IS NULL""",
)
def check_nulls_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.check_nulls(_with_holes(spark, sf_dir), ["value", "event_type"])


@query(
    "class_histogram_missing",
    f"""WITH rows AS (SELECT event_type AS label, CASE WHEN NOT isnan({HOLES}) THEN {HOLES} END AS x FROM events),
          ends AS (SELECT label, min(x) AS low, max(x) AS high FROM rows GROUP BY label)
        SELECT label, CASE WHEN x IS NULL THEN -1 ELSE least(floor((x - low) / (high - low) * 20), 19) END::INT AS bin,
          count(*) AS n, low, high FROM rows JOIN ends USING (label) GROUP BY ALL""",
)
def class_histogram_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = K.class_histogram(_with_holes(spark, sf_dir), "value", "event_type")
    return bins.withColumn("bin", F.coalesce("bin", F.lit(-1)))


# A constant column, and one with both kinds of missing values, beside the others.
ODD = (*LINES.feature_cols, "flat", "holes")
ODD_SQL = """odd AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, 3::DOUBLE AS flat,
  CASE WHEN l_partkey % 5 = 0 OR l_partkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS holes FROM lineitem)"""


@query(
    "correlation_matrix",
    I.with_sql(
        ODD_SQL,
        " UNION ALL ".join(
            f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b, """
            + ("NULL::DOUBLE AS corr, false AS well_formed" if "flat" in (a, b) else f"round(corr({a}, {b}), 6) AS corr, true AS well_formed FROM odd")
            for a in ODD
            for b in ODD
        ),
    ),
)
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey")
    holes = F.when(part % 5 == 0, F.lit(float("nan"))).when(part % 7 == 0, F.lit(None)).otherwise(F.col("l_extendedprice"))
    return I.rounded(K.correlation_matrix(df.withColumns({"flat": F.lit(3.0), "holes": holes.cast("double")}), ODD), "corr")
