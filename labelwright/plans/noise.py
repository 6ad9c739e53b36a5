"""Queries: scans, noise, sampling, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelwright.functions.labels import vocabulary, vocabulary_union
from labelwright.operators.dictionary import decode_labels, encode_labels as encode_labels_by, label_dictionary
from labelwright.functions.local import local_table
from labelwright.functions.scaling import fit_scaler, raw_vector
from labelwright.operators import noise as N
from labelwright.operators.checks import class_distribution, label_shift
from labelwright.operators.feature_noise import add_feature_noise, inject_outliers
from labelwright.operators.metrics import dataset_info
from labelwright.operators.sampling import sample_fractions
from labelwright.operators.split import stratified_folds, train_test_split
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.sources.scratch import store
from labelwright.sources.tables import scan_labelled
from labelwright.spec import LabelledSpec


@query(
    "scan_labelled",
    "SELECT event_id AS id, value AS value, event_type AS label FROM events",
)
def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = scan_labelled(spark, f"{sf_dir}/events.parquet", "event_id", "event_type")
    return df.select(F.col("event_id").alias("id"), "value", F.col("event_type").alias("label"))


@query(
    "feature_label_split",
    "SELECT o_orderkey AS id, o_totalprice AS feature_1, o_orderstatus AS label FROM orders",
)
def feature_label_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    return df.select(
        F.col("o_orderkey").alias("id"),
        raw_vector(I.ORDERS.feature_cols)[0].alias("feature_1"),
        F.col("o_orderstatus").alias("label"),
    )


@query(
    "label_vocabulary",
    """SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS label_idx
       FROM (SELECT DISTINCT event_type AS label FROM events WHERE event_type IS NOT NULL)""",
)
def label_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = label_dictionary(I.events(spark, sf_dir), label_col="event_type")
    return dictionary.select("label", F.col("label_idx").cast("int").alias("label_idx"))


@query(
    "encode_labels",
    I.with_sql(
        I.EVENTS_SQL,
        I.VOCAB_SQL,
        "SELECT id, label, (list_position(v, label) - 1)::INT AS label_idx FROM base, vocab",
    ),
)
def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.events(spark, sf_dir)
    encoded = encode_labels_by(df, "event_type", label_dictionary(df, label_col="event_type"))
    return encoded.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("label"),
        F.col("label_idx").cast("int").alias("label_idx"),
    )


@query(
    "encode_wide_vocabulary",
    """WITH l AS (SELECT l_orderkey, l_orderkey || '-' || l_partkey AS label FROM lineitem)
       SELECT l_orderkey AS id, label, dense_rank() OVER (ORDER BY label) - 1 AS label_idx, label AS decoded FROM l""",
)
def encode_wide_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly as many classes as rows, encoded and decoded through a dictionary table."""
    label = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"))
    df = I.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), label.alias("label"))
    dictionary = label_dictionary(df, label_col="label")
    return decode_labels(encode_labels_by(df, "label", dictionary), "label_idx", dictionary, "decoded")


@query(
    "noise_select",
    """SELECT id FROM (SELECT o_orderkey AS id,
         row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS place,
         count(*) OVER () AS n FROM orders) WHERE place <= floor(n * 0.1::DOUBLE)""",
)
def noise_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    noise = N.fit_label_noise(df, I.ORDERS, (0.1,))
    return df.where(noise.selected(0.1)).select(F.col("o_orderkey").alias("id"))


@query(
    "noise_flip",
    I.with_sql(I.ORDERS_SQL, I.noisy_sql((0.1,)), "SELECT id, label, original_label, flipped FROM noisy"),
)
def noise_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    flipped = N.fit_label_noise(df, I.ORDERS, (0.1,)).flip(df, 0.1)
    return flipped.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("label"),
        "original_label",
        "flipped",
    )


@query(
    "noise_sweep",
    I.with_sql(
        I.EVENTS_SQL, I.noisy_sql(I.LEVELS, "x"), "SELECT noise_level, id, x AS value, label FROM noisy"
    ),
)
def noise_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.events(spark, sf_dir)
    return (
        N.fit_label_noise(df, I.EVENTS, I.LEVELS)
        .sweep(df)
        .select("noise_level", F.col("event_id").alias("id"), "value", F.col("event_type").alias("label"))
    )


LEDGER_SQL = """counted AS (SELECT noise_level, original_label, label AS new_label, count(*) AS n
  FROM noisy WHERE flipped GROUP BY ALL),
levels AS (SELECT DISTINCT noise_level FROM noisy),
ledger AS (SELECT l.noise_level, o.label AS original_label, m.label AS new_label, coalesce(k.n, 0)::BIGINT AS n
  FROM levels l, (SELECT DISTINCT label FROM base) o JOIN (SELECT DISTINCT label FROM base) m ON o.label <> m.label
  LEFT JOIN counted k ON k.noise_level = l.noise_level AND k.original_label = o.label AND k.new_label = m.label)"""


@query(
    "noise_transitions",
    I.with_sql(I.EVENTS_SQL, I.noisy_sql(I.LEVELS), LEDGER_SQL, "SELECT * FROM ledger"),
)
def noise_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.events(spark, sf_dir)
    noise = N.fit_label_noise(df, I.EVENTS, I.LEVELS)
    return N.transitions(noise.sweep(df), I.EVENTS, noise)


METADATA_SQL = """metadata AS (SELECT 'orders' AS source, noise_level, (SELECT count(label) FROM base) AS total_rows,
  sum(changed)::BIGINT AS noisy_rows, 42 AS random_seed,
  '{' || string_agg('"' || original_label || '":{' || pairs || '}', ',' ORDER BY original_label) || '}' AS label_changes
  FROM (SELECT noise_level, original_label, sum(n) AS changed,
          string_agg('"' || new_label || '":' || n, ',' ORDER BY new_label) AS pairs
        FROM ledger GROUP BY noise_level, original_label) GROUP BY noise_level)"""


@query(
    "noise_metadata",
    I.with_sql(I.ORDERS_SQL, I.noisy_sql(I.LEVELS), LEDGER_SQL, METADATA_SQL, "SELECT * FROM metadata"),
)
def noise_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    noise = N.fit_label_noise(df, I.ORDERS, I.LEVELS)
    return N.noise_metadata(N.transitions(noise.sweep(df), I.ORDERS, noise), noise, "orders")


@query(
    "noise_nested_check",
    I.with_sql(
        I.EVENTS_SQL,
        I.noisy_sql(I.LEVELS),
        """SELECT a.noise_level AS lower, b.noise_level AS higher, count(*) FILTER (WHERE a.flipped) AS lower_rows,
             count(*) FILTER (WHERE a.flipped AND (NOT b.flipped OR a.label <> b.label)) AS violations
           FROM noisy a JOIN noisy b ON a.id = b.id
           WHERE (a.noise_level = 0.05::DOUBLE AND b.noise_level = 0.1::DOUBLE)
              OR (a.noise_level = 0.1::DOUBLE AND b.noise_level = 0.5::DOUBLE)
           GROUP BY ALL""",
    ),
)
def noise_nested_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.events(spark, sf_dir)
    noise = N.fit_label_noise(df, I.EVENTS, I.LEVELS)
    return N.nesting_violations(noise.sweep(df), I.EVENTS, I.LEVELS)


@query(
    "label_diff",
    I.with_sql(
        I.ORDERS_SQL,
        I.noisy_sql((0.1,)),
        "SELECT id, original_label AS label_before, label AS label_after FROM noisy WHERE label <> original_label",
    ),
)
def label_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.orders(spark, sf_dir)
    noisy = N.fit_label_noise(df, I.ORDERS, (0.1,)).flip(df, 0.1)
    return N.label_diff(df, noisy, "o_orderkey", "o_orderstatus").withColumnRenamed("o_orderkey", "id")


def _gauss(column: str) -> str:
    h = f"md5('42:{column}:' || event_id)"
    u = lambda start: f"((('0x' || substr({h}, {start}, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)"
    return f"sqrt(-2::DOUBLE * ln({u(1)})) * cos(2::DOUBLE * pi() * {u(9)})"


@query(
    "feature_noise",
    f"""SELECT event_id AS id, round(value + 0.1::DOUBLE * s * {_gauss('value')}, 6) AS value, event_type AS label
        FROM events, (SELECT stddev_samp(value) AS s FROM events)""",
)
def feature_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = add_feature_noise(I.events(spark, sf_dir), I.EVENTS)
    return I.rounded(
        noisy.select(F.col("event_id").alias("id"), "value", F.col("event_type").alias("label")), "value"
    )


@query(
    "outlier_inject",
    """SELECT event_id AS id, place <= 5 AS outlier,
         round(CASE WHEN place <= 5 THEN m + 5 * s ELSE value END, 6) AS value, event_type AS label
       FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || event_id), event_id) AS place FROM events),
            (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)""",
)
def outlier_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inject_outliers(I.events(spark, sf_dir), I.EVENTS)
    return I.rounded(
        out.select(
            F.col("event_id").alias("id"), "outlier", "value", F.col("event_type").alias("label")
        ),
        "value",
    )


@query(
    "sample_exact",
    """SELECT f AS fraction, o_orderkey AS id, o_orderstatus AS label
       FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || o_orderkey), o_orderkey) AS place,
               count(*) OVER () AS n FROM orders), (SELECT unnest([0.5, 0.7, 0.9]::DOUBLE[]) AS f)
       WHERE place <= floor(n * f)""",
)
def exact_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = sample_fractions(I.orders(spark, sf_dir), "o_orderkey", (0.5, 0.7, 0.9))
    return samples.select("fraction", F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"))


@query(
    "stratified_split",
    I.with_sql(I.ORDERS_SQL, I.SPLIT_SQL, "SELECT id, label, is_test FROM split"),
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(I.orders(spark, sf_dir), I.ORDERS).select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("label"), "is_test"
    )


@query(
    "plain_split",
    """SELECT event_id AS id, place <= ceil(n * 0.2::DOUBLE) AS is_test
       FROM (SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id), event_id) AS place,
               count(*) OVER () AS n FROM events)""",
)
def plain_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = train_test_split(I.events(spark, sf_dir), I.EVENTS, stratify=False)
    return split.select(F.col("event_id").alias("id"), "is_test")


@query(
    "stratified_folds",
    """SELECT event_id AS id, event_type AS label,
         ntile(5) OVER (PARTITION BY event_type ORDER BY event_id)::INT AS fold FROM events""",
)
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_folds(I.events(spark, sf_dir), I.EVENTS).select(
        F.col("event_id").alias("id"), F.col("event_type").alias("label"), "fold"
    )


@query(
    "label_vocabulary_union",
    """SELECT label, (row_number() OVER (ORDER BY label) - 1)::INT AS label_idx FROM (
         SELECT DISTINCT event_type AS label FROM events WHERE event_type <> 'view'
         UNION SELECT DISTINCT event_type FROM events WHERE event_type <> 'click')""",
)
def label_vocabulary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One index for two versions of a table that lack different classes."""
    df = I.events(spark, sf_dir)
    labels = vocabulary_union([df.where("event_type <> 'view'"), df.where("event_type <> 'click'")], "event_type")
    return local_table(spark, [(label, i) for i, label in enumerate(labels)], "label string, label_idx int")


# More rows than are sorted at once, in few classes, so that cuts are counted in rounds.
PAIRS = LabelledSpec("id", ("q",), "label")
PAIRS_SQL = """base AS (SELECT l_orderkey * 1000000 + l_partkey AS id, min(l_linestatus) AS label
  FROM lineitem GROUP BY l_orderkey, l_partkey)"""


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and part pairs."""
    pairs = I.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey")
    made = pairs.agg(F.sum("l_quantity").alias("q"), F.min("l_linestatus").alias("label"))
    return store(made.select((F.col("l_orderkey") * 1_000_000 + F.col("l_partkey")).alias("id"), "q", "label"), "pairs")


@query("noise_select_counted", I.with_sql(PAIRS_SQL, I.noisy_sql((0.1,)), "SELECT id, label, original_label, flipped FROM noisy"))
def noise_select_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = line_pairs(spark, sf_dir)
    return N.fit_label_noise(df, PAIRS, (0.1,)).flip(df, 0.1).select("id", "label", "original_label", "flipped")


@query("stratified_split_counted", I.with_sql(PAIRS_SQL, I.SPLIT_SQL, "SELECT id, label, is_test FROM split"))
def stratified_split_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(line_pairs(spark, sf_dir), PAIRS).select("id", "label", "is_test")


@query(
    "stratified_folds_counted",
    I.with_sql(PAIRS_SQL, "SELECT id, label, ntile(5) OVER (PARTITION BY label ORDER BY id)::INT AS fold FROM base"),
)
def stratified_folds_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_folds(line_pairs(spark, sf_dir), PAIRS).select("id", "label", "fold")


@query(
    "standardize",
    I.with_sql(
        I.ORDER_BANDS_SQL,
        I.SCALED_SQL,
        "SELECT id, round(z1, 6) AS q, round(z2, 6) AS p, round(z3, 6) AS c, label FROM z",
    ),
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = store(I.order_bands(spark, sf_dir), "bands")
    scaled = fit_scaler(df, I.BANDS.feature_cols).transform(df)
    return I.rounded(scaled.select("id", "q", "p", "c", "label"), "q", "p", "c")


@query(
    "standardize_held_out",
    I.with_sql(
        I.PART_BANDS_SQL,
        I.SPLIT_SQL,
        """SELECT id, round((q - mq) / sq, 6) AS q, round((p - mp) / sp, 6) AS p, round((c - mc) / sc, 6) AS c
           FROM split, (SELECT avg(q) mq, stddev_pop(q) sq, avg(p) mp, stddev_pop(p) sp, avg(c) mc, stddev_pop(c) sc
                        FROM split WHERE NOT is_test) WHERE is_test""",
    ),
)
def standardize_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training rows, applied to the test rows."""
    split = store(train_test_split(I.part_bands(spark, sf_dir), I.BANDS), "split")
    scaler = fit_scaler(split.where("not is_test"), I.BANDS.feature_cols)
    return I.rounded(scaler.transform(split.where("is_test")).select("id", "q", "p", "c"), "q", "p", "c")


@query(
    "class_distribution",
    """SELECT event_type AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 6) AS share
       FROM events GROUP BY event_type""",
)
def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.rounded(class_distribution(I.events(spark, sf_dir), "event_type"), "share")


@query(
    "dataset_info",
    "SELECT 'events' AS path, count(*) AS samples, 1 AS features, count(DISTINCT event_type) AS classes FROM events",
)
def info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_info(I.events(spark, sf_dir), "event_type", 1, "events")


@query(
    "label_shift",
    I.with_sql(
        I.EVENTS_SQL,
        I.noisy_sql((0.5,)),
        "a AS (SELECT original_label AS label, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS s FROM noisy GROUP BY 1)",
        "b AS (SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS s FROM noisy GROUP BY 1)",
        """SELECT label, coalesce(a.n, 0) AS n_before, round(coalesce(a.s, 0), 6) AS share_before,
             coalesce(b.n, 0) AS n_after, round(coalesce(b.s, 0), 6) AS share_after,
             round(coalesce(b.s, 0) - coalesce(a.s, 0), 6) AS share_delta, coalesce(b.n, 0) - coalesce(a.n, 0) AS n_delta,
             round(sum(abs(coalesce(b.s, 0) - coalesce(a.s, 0))) OVER () / 2, 6) AS total_variation
           FROM a FULL JOIN b USING (label)""",
    ),
)
def shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = I.events(spark, sf_dir)
    noisy = N.fit_label_noise(df, I.EVENTS, (0.5,)).flip(df, 0.5)
    return I.rounded(
        label_shift(df, noisy, "event_type"),
        "share_before",
        "share_after",
        "share_delta",
        "total_variation",
    )
