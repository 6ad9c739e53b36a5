"""Queries: trained models, at the settings of the experiment.

SQL cannot fit these models, so their queries give row counts of the split, the folds and the
classes, and whether what was measured keeps its bounds (1 if so): accuracies, the slope of the
logistic loss, the duality gap and the kernel error of the kernel machine, equal predictions of
forests under different partitionings.
"""

from __future__ import annotations


from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from labelwright.functions.local import local_table
from labelwright.functions.scaling import fit_scaler
from labelwright.operators import compare as C
from labelwright.operators import models as M
from labelwright.operators.centroid import fit_centroids
from labelwright.operators.components import TOLERANCE, principal_components
from labelwright.operators.detect import confident_disagreement
from labelwright.operators.importance import permutation_importance
from labelwright.operators.metrics import classification_metrics
from labelwright.operators.noise import fit_label_noise
from labelwright.operators.split import train_test_split
from labelwright.plans import inputs as I
from labelwright.plans.catalog import query
from labelwright.sources.scratch import new_path, store
from labelwright.sources.tables import read_runs
from labelwright.spec import Params

PARAMS = Params()
# A model must beat chance over three classes by 0.2; one trained on noise must beat chance.
CHANCE = 1.0 / 3.0
GRADIENT = 1e-3
# Share of the flipped rows that model-based validation has to find at least.
FOUND = 0.5

COUNTS_SQL = """counts AS (SELECT 'train_rows' AS measure, count(*)::DOUBLE AS value FROM split WHERE NOT is_test
  UNION ALL SELECT 'test_rows', count(*) FROM split WHERE is_test
  UNION ALL SELECT 'support/' || label, count(*) FROM split WHERE is_test GROUP BY label
  UNION ALL SELECT 'fold_rows/' || fold, count(*) FROM (
    SELECT ntile(5) OVER (PARTITION BY label ORDER BY id) AS fold FROM split WHERE NOT is_test) GROUP BY fold)"""


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = store(I.part_bands(spark, sf_dir), "bands")
    return store(train_test_split(bands, I.BANDS), "split")


def noisy_split(spark: SparkSession, sf_dir: str, level: float = 0.1) -> DataFrame:
    split = _split(spark, sf_dir)
    return store(fit_label_noise(split, I.BANDS, (level,)).flip(split, level), "noisy")


def _row(measure: str | Column, value: Column) -> Column:
    name = F.lit(measure) if isinstance(measure, str) else measure
    return F.struct(name.alias("measure"), value.cast("double").alias("value"))


def _rows(df: DataFrame, *entries: Column) -> DataFrame:
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def _supports(scored: DataFrame) -> DataFrame:
    counted = scored.groupBy("label").count()
    return _rows(counted, _row(F.concat(F.lit("support/"), "label"), F.col("count"))).unionByName(
        _rows(scored.agg(F.count("*").alias("n")), _row("test_rows", F.col("n")))
    )


def _bound(name: str, metrics: DataFrame, metric: str, low: float) -> DataFrame:
    one = metrics.where(F.col("metric") == metric)
    return _rows(one, _row(name, (F.col("value") > low) & (F.col("value") <= 1.0)))


def largest_gradient(run: M.Run, train: DataFrame, params: Params) -> float:
    """Largest slope of the penalised loss at the fitted weights, from the scores of the whole table."""
    weights = run.weights
    scored = run.model.transform(train).withColumn("_p", vector_to_array("probability"))
    slopes = []
    for k in range(weights.shape[0]):
        off = F.col("_p")[k] - (F.col("label_idx") == k).cast("double")
        slopes += [F.avg(off * F.col(f"z_{j}")).alias(f"g{k}_{j}") for j in range(weights.shape[1] - 1)]
        slopes.append(F.avg(off).alias(f"b{k}"))
    row = scored.agg(F.count("*").alias("n"), *slopes).first()
    penalty = 1.0 / (params.c * row["n"])
    steep = [abs(row[f"g{k}_{j}"] + penalty * weights[k, j]) for k in range(weights.shape[0]) for j in range(weights.shape[1] - 1)]
    return max(*steep, *[abs(row[f"b{k}"]) for k in range(weights.shape[0])])


def _single(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        split = _split(spark, sf_dir)
        train = split.where("not is_test")
        fitted, scores = M.fit_with_folds(name, train, I.BANDS, PARAMS)
        scored = store(M.score_model(fitted.model, split.where("is_test"), I.BANDS), "scored")
        folds = store(scores, "fold_scores")
        cv = C.cv_summary(folds).unpivot([], ["cv_mean"], "metric", "value")
        out = (
            _rows(train.agg(F.count("*").alias("n")), _row("train_rows", F.col("n")))
            .unionByName(_supports(scored))
            .unionByName(_rows(folds, _row(F.concat(F.lit("fold_rows/"), F.col("fold").cast("string")), F.col("rows"))))
            .unionByName(_bound("accuracy_bound", classification_metrics(scored), "accuracy", CHANCE + 0.2))
            .unionByName(_bound("cv_bound", cv, "cv_mean", CHANCE + 0.2))
        )
        facts = {}
        if name == M.LOGISTIC:
            facts = {"gradient_bound": largest_gradient(fitted, train, PARAMS) < GRADIENT}
        if name == M.KERNEL_SVM:
            facts = {"gap_bound": fitted.facts["gap"] <= PARAMS.svm_gap, "kernel_bound": fitted.facts["kernel_error"] <= 2 * PARAMS.kernel_tolerance}
        if facts:
            out = out.unionByName(local_table(spark, [(m, float(v)) for m, v in facts.items()], "measure string, value double"))
        return out.select(F.lit(name).alias("model"), "measure", "value")

    return run


for _query, _model in (
    ("train_random_forest", M.RANDOM_FOREST),
    ("train_logistic", M.LOGISTIC),
    ("train_kernel_svm", M.KERNEL_SVM),
):
    _bounds = ["accuracy_bound", "cv_bound"] + {M.LOGISTIC: ["gradient_bound"], M.KERNEL_SVM: ["gap_bound", "kernel_bound"]}.get(_model, [])
    _all = " UNION ALL ".join(["SELECT * FROM counts", *[f"SELECT '{b}', 1" for b in _bounds]])
    query(_query, I.with_sql(I.PART_BANDS_SQL, I.SPLIT_SQL, COUNTS_SQL, f"SELECT '{_model}' AS model, measure, value FROM ({_all})"))(_single(_model))


@query(
    "train_all",
    I.with_sql(
        I.PART_BANDS_SQL,
        I.SPLIT_SQL,
        f"""facts AS (SELECT unnest(['accuracy_bound', 'cv_bound', 'logged_metrics', 'logged_params']) AS measure,
              unnest([1, 1, 12, {len(PARAMS.__dict__) + 2}]::DOUBLE[]) AS value
            UNION ALL SELECT 'train_rows', count(*) FROM split WHERE NOT is_test
            UNION ALL SELECT 'test_rows', count(*) FROM split WHERE is_test)""",
        f"SELECT model, measure, value FROM facts, (SELECT unnest({list(M.MODELS)}) AS model)",
    ),
)
def train_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models on one split with cross-validation, and what the run log has of them."""
    bands = store(I.part_bands(spark, sf_dir), "bands")
    log = new_path(spark, "runs")
    _, metrics, _ = M.train_all(bands, I.BANDS, PARAMS, run_log=log, dataset="part_bands")
    good = F.when(F.col("metric") == "accuracy", "accuracy_bound").otherwise("cv_bound")
    bounds = metrics.where("metric in ('accuracy', 'cv_mean')").select("model", good.alias("measure"), F.col("value").between(CHANCE + 0.2, 1.0).cast("double").alias("value"))
    runs = store(read_runs(spark, log), "runs")
    logged = runs.groupBy("model", "kind").count()
    counts = logged.select("model", F.concat(F.lit("logged_"), "kind", F.lit("s")).alias("measure"), F.col("count").cast("double").alias("value"))
    sizes = runs.where("kind = 'param' AND name IN ('train_rows', 'test_rows')")
    return bounds.unionByName(counts).unionByName(sizes.select("model", F.col("name").alias("measure"), F.col("value").cast("double").alias("value")))


SUPPORT_SQL = """SELECT 'support/' || label AS measure, count(*)::DOUBLE AS value FROM split WHERE is_test GROUP BY label
  UNION ALL SELECT 'test_rows', count(*) FROM split WHERE is_test"""


@query(
    "evaluate_saved_model",
    I.with_sql(I.PART_BANDS_SQL, I.SPLIT_SQL, SUPPORT_SQL + " UNION ALL SELECT 'mismatches', 0 UNION ALL SELECT 'accuracy_bound', 1"),
)
def evaluate_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, and score with the training encoder and scaler."""
    split = _split(spark, sf_dir)
    path = new_path(spark, "model")
    model = M.fit_model(M.LOGISTIC, split.where("not is_test"), I.BANDS, PARAMS)
    M.save_model(model, path)
    test = split.where("is_test")
    scored = store(M.score_model(M.load_model(path), test, I.BANDS), "scored")
    own = M.score_model(model, test, I.BANDS).select("id", F.col("prediction").alias("own"))
    differ = scored.join(own, "id", "full").agg(F.count_if(~F.col("prediction").eqNullSafe(F.col("own"))).alias("n"))
    return (
        _supports(scored)
        .unionByName(_rows(differ, _row("mismatches", F.col("n"))))
        .unionByName(_bound("accuracy_bound", classification_metrics(scored), "accuracy", CHANCE + 0.2))
    )


@query(
    "clean_vs_noisy_models",
    I.with_sql(
        I.PART_BANDS_SQL,
        I.SPLIT_SQL,
        SUPPORT_SQL
        + """ UNION ALL SELECT unnest(['clean_bound', 'noisy_bound', 'drop_bound']), 1
              UNION ALL SELECT 'flipped_rows', floor(count(*) * 0.1) FROM base""",
    ),
)
def clean_vs_noisy_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = noisy_split(spark, sf_dir)
    clean = noisy.withColumn("label", F.col("original_label"))
    parts, scored = {}, None
    for name, source in (("clean", clean), ("noisy", noisy)):
        model = M.fit_model(M.RANDOM_FOREST, source.where("not is_test"), I.BANDS, PARAMS)
        scored = store(M.score_model(model, clean.where("is_test"), I.BANDS), "scored")
        parts[name] = classification_metrics(scored)
    drop = C.performance_degradation(parts["clean"], parts["noisy"]).where("metric = 'accuracy'")
    flipped = noisy.agg(F.count_if(F.col("label") != F.col("original_label")).alias("n"))
    return (
        _supports(scored)
        .unionByName(_bound("clean_bound", parts["clean"], "accuracy", CHANCE + 0.2))
        .unionByName(_bound("noisy_bound", parts["noisy"], "accuracy", CHANCE))
        .unionByName(_rows(drop, _row("drop_bound", F.col("absolute_drop").between(-0.1, 0.4))))
        .unionByName(_rows(flipped, _row("flipped_rows", F.col("n"))))
    )


def _suspect_facts(noisy: DataFrame, found: DataFrame, scored: DataFrame) -> DataFrame:
    """Rows judged, suspects that break the rule, and how the suspects meet the flipped rows.

    At least half of the suspects have to be flipped rows, and ``found_bound`` of the flipped
    rows have to be suspects, so that a detector which finds nothing fails.
    """
    truth = noisy.select("id", (F.col("label") != F.col("original_label")).alias("flipped"))
    judged = scored.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
    met = truth.join(found.withColumn("_found", F.lit(True)), "id", "left").agg(
        F.count_if(F.col("_found") & ((F.col("prediction_confidence") <= PARAMS.confidence) | (F.col("predicted_label") == F.col("true_label")))).alias("broken"),
        F.count_if("flipped").alias("flipped"),
        F.count_if("_found").alias("found"),
        F.count_if(F.col("flipped") & F.col("_found")).alias("hits"),
    )
    return _rows(judged, _row("scored_rows", F.col("n")), _row("scored_ids", F.col("ids"))).unionByName(
        _rows(
            met,
            _row("flipped_rows", F.col("flipped")),
            _row("rule_violations", F.col("broken")),
            _row("mostly_flipped", (F.col("found") > 0) & (2 * F.col("hits") >= F.col("found"))),
            _row("found_bound", F.col("hits") >= FOUND * F.col("flipped")),
        )
    )


FACTS_SQL = I.with_sql(
    I.PART_BANDS_SQL,
    """SELECT unnest(['scored_rows', 'scored_ids']) AS measure, count(*)::DOUBLE AS value FROM base
       UNION ALL SELECT 'flipped_rows', floor(count(*) * 0.1::DOUBLE) FROM base
       UNION ALL SELECT unnest(['rule_violations', 'mostly_flipped', 'found_bound']), unnest([0, 1, 1])""",
)


def in_sample_suspects(noisy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Suspects and scores of a forest fitted and scored on the same rows.

    Each row is judged by the trees that did not draw it: a deep tree knows its own rows by heart.
    """
    model = M.fit_model(M.RANDOM_FOREST, noisy, I.BANDS, PARAMS)
    scored = store(model.score(noisy, I.BANDS, out_of_bag=True), "scored")
    return confident_disagreement(scored, M.vocabulary_of(model)), scored


def out_of_fold_suspects(noisy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Suspects and scores of forests that have not seen the row."""
    folded = M.folds_of(noisy, I.BANDS, PARAMS)
    scored = None
    for fold, run in M.fit_runs(M.RANDOM_FOREST, folded, I.BANDS, PARAMS, whole=False).items():
        own = M.score_model(run.model, folded.where(F.col("fold") == fold), I.BANDS)
        scored = own if scored is None else scored.unionByName(own)
    scored = store(scored, "scored")
    return confident_disagreement(scored, M.vocabulary_of(run.model)), scored


@query("confidence_suspects", FACTS_SQL)
def confidence_suspects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted and scored on the same rows."""
    noisy = noisy_split(spark, sf_dir)
    return _suspect_facts(noisy, *in_sample_suspects(noisy))


@query("confidence_suspects_out_of_fold", FACTS_SQL)
def confidence_suspects_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row is scored by a model that has not seen it."""
    noisy = noisy_split(spark, sf_dir)
    return _suspect_facts(noisy, *out_of_fold_suspects(noisy))


@query("confidence_suspect_rows")
def confidence_suspect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suspects themselves, out of fold: labels, confidences, and whether the row was flipped."""
    noisy = noisy_split(spark, sf_dir)
    found, _ = out_of_fold_suspects(noisy)
    truth = noisy.select("id", (F.col("label") != F.col("original_label")).alias("flipped"))
    return I.rounded(found.join(truth, "id"), "prediction_confidence", "true_label_confidence")


# The correlation matrix of three columns has eigenvalues 1 + m, m the roots of
# m^3 - (a^2 + b^2 + c^2) m - 2abc, and eigenvectors that are cross products of its rows.
PCA_SQL = (
    I.ORDER_BANDS_SQL,
    I.SCALED_SQL,
    "r AS (SELECT corr(z1, z2) AS a, corr(z1, z3) AS b, corr(z2, z3) AS c FROM z)",
    "s AS (SELECT *, (a*a + b*b + c*c) / 3 AS s FROM r)",
    """m AS (SELECT a, b, c, k, 2 * sqrt(s) * cos(acos(greatest(-1, least(1, a*b*c / pow(s, 1.5)))) / 3 - 2 * pi() * k / 3) AS m
         FROM s, (SELECT unnest([0, 2, 1]) AS k))""",
    "v AS (SELECT m, row_number() OVER (ORDER BY m DESC) AS i, a*c + b*m AS x, a*b + m*c AS y, m*m - a*a AS w FROM m)",
    "u AS (SELECT m, i, x / sqrt(x*x + y*y + w*w) AS x, y / sqrt(x*x + y*y + w*w) AS y, w / sqrt(x*x + y*y + w*w) AS w FROM v)",
)


@query(
    "pca_projection",
    I.with_sql(
        *PCA_SQL,
        I.noisy_sql((0.1,)),
        """both_ AS (SELECT 'clean' AS dataset, id, label FROM base UNION ALL SELECT 'noisy', id, label FROM noisy)""",
        """SELECT dataset, id, label, round(abs(z1 * p.x + z2 * p.y + z3 * p.w), 4) AS pc1, round(abs(z1 * q.x + z2 * q.y + z3 * q.w), 4) AS pc2,
             round((1 + p.m) / 3, 6) AS ratio1, round((1 + q.m) / 3, 6) AS ratio2
           FROM both_ t JOIN (SELECT id, z1, z2, z3 FROM z) USING (id), (SELECT * FROM u WHERE i = 1) p, (SELECT * FROM u WHERE i = 2) q""",
    ),
)
def pca_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised columns on the first two components of the clean ones; their signs are free."""
    bands = store(I.order_bands(spark, sf_dir), "bands")
    scaled = store(fit_scaler(bands, I.BANDS.feature_cols).transform(bands), "scaled")
    noisy = fit_label_noise(scaled, I.BANDS, (0.1,)).flip(scaled, 0.1)
    projected, ratio = M.pca_projection(scaled, {"noisy": noisy}, I.BANDS)
    return projected.select(
        "dataset",
        "id",
        "label",
        *[F.round(F.abs(c), 4).alias(c) for c in ("pc1", "pc2")],
        *[F.round(F.lit(r), 6).alias(f"ratio{i}") for i, r in enumerate(ratio, 1)],
    )


IMPORTANCE_SQL = (
    I.PART_BANDS_SQL,
    I.noisy_sql((0.1,)),
    I.SPLIT_SQL,
    "given AS (SELECT s.id, s.is_test, s.label, n.label AS noisy, s.q, s.p, s.c FROM split s JOIN noisy n USING (id))",
    "features AS (SELECT unnest(['', 'q', 'p', 'c']) AS feature)",
    "sets AS (SELECT unnest(['clean', 'noisy']) AS dataset)",
    """moved AS (SELECT id, label, q, p, c,
         coalesce(lead(q) OVER wq, first_value(q) OVER wq) AS nq, coalesce(lead(p) OVER wp, first_value(p) OVER wp) AS np,
         coalesce(lead(c) OVER wc, first_value(c) OVER wc) AS nc FROM given WHERE is_test
       WINDOW wq AS (ORDER BY md5('42:q:' || id), id), wp AS (ORDER BY md5('42:p:' || id), id), wc AS (ORDER BY md5('42:c:' || id), id))""",
    """te AS (SELECT dataset || '/' || feature AS run, id, label, CASE WHEN feature = 'q' THEN nq ELSE q END AS q,
         CASE WHEN feature = 'p' THEN np ELSE p END AS p, CASE WHEN feature = 'c' THEN nc ELSE c END AS c FROM moved, features, sets)""",
    """tr AS (SELECT dataset || '/' || feature AS run, CASE WHEN dataset = 'noisy' THEN noisy ELSE label END AS label, q, p, c
         FROM given, features, sets WHERE NOT is_test)""",
    I.centroid_sql(),
    "hit AS (SELECT run, avg((prediction = label)::INT) AS accuracy FROM scored GROUP BY run)",
)


@query(
    "feature_importance_stability",
    I.with_sql(
        *IMPORTANCE_SQL,
        """each_ AS (SELECT dataset, feature, b.accuracy AS whole, h.accuracy AS own FROM sets, features
             JOIN hit h ON h.run = dataset || '/' || feature JOIN hit b ON b.run = dataset || '/' WHERE feature <> '')""",
        """SELECT dataset, feature, round(whole, 6) AS accuracy, round(own, 6) AS permuted_accuracy, round(whole - own, 6) AS importance,
             row_number() OVER (PARTITION BY dataset ORDER BY round(whole - own, 9) DESC, feature)::INT AS rank FROM each_""",
    ),
)
def feature_importance_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permutation importances of the class-mean model trained on clean and on noisy labels, and their ranks."""
    noisy = noisy_split(spark, sf_dir)
    clean = noisy.withColumn("label", F.col("original_label"))
    test = store(clean.where("is_test").select("id", "q", "p", "c", "label"), "test")
    out = None
    for name, source in (("clean", clean), ("noisy", noisy)):
        model = fit_centroids(source.where("not is_test"), I.BANDS)
        own = permutation_importance(model.score, test, I.BANDS, PARAMS.seed).withColumn("dataset", F.lit(name))
        out = own if out is None else out.unionByName(own)
    # One row per feature and data set.
    order = Window.partitionBy("dataset").orderBy(F.round("importance", 9).desc(), "feature")
    ranks = out.withColumn("rank", F.row_number().over(order))
    return I.rounded(ranks, "accuracy", "permuted_accuracy", "importance").select("dataset", "feature", "accuracy", "permuted_accuracy", "importance", "rank")


@query(
    "forest_importance",
    """SELECT d AS dataset, m AS measure, v::DOUBLE AS value FROM (SELECT unnest(['clean', 'noisy']) AS d),
         (SELECT unnest(['importance_sum', 'rows', 'label_feature_leads']) AS m, unnest([1, (SELECT count(DISTINCT l_partkey) FROM lineitem), 1]) AS v)""",
)
def forest_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gain importances of forests on clean and on noisy labels: the column behind the label leads."""
    noisy = noisy_split(spark, sf_dir)
    rows = []
    for name, source in (("clean", noisy.withColumn("label", F.col("original_label"))), ("noisy", noisy)):
        model = M.fit_model(M.RANDOM_FOREST, source, I.BANDS, PARAMS)
        values = M.feature_importances(model, I.BANDS)
        scored = M.score_model(model, source, I.BANDS).where(F.size("probs") == 3).count()
        lead = float(max(values, key=lambda v: v[1])[0] == "c")
        rows += [(name, "importance_sum", round(sum(v for _, v in values), 6)), (name, "rows", float(scored)), (name, "label_feature_leads", lead)]
    return local_table(spark, rows, "dataset string, measure string, value double")


@query(
    "forest_reproducible",
    I.with_sql(
        I.PART_BANDS_SQL,
        """SELECT 'rows' AS measure, count(*)::DOUBLE AS value FROM base
           UNION ALL SELECT unnest(['different_predictions', 'different_probabilities', 'trained_twice']), unnest([0, 0, 1])""",
    ),
)
def forest_reproducible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same forest from the same rows under two partitionings and orders: all predictions are equal."""
    bands = store(I.part_bands(spark, sf_dir), "bands")
    one = store(M.score_model(M.fit_model(M.RANDOM_FOREST, bands.repartition(5, "id"), I.BANDS, PARAMS), bands, I.BANDS), "one")
    shuffled = store(bands.repartition(13, F.xxhash64("p")).sortWithinPartitions(F.desc("q")), "shuffled")
    two = store(M.score_model(M.fit_model(M.RANDOM_FOREST, shuffled, I.BANDS, PARAMS), shuffled, I.BANDS), "two")
    met = one.join(two.select("id", F.col("prediction").alias("_prediction"), F.col("probs").alias("_probs")), "id")
    facts = met.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("prediction") != F.col("_prediction")).alias("a"),
        F.count_if(F.xxhash64("probs") != F.xxhash64("_probs")).alias("b"),
        F.count_distinct("probs").alias("kinds"),
    )
    return _rows(
        facts,
        _row("rows", F.col("rows")),
        _row("different_predictions", F.col("a")),
        _row("different_probabilities", F.col("b")),
        _row("trained_twice", F.col("kinds") > 3),
    )


@query(
    "pca_wide",
    """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)
       SELECT 'rows' AS measure, count(*)::DOUBLE AS value FROM embeddings
       UNION ALL SELECT 'total_variance', round(sum(s), 6) FROM (SELECT var_samp(v) AS s FROM x GROUP BY i)
       UNION ALL SELECT unnest(['residual_bound', 'orthonormal_bound', 'variance_bound']), 1""",
)
def pca_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five components of 64 columns without a matrix of columns by columns.

    Bounds: the error of every axis, the axes' deviation from orthonormal ones, and whether the
    variance of the projected rows is the variance that the axes claim.
    """
    rows = store(I.table(spark, sf_dir, "embeddings").select(F.col("embedding").cast("array<double>").alias("x")), "vectors")
    found = principal_components(rows, 5)
    projected = rows.select(found.project(F.col("x")).alias("pc"))
    own = projected.agg(*[F.var_samp(F.col("pc")[i]).alias(f"v{i}") for i in range(5)]).first()
    variance = max(abs(own[f"v{i}"] - v) for i, v in enumerate(found.variances)) <= 1e-9
    facts = [
        ("rows", float(found.rows)),
        ("total_variance", round(found.total_variance, 6)),
        ("residual_bound", float(found.residual <= TOLERANCE)),
        ("orthonormal_bound", float(found.skew <= 1e-9)),
        ("variance_bound", float(variance)),
    ]
    return local_table(spark, facts, "measure string, value double")
