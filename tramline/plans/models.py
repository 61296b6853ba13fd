"""Statistical models and machine-learning pipelines."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tramline import bindings as B
from tramline.bindings import register_sql
from tramline.operators import aggregates, corpus, mlops, quantiles, regression, repair, shaping, spatial, timeseries
from tramline.plans.aggregates import QS
from tramline.plans.transit import features
from tramline.plans.util import r
from tramline.plans.windows import sensor_ema
from tramline.registry import query
from tramline.session import cut_lineage, scratch_path, table
from tramline.sources import writers

CATEGORIES = ["route_type", "dow_text"]
NUMBERS = [
    "scheduled_tt", "sched_hour", "lat", "lon", "min_transfer_time", "transfer_degree", "hour_sin", "hour_cos",
]


def training_set(spark, root):
    """Delay features with label (delay > 100 s) and class weights; the features are written once, then counted."""
    f = features(spark, root).withColumn("label", (F.col("delay") > 100).cast("double"))
    return aggregates.class_weights(cut_lineage(f.withColumn("dow_text", F.col("dow").cast("string"))), "label")


def split(df):
    parts = shaping.hash_split(df, "event_id", {"train": 80, "test": 20})
    return parts.where("split = 'train'"), parts.where("split = 'test'")


def _classify(spark, root, pipeline, name):
    train, test = split(training_set(spark, root))
    out = pipeline.fit(train).transform(test)
    return out.select("event_id", "label", r(mlops.positive(f"{name}_prob")).alias("probability"), f"{name}_pred")


@query("ml_kmeans_elbow")
def ml_kmeans_elbow(spark, root):
    sites = table(spark, root, "customer").select("c_custkey", "c_acctbal")
    k, _, rows = mlops.kmeans_elbow(sites, "c_acctbal")
    return mlops.cluster_stats(rows, "c_acctbal").withColumn("k", F.lit(k))


def fold_rows(fits):
    """Rows of a cross-validation, in millions where squared; ``best`` marks the fold of least error."""
    best, rows = regression.best_fold(fits), []
    for fold, fit in fits:
        pi = 1.96 * fit.residual_std
        values = (fit.mse / 1e6, fit.r2, fit.residual_mean, pi / fit.n**0.5, pi)
        rows.append((fold, int(fit.n), *[float(v) for v in values], fold == best))
    return rows


FOLDS = "fold bigint, n bigint, mse_millions double, r2 double, residual_mean double, ci_mean double, pi_95 double, best boolean"


def _digits(out):
    digits = {"mse_millions": 4, "r2": 6, "residual_mean": 2, "ci_mean": 2, "pi_95": 2}
    return out.withColumns({c: r(c, d) for c, d in digits.items()})


@query(
    "ml_linreg_cv",
    """WITH o AS (SELECT o_totalprice AS y, CAST(o_custkey AS DOUBLE) AS x, (row_number() OVER (ORDER BY o_orderdate, o_orderkey)
              - 1) * 6 // (SELECT count(*) FROM orders) AS block FROM orders),
       f AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM o, range(1, 6) g(fold) WHERE block < fold
             GROUP BY fold),
       e AS (SELECT fold, y, y - a - b * x AS e FROM f JOIN o ON o.block = f.fold),
       s AS (SELECT fold, count(*) AS n, avg(e * e) AS mse, 1 - sum(e * e) / (sum(y * y) - sum(y) * sum(y) / count(*)) AS r2,
             avg(e) AS m, stddev_pop(e) AS sd FROM e GROUP BY fold)
       SELECT fold, n, round(mse / 1e6, 4) AS mse_millions, round(r2, 6) AS r2, round(m, 2) AS residual_mean,
       round(sd * 1.96 / sqrt(n), 2) AS ci_mean, round(sd * 1.96, 2) AS pi_95, mse = min(mse) OVER () AS best FROM s""",
)
def ml_linreg_cv(spark, root):
    """Expanding-window cross-validation from one matrix of moments per block."""
    o = table(spark, root, "orders").select("o_orderkey", "o_orderdate", "o_custkey", "o_totalprice")
    ranked = shaping.dense_index(o, ["o_orderdate", "o_orderkey"], "pos")
    total = o.agg(F.count(F.lit(1)))
    blocks = ranked.withColumn("block", F.floor(F.col("pos") * 6 / total.scalar()))
    fits = regression.cross_validate(regression.block_moments(blocks, "block", ["o_custkey"], "o_totalprice"))
    return _digits(spark.createDataFrame(fold_rows(fits), FOLDS))


#: Series of the wide matrix: the quantities that groups of suppliers shipped on a day; the last one is the target.
SERIES = [f"s{i}" for i in range(94)]
NEIGHBOURS, TARGET = SERIES[:-1], SERIES[-1]

register_sql(
    "series",
    """SELECT d.day, g.grp, COALESCE(v.q, 0e0) AS q, block FROM
       (SELECT day, (row_number() OVER (ORDER BY day) - 1) * 6 // count(*) OVER () AS block
        FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)) d
       CROSS JOIN range(94) g(grp) LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey % 94 AS grp,
       CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem GROUP BY 1, 2) v ON v.day = d.day AND v.grp = g.grp""",
)


def wide_series(spark, root):
    """One row per day: the target's series beside 93 neighbours', and the block of the day in time order."""
    li = table(spark, root, "lineitem")
    sold = li.groupBy(F.to_date("l_shipdate").alias("day"), (F.col("l_suppkey") % 94).alias("grp"))
    sold = sold.agg(F.sum("l_quantity").cast("double").alias("q"))
    # a declared list of series: no pass that looks for them
    wide = sold.groupBy("day").pivot("grp", list(range(94))).agg(F.sum("q")).na.fill(0.0)
    wide = shaping.dense_index(wide.toDF("day", *SERIES), ["day"], "pos")
    n = sold.agg(F.countDistinct("day"))
    return cut_lineage(wide.withColumn("block", F.floor(F.col("pos") * 6 / n.scalar())))


@query("ml_linreg_poly")
def ml_linreg_poly(spark, root):
    """Three neighbours with their squares and products, in expanding folds."""
    fits = regression.cross_validate(regression.block_moments(wide_series(spark, root), "block", NEIGHBOURS[:3], TARGET, degree=2))
    return spark.createDataFrame(fold_rows(fits), FOLDS)


REPAIR_STEP, REPAIR_FROM = 21600, 1705276800  # six hours; good from 2024-01-15


@query("ml_drift_repair")
def ml_drift_repair(spark, root):
    w = B.weather(spark, root).withColumnRenamed("station_id", "site").withColumnRenamed("temp", "value")
    series = cut_lineage(timeseries.resample_mean(w, ["site"], "t", "value", REPAIR_STEP))
    faulty = table(spark, root, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("site"))
    sites = B.stations(spark, root).select(F.col("station_id").alias("site"), "lat", "lon")
    good = sites.join(faulty, "site", "left_anti").withColumnRenamed("site", "neighbour")
    near = spatial.nearest(sites.join(faulty, "site", "left_semi"), "site", good, "neighbour", k=3)
    repairs = faulty.withColumns(
        {"good_from": F.lit(REPAIR_FROM).cast("bigint"), "good_to": F.lit(2**40).cast("bigint")}
    )
    return repair.repair_sites(series, repairs, near.select("site", "neighbour", "rank"), 3)


@query(
    "ml_ema_score",
    """SELECT sensor, round(avg(abs(value - ema)), 5) AS mae, round(avg((value - ema) * (value - ema)), 4) AS mse,
       round(1 - sum((value - ema) * (value - ema)) / (var_pop(value) * count(*)), 5) AS r2,
       round(1.96 * stddev_pop(value - ema), 4) AS width FROM ema GROUP BY sensor""",
)
def ml_ema_score(spark, root):
    err = F.col("value") - F.col("ema")
    return sensor_ema(spark, root).groupBy("sensor").agg(
        r(F.avg(F.abs(err)), 5).alias("mae"), r(F.avg(err * err), 4).alias("mse"),
        r(1 - F.sum(err * err) / (F.var_pop("value") * F.count("value")), 5).alias("r2"),
        r(1.96 * F.stddev_pop(err), 4).alias("width"),
    )


_BINS = "least(floor(({0} - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END * 16), 15)"


@query(
    "ml_select_mutual_info",
    f"""WITH e AS (SELECT grp, min(q) AS lo, max(q) AS hi FROM series GROUP BY grp),
        b AS (SELECT day, grp, {_BINS.format('q')} AS x FROM series JOIN e USING (grp)),
        j AS (SELECT f.grp, f.x, t.x AS y, count(*) AS nxy FROM b f JOIN b t ON t.day = f.day AND t.grp = 93
              WHERE f.grp < 93 GROUP BY 1, 2, 3),
        t AS (SELECT grp, nxy, sum(nxy) OVER (PARTITION BY grp, x) AS nx, sum(nxy) OVER (PARTITION BY grp, y) AS ny,
              sum(nxy) OVER (PARTITION BY grp) AS n FROM j)
        SELECT 's' || grp AS feature, round(sum(nxy / CAST(n AS DOUBLE) * ln(CAST(nxy AS DOUBLE) * CAST(n AS DOUBLE) /
        (CAST(nx AS DOUBLE) * CAST(ny AS DOUBLE)))), 7) AS mi FROM t GROUP BY grp""",
)
def ml_select_mutual_info(spark, root):
    wide = wide_series(spark, root)
    return regression.mutual_information(wide, NEIGHBOURS, TARGET).withColumn("mi", r("mi", 7))


def _selection(spark, steps):
    """One row per step, and whether its features are the best set."""
    best = regression.best_step(steps)
    rows = [
        (len(s.use), None if s.changed is None else NEIGHBOURS[s.changed], float(s.r2), s is best, sorted(NEIGHBOURS[i] for i in s.use))
        for s in steps
    ]
    return spark.createDataFrame(rows, "features int, changed string, r2 double, best boolean, names array<string>")


@query("ml_select_forward")
def ml_select_forward(spark, root):
    """R2 with the best 1, 2, ... of 93 features in order of mutual information, and the best set."""
    wide = wide_series(spark, root)
    mi = {m.feature: m.mi for m in regression.mutual_information(wide, NEIGHBOURS, TARGET).collect()}
    ranked = sorted(range(len(NEIGHBOURS)), key=lambda i: (-round(mi[NEIGHBOURS[i]], 12), i))
    return _selection(spark, regression.forward_by_rank(regression.block_moments(wide, "block", NEIGHBOURS, TARGET), ranked))


@query("ml_select_rfe")
def ml_select_rfe(spark, root):
    """R2 with 93, 92, ... features, the one of smallest coefficient dropped each time, and the best set."""
    moments = regression.block_moments(wide_series(spark, root), "block", NEIGHBOURS, TARGET)
    return _selection(spark, regression.backward_elimination(moments))


@query(
    "ml_impute",
    "SELECT event_id, round(COALESCE(value, (SELECT avg(value) FROM readings)), 6) AS value FROM readings",
)
def ml_impute(spark, root):
    rd = B.readings(spark, root).select("event_id", "value")
    return mlops.impute_mean(rd, ["value"]).withColumn("value", r("value"))


@query("ml_feature_pipeline")
def ml_feature_pipeline(spark, root):
    df = training_set(spark, root)
    out = Pipeline(stages=mlops.feature_stages(CATEGORIES, NUMBERS, True)).fit(df).transform(df)
    v = vector_to_array("features")
    return out.select(
        "event_id", F.size(v).alias("width"), r(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), 4).alias("total")
    )


@query("ml_logreg_weighted")
def ml_logreg_weighted(spark, root):
    return _classify(spark, root, mlops.logistic(CATEGORIES, NUMBERS), "lr")


@query("ml_random_forest_cls")
def ml_random_forest_cls(spark, root):
    return _classify(spark, root, mlops.forest(CATEGORIES, NUMBERS), "rf")


@query("ml_gbt_cls")
def ml_gbt_cls(spark, root):
    return _classify(spark, root, mlops.boosted(CATEGORIES, NUMBERS), "gbt")


def three_models(train, more=None):
    return mlops.train_many(
        {
            **(more or {}),
            "lr": mlops.logistic(CATEGORIES, NUMBERS),
            "rf": mlops.forest(CATEGORIES, NUMBERS, trees=100),
            "gbt": mlops.boosted(CATEGORIES, NUMBERS, rounds=20),
        },
        train,
    )


@query("ml_train_many")
def ml_train_many(spark, root):
    """AUC on the test part of three models; a broken pipeline is listed with its error."""
    train, test = split(training_set(spark, root))
    models, errors = three_models(train, {"broken": mlops.forest(["no_such_column"], NUMBERS)})
    scored = [
        model.transform(test).select(F.lit(name).alias("model"), "label", mlops.positive(f"{name}_prob").alias("p"))
        for name, model in models.items()
    ]
    out = mlops.auc_per(reduce(lambda a, b: a.unionByName(b), scored), ["model"], "label", "p")
    bad = spark.createDataFrame([(n, None, e) for n, e in errors.items()], "model string, auc double, error string")
    return out.withColumn("error", F.lit(None).cast("string")).unionByName(bad)


_SCORED = """SELECT model, label, score, CASE WHEN score >= 40 THEN 1 ELSE 0 END AS pred FROM (
    SELECT CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS label, UNNEST([{'model': 'value', 'score': round(value, 0)},
    {'model': 'user', 'score': CAST(user_id % 100 AS DOUBLE)}], recursive := true) FROM events)"""


@query(
    "ml_eval_binary",
    f"""WITH s AS ({_SCORED}), g AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS q FROM s GROUP BY 1, 2),
        w AS (SELECT model, p, q, sum(q) OVER (PARTITION BY model ORDER BY score) - q AS below FROM g),
        a AS (SELECT model, sum(p * (below + q / 2e0)) / (CAST(sum(p) AS DOUBLE) * sum(q)) AS auc FROM w GROUP BY model),
        c AS (SELECT model, CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS DOUBLE) AS n00,
                     CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS DOUBLE) AS n01,
                     CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS DOUBLE) AS n10,
                     CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS DOUBLE) AS n11 FROM s GROUP BY model),
        m AS (SELECT model, auc, (n00 + n11) / (n00 + n01 + n10 + n11) AS accuracy,
              COALESCE(n00 / nullif(n00 + n10, 0), 0) AS precision_0, COALESCE(n00 / nullif(n00 + n01, 0), 0) AS recall_0,
              COALESCE(2 * n00 / nullif(2 * n00 + n10 + n01, 0), 0) AS f1_0, COALESCE(n11 / nullif(n11 + n01, 0), 0) AS precision_1,
              COALESCE(n11 / nullif(n11 + n10, 0), 0) AS recall_1, COALESCE(2 * n11 / nullif(2 * n11 + n01 + n10, 0), 0) AS f1_1,
              (COALESCE((n00 + n01) * 2 * n00 / nullif(2 * n00 + n10 + n01, 0), 0) +
               COALESCE((n10 + n11) * 2 * n11 / nullif(2 * n11 + n01 + n10, 0), 0)) / (n00 + n01 + n10 + n11) AS weighted_f1
              FROM c JOIN a USING (model))
        SELECT model, metric, round(value, 6) AS value, value = max(value) OVER (PARTITION BY metric) AS best FROM m
        UNPIVOT (value FOR metric IN (auc, accuracy, precision_0, recall_0, f1_0, precision_1, recall_1, f1_1, weighted_f1))""",
)
def ml_eval_binary(spark, root):
    """Two scores of the same rows side by side, and the best of each metric."""
    scored = table(spark, root, "events").select(
        F.col("event_type").isin("click", "view").cast("int").alias("label"),
        F.explode(F.create_map(F.lit("value"), F.round("value", 0), F.lit("user"), (F.col("user_id") % 100).cast("double"))).alias(
            "model", "score"
        ),
    )
    scored = scored.withColumn("pred", (F.col("score") >= 40).cast("int"))
    return mlops.compare_binary(scored, "model", "label", "score", "pred").withColumn("value", r("value"))


@query("ml_feature_importance")
def ml_feature_importance(spark, root):
    train, _ = split(training_set(spark, root))
    rows = mlops.importances(mlops.forest(CATEGORIES, NUMBERS, trees=100).fit(train), train)
    return spark.createDataFrame(rows, "feature string, importance double")


@query("ml_ensemble_mean")
def ml_ensemble_mean(spark, root):
    train, test = split(training_set(spark, root))
    models, errors = three_models(train)
    if errors:
        raise RuntimeError(f"the mean needs all models: {errors}")
    out = mlops.ensemble_mean(test, models)
    return out.select("event_id", "label", r("probability").alias("probability"), "prediction")


@query("ml_grid_cv")
def ml_grid_cv(spark, root):
    """AUC on training and test rows per setting of boosted trees: 18 settings in 5 folds, and their means (fold null)."""
    train, _ = split(training_set(spark, root))
    data = mlops.folded(train, CATEGORIES, NUMBERS, "event_id", 5)
    return mlops.boosted_grid(data, [3, 5, 7], [10, 20, 50], [0.1, 0.2], 5)


@query("ml_grid_cv_regressor")
def ml_grid_cv_regressor(spark, root):
    """RMSE on training and test rows per setting of the residual forest: 18 settings in 3 folds, and their means (fold null)."""
    data = shaping.hash_split(residuals(features(spark, root)), "event_id", {"0": 1, "1": 1, "2": 1})
    data = data.select(F.col("residual_label").alias("label"), "features", F.col("split").cast("int").alias("fold"))
    return mlops.forest_grid(cut_lineage(data), [20, 50, 100], [5, 10, 15], [32, 64], 3)


#: Columns of the delay features that are keys, codes or the label.
NO_INPUTS = {"event_id", "trip_id", "stop_id", "route_id", "route_type", "delay"}


def hybrid_inputs(features) -> list[str]:
    """Numeric delay features and the baseline median."""
    numeric = [f.name for f in features.schema if isinstance(f.dataType, NumericType) and f.name not in NO_INPUTS]
    return sorted(numeric) + ["q50"]


def residuals(df):
    """Delay features as a vector with the baseline median per (route, stop, hour) and what is left of the delay."""
    keys = ["route_id", "stop_id", "sched_hour"]
    base = quantiles.discrete_quantiles(df, keys, "delay", {"q50": 0.5}).drop("n")
    data = df.join(base, keys).withColumn("residual_label", F.col("delay") - F.col("q50"))
    return VectorAssembler(inputCols=hybrid_inputs(df), outputCol="features").transform(data)


def hybrid_quantile(df, trees: int = 100, depth: int = 10):
    """Predicted delay quantiles: baseline median + residual forest + residual quantile.

    The baseline is the median per (route, stop, hour); quantiles of the residual
    on the validation part shift the point prediction.
    """
    parts = cut_lineage(shaping.hash_split(residuals(df), "event_id", {"train": 70, "valid": 15, "test": 15}))
    forest = RandomForestRegressor(labelCol="residual_label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=42)
    model = forest.fit(parts.where("split = 'train'"))
    scored = model.transform(parts.where("split <> 'train'")).withColumn("point", F.col("q50") + F.col("prediction"))
    valid = scored.where("split = 'valid'").withColumn("residual", F.col("delay") - F.col("point"))
    shifts = valid.stat.approxQuantile("residual", list(QS.values()), 0.001)
    return scored.withColumns({f"pred_{q[1:]}": F.col("point") + s for q, s in zip(QS, shifts)})


@query("ml_hybrid_quantile")
def ml_hybrid_quantile(spark, root):
    """RMSE of every quantile prediction on validation and test rows."""
    scored = hybrid_quantile(features(spark, root))
    names = [f"pred_{q[1:]}" for q in QS]
    rmse = scored.groupBy("split").agg(
        *[F.sqrt(F.avg(F.pow(F.col("delay") - F.col(n), 2))).alias(n) for n in names], F.count(F.lit(1)).alias("n")
    )
    return rmse.select("split", "n", *[r(n, 4).alias(n) for n in names])


def kmer_vectors(spark, root, k: int = 3):
    """Sequences with their canonical k-mer frequencies as a vector, one place per k-mer of the fixed vocabulary."""
    other = str.maketrans("acgt", "tgca")
    names = ["".join(letters) for letters in product("acgt", repeat=k)]
    names = sorted({min(x, x.translate(other)[::-1]) for x in names})
    freq = corpus.kmer_frequencies(B.seqs(spark, root), k)
    # a row per sequence and k-mer is all that meets; nothing is repeated by its count
    wide = freq.groupBy("seq_id").pivot("kmer", names).agg(F.max("freq")).na.fill(0.0)
    labels = B.seqs(spark, root).select("seq_id", F.col("promoter").cast("double").alias("label"))
    rows = wide.join(labels, "seq_id").select("seq_id", "label", F.array(*names).alias("f"))
    return cut_lineage(rows).withColumn("features", array_to_vector("f"))


@query("ml_kmer_classifier")
def ml_kmer_classifier(spark, root):
    """Confusion counts of a forest on k-mer frequencies, 3 hashed folds."""
    data = shaping.hash_split(kmer_vectors(spark, root), "seq_id", {"0": 1, "1": 1, "2": 1})
    out = None
    for fold in ("0", "1", "2"):
        model = RandomForestClassifier(numTrees=100, maxDepth=5, seed=42).fit(data.where(f"split <> '{fold}'"))
        part = model.transform(data.where(f"split = '{fold}'")).select("label", "prediction")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("ml_pca")
def ml_pca(spark, root):
    data = kmer_vectors(spark, root)
    out = PCA(k=2, inputCol="features", outputCol="pc").fit(data).transform(data)
    pc = vector_to_array("pc")
    return out.select("seq_id", r(pc[0]).alias("pc1"), r(pc[1]).alias("pc2"))


@query("ml_kmeans_agreement")
def ml_kmeans_agreement(spark, root):
    e = table(spark, root, "embeddings").select(
        array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
        (F.col("label") >= 5).cast("int").alias("truth"),
    )
    out = KMeans(k=2, seed=42, predictionCol="cluster").fit(e).transform(e)
    return mlops.agreement(out, "cluster", "truth")


@query("udf_vector_elem")
def udf_vector_elem(spark, root):
    train, test = split(training_set(spark, root))
    out = mlops.logistic(CATEGORIES, NUMBERS).fit(train).transform(test)
    return out.select("event_id", mlops.positive("lr_prob").alias("positive_probability"))


@query("model_store")
def model_store(spark, root):
    """Train once under a key of regions and weekdays, then load the stored model and predict."""
    train, test = split(training_set(spark, root))
    folder = scratch_path(spark, "models")
    key = writers.model_key(["North district", "South district"], [1, 2, 3, 4, 5])
    pipeline = mlops.logistic(CATEGORIES, NUMBERS)
    writers.load_or_train(spark, folder, key, lambda: pipeline.fit(train))
    model = writers.load_or_train(spark, folder, key, lambda: pipeline.fit(train))
    return model.transform(test).select("event_id", "lr_pred")
