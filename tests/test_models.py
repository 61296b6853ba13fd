"""Least squares from Gramians, metrics, splits, repair."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tramline.operators import mlops, regression, repair, shaping
from tramline.sources import writers


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 10, 0.1]
    y = 3 + 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=400) * 0.1
    return x, y


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(i, i // 100, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, block int, a double, b double, c double, y double").persist()


def lstsq(x, y):
    z = np.c_[np.ones(len(x)), x]
    return np.linalg.lstsq(z, y, rcond=None)[0]


def test_cross_validation_equals_numpy(frame, data):
    x, y = data
    grams = regression.block_moments(frame, "block", ["a", "b", "c"], "y")
    for fold, fit in regression.cross_validate(grams):
        beta = lstsq(x[: fold * 100], y[: fold * 100])
        assert np.allclose(fit.beta, beta, atol=1e-8)
        part = slice(fold * 100, fold * 100 + 100)
        err = y[part] - np.c_[np.ones(100), x[part]] @ beta
        assert fit.mse == pytest.approx(np.mean(err**2), rel=1e-6)
        assert fit.r2 == pytest.approx(1 - np.sum(err**2) / np.sum((y[part] - y[part].mean()) ** 2), rel=1e-6)


def test_elimination_drops_the_useless_feature_first(frame):
    grams = regression.block_moments(frame, "block", ["a", "b", "c"], "y")
    steps = regression.backward_elimination(grams)
    assert [s.use for s in steps] == [(0, 1, 2), (0, 1), (1,)] and steps[1].changed == 2
    forward = regression.forward_by_rank(grams, [1, 0, 2])
    assert forward[0].r2 < forward[1].r2 and set(regression.best_step(forward).use) >= {0, 1}


def test_moments_far_from_zero_and_merged(spark):
    rng = np.random.default_rng(6)
    x = 1e8 + rng.normal(size=(3000, 2))
    y = 5e7 + x[:, 0] - 2 * x[:, 1] + rng.normal(size=3000) * 0.01
    rows = [(i % 3, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))] + [(0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "block int, a double, b double, y double").repartition(7)
    got = regression.block_moments(df, "block", ["a", "b"], "y")
    for b in range(3):
        z = np.c_[x, y][b::3]
        assert got[b].n == 1000 and np.allclose(got[b].mean, z.mean(0), rtol=1e-14)
        assert np.allclose(got[b].products, (z - z.mean(0)).T @ (z - z.mean(0)), rtol=1e-5)
    assert regression.solve(got[0] + got[1] + got[2])[1:] == pytest.approx([1, -2], abs=1e-3)


def test_second_degree_equals_numpy(frame, data):
    x, y = data
    blocks = regression.block_moments(frame, "block", ["a", "b"], "y", degree=2)
    fits = regression.cross_validate(blocks)
    wide = np.c_[x[:, :2], x[:, 0] ** 2, x[:, 0] * x[:, 1], x[:, 1] ** 2]
    for fold, fit in fits:
        beta = lstsq(wide[: fold * 100], y[: fold * 100])
        err = y[fold * 100 : fold * 100 + 100] - np.c_[np.ones(100), wide[fold * 100 : fold * 100 + 100]] @ beta
        assert fit.mse == pytest.approx(np.mean(err**2), rel=1e-6)
    assert regression.best_fold(fits) == min(fits, key=lambda f: f[1].mse)[0]


@pytest.fixture(scope="module")
def searched(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    rows = [(i, "a", float(v[0] * v[1] > 0), 1.0, *map(float, v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, c string, label double, weight double, x double, z double")
    return mlops.folded(df, ["c"], ["x", "z"], "id", 2)


def test_grid_of_boosted_trees_equals_single_fits(searched):
    got = {(r.depth, r.rounds, r.step, r.fold): r for r in mlops.boosted_grid(searched, [2], [2, 5], [0.1, 0.3], 2).collect()}
    assert len(got) == 4 * 3
    for fold in (0, 1):
        gbt = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxBins=64, seed=42, maxIter=2, maxDepth=2, stepSize=0.3)
        out = gbt.fit(searched.where(f"fold <> {fold}")).transform(searched)
        out = out.withColumn("p", vector_to_array("rawPrediction")[1])
        for part, rows in (("test", out.where(f"fold = {fold}")), ("train", out.where(f"fold <> {fold}"))):
            assert got[2, 2, 0.3, fold][f"{part}_auc"] == pytest.approx(mlops.auc(rows, "label", "p").first()[0], abs=1e-9)
    mean = (got[2, 5, 0.1, 0].test_auc + got[2, 5, 0.1, 1].test_auc) / 2
    assert got[2, 5, 0.1, None].test_auc == pytest.approx(mean)


def test_grid_of_forests(searched):
    got = mlops.forest_grid(searched.drop("weight"), [3, 6], [2, 4], [16], 2).collect()
    assert len(got) == 4 * 3 and all(0 < r.train_rmse < 0.6 and 0 < r.test_rmse < 0.7 for r in got)
    deep = {r.depth: r.train_rmse for r in got if r.fold is None and r.trees == 6}
    assert deep[4] < deep[2]


def test_a_lost_job_is_not_a_broken_pipeline(spark):
    class Lost:
        def _to_java(self):
            return self

        def transformSchema(self, schema):
            return schema

        def fit(self, train):
            raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        mlops.train_many({"a": Lost()}, spark.range(1))


def test_collinear_features_are_solved(spark, frame):
    twice = frame.withColumn("a2", F.col("a") * 2)
    g = regression.block_moments(twice.withColumn("block", F.lit(0)), "block", ["a", "a2"], "y")[0]
    one = regression.block_moments(frame.withColumn("block", F.lit(0)), "block", ["a"], "y")[0]
    assert regression.score(g, regression.solve(g)).mse == pytest.approx(regression.score(one, regression.solve(one)).mse)


def test_fits_per_key_on_executors(frame, data):
    x, y = data
    fits = regression.fit_per_key(regression.gramian(frame, ["block"], ["a", "b", "c"], "y"), "block").collect()
    for r in fits:
        part = slice(r.block * 100, r.block * 100 + 100)
        assert np.allclose(r.beta, lstsq(x[part], y[part]), atol=1e-7)


def test_mutual_information_orders_features(frame):
    mi = {r.feature: r.mi for r in regression.mutual_information(frame, ["a", "b", "c"], "y", 8).collect()}
    assert mi["b"] > mi["a"] > 0 and mi["b"] > mi["c"]


def test_repair_keeps_length_and_good_values(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=100).cumsum()
    rows = [("s1", t, float(v)) for t, v in enumerate(base)] + [("s2", t, float(2 * v + 1)) for t, v in enumerate(base)]
    truth = 0.5 * base - 3
    rows += [("bad", t, float(v if t < 60 else v + 50)) for t, v in enumerate(truth)]
    series = spark.createDataFrame(rows, "site string, t bigint, value double")
    repairs = spark.createDataFrame([("bad", 0, 59)], "site string, good_from bigint, good_to bigint")
    near = spark.createDataFrame([("bad", "s1", 1), ("bad", "s2", 2)], "site string, neighbour string, rank int")
    got = repair.repair_sites(series, repairs, near, 2).orderBy("t").collect()
    assert len(got) == 100
    for r, v in zip(got, truth):
        assert r.corrected == pytest.approx(v, abs=1e-6)
        assert r.t >= 60 or r.corrected == r.original
        assert r.lo <= r.hi


def test_auc_with_ties(spark):
    pts = [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)]
    wins = sum((1.0 if a > b else 0.5 if a == b else 0.0) for x, a in pts if x for y, b in pts if not y)
    df = spark.createDataFrame(pts, "label int, score double")
    assert mlops.auc(df, "label", "score").first()[0] == pytest.approx(wins / 6)


def test_metrics_by_label_differ(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)], "label int, p int")
    m = mlops.confusion_metrics(df, "label", "p").first()
    assert m.accuracy == pytest.approx(0.6) and m.precision_1 == 0.5 and m.recall_1 == 0.5
    assert m.f1_0 == pytest.approx(2 / 3) and m.f1_1 == 0.5 and m.weighted_f1 == pytest.approx((3 * 2 / 3 + 2 * 0.5) / 5)


def test_splits_partition_the_input(spark):
    df = spark.range(2000)
    out = shaping.hash_split(df, "id", {"train": 70, "valid": 15, "test": 15})
    counts = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and 1300 < counts["train"] < 1500


def test_elbow(spark):
    pts = [(float(c + d),) for c in (0, 100, 200) for d in range(10)]
    k, costs, rows = mlops.kmeans_elbow(spark.createDataFrame(pts, "alt double"), "alt", 6)
    assert k == 3 and costs[0][1] == pytest.approx(np.var([p[0] for p in pts]) * 30)
    assert mlops.cluster_stats(rows, "alt").count() == 3


def test_model_key_ignores_order_and_case():
    assert writers.model_key([" North", "south"], [2, 1]) == writers.model_key(["South", "north"], [1, 2])


def test_failing_pipeline_does_not_stop_the_others(spark):
    df = spark.createDataFrame([(float(i % 2), 1.0, "a", float(i)) for i in range(20)], "label double, weight double, c string, x double")
    models, errors = mlops.train_many(
        {"bad": mlops.logistic(["nope"], ["x"]), "good": mlops.logistic(["c"], ["x"])}, df
    )
    assert list(models) == ["good"] and list(errors) == ["bad"]
