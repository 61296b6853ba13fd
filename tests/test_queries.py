"""Every registered query against its SQL on the smallest tables."""

import importlib.util
import math
import os

import duckdb
import pytest

_path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
_spec = importlib.util.spec_from_file_location("spark_entry", _path)
contract = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(contract)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SLOW = {"ml_gbt_cls", "ml_ensemble_mean", "ml_train_many", "ml_grid_cv", "ml_grid_cv_regressor", "ml_random_forest_cls", "ml_kmer_classifier", "model_store"}
# thresholds that nothing reaches in a tiny sample
MAY_BE_EMPTY = {"agg_having", "set_difference", "full_periods_only", "weather_flat", "qualified_trips", "visits_clean", "robust_paths", "robust_arrival", "ml_drift_repair"}


@pytest.fixture(scope="module")
def con(root):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float) and v == int(v):
        return int(v)
    return v if isinstance(v, (int, float, str, bool)) else str(v)


def table(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(set(contract.queries()) - SLOW))
def test_query(spark, con, root, key):
    df = contract.queries()[key](spark, root)
    got = table(df.collect(), df.columns)
    assert got or key in MAY_BE_EMPTY
    sql = contract.oracle_sql().get(key)
    if sql:
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(df.columns)
        assert got == table(res.fetchall(), names)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1000 and "start_time" in df.columns
