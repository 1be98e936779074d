"""Sufficient-statistics (Gram) path equals Spark ML fits and the one-feature closed form."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF
from heliopanel.operators import models as M
from heliopanel.operators.cv import ridge_grid_scores
from heliopanel.operators.linear import fit_gram, ridge_cv_gram
from heliopanel.operators.splits import fold_pairs, ts_folds
from heliopanel.plans.fixtures import model_frame

FEATS = ["global_rad:W", "sun_elevation:d", "pv_production_lag_1"]


def test_gram_ols_equals_spark_ml(spark):
    tr = model_frame(spark, SF).where("split = 'train'")
    g = {r.term: r.value for r in fit_gram(tr, FEATS, "pv_production").collect()}
    ml = M.fit(tr, FEATS, "pv_production", "linear", scaling="none")
    assert abs(g["intercept"] - ml.model.intercept) < 1e-8
    assert np.allclose([g[c] for c in FEATS], ml.model.coefficients.toArray(), rtol=1e-9, atol=1e-10)


def test_gram_ridge_cv_equals_per_fold_spark_ml(spark):
    tr = model_frame(spark, SF).where("split = 'train'")
    got = {(r.alpha, r.fold): r.mse for r in ridge_cv_gram(tr, FEATS, "pv_production", [1.0, 100.0], 3, ["site_id"]).collect()}
    pairs = fold_pairs(ts_folds(tr, 3, ["site_id"]), 3).cache()
    for f in range(3):
        ftr = pairs.where((F.col("fold") == f) & (F.col("role") == "train"))
        fte = pairs.where((F.col("fold") == f) & (F.col("role") == "test"))
        for a in (1.0, 100.0):
            fm = M.fit(ftr, FEATS, "pv_production", "ridge", {"alpha": a})
            mse = fm.transform(fte).agg(F.avg((F.col("prediction") - F.col("pv_production")) ** 2)).first()[0]
            assert abs(mse - got[(a, f)]) < 1e-7 * max(1.0, mse)


def test_gram_ridge_one_feature_equals_closed_form_grid(spark):
    tr = model_frame(spark, SF).where("split = 'train'")
    alphas = [0.1, 10.0, 1000.0]
    g = ridge_cv_gram(tr, ["global_rad:W"], "pv_production", alphas, 5, ["site_id"])
    g = {r.alpha: -r.m for r in g.groupBy("alpha").agg(F.avg("mse").alias("m")).collect()}
    c = {r.alpha: r.mean_test_score for r in ridge_grid_scores(tr, "pv_production", "global_rad:W", alphas, 5, ["site_id"]).collect()}
    for a in alphas:
        assert abs(g[a] - c[a]) < 1e-8 * abs(c[a])


def test_gram_estimator_matches_spark_ml_and_round_trips(spark, tmpdir_path):
    import os
    from heliopanel.sources import sinks
    mf = model_frame(spark, SF)
    tr = mf.where("split = 'train'")
    for gram, ml, params in (("linear_gram", "linear", {}), ("ridge_gram", "ridge", {"alpha": 10.0})):
        a = M.fit(tr, FEATS, "pv_production", gram, params)
        b = M.fit(tr, FEATS, "pv_production", ml, params)
        pa = a.transform(mf).select("site_id", "time", F.col("prediction").alias("pa"))
        pb = b.transform(mf).select("site_id", "time", F.col("prediction").alias("pb"))
        worst = pa.join(pb, ["site_id", "time"]).agg(F.max(F.abs(F.col("pa") - F.col("pb")) /
                                                         F.greatest(F.abs("pb"), F.lit(1.0)))).first()[0]
        assert worst < 1e-8
        assert set(a.transform(mf).columns) == set(mf.columns) | {"prediction"}
    path = sinks.save_bundle(spark, os.path.join(tmpdir_path, "gram"), a)
    back = sinks.load_bundle(spark, path)
    assert back.transform(mf).select("prediction").exceptAll(a.transform(mf).select("prediction")).count() == 0


def test_grid_search_cv_equals_gram_cv(spark):
    import json
    tr = model_frame(spark, SF).where("split = 'train'")
    g = M.grid_search_cv(tr, FEATS, "pv_production", "ridge", {"alpha": [1.0, 100.0]}, 3, ["site_id"], parallelism=2)
    got = {(json.loads(r.params)["alpha"], r.fold): r.mse for r in g.collect()}
    exp = {(r.alpha, r.fold): r.mse for r in ridge_cv_gram(tr, FEATS, "pv_production", [1.0, 100.0], 3, ["site_id"]).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert abs(got[k] - exp[k]) < 1e-7 * max(1.0, exp[k])


def test_gram_lasso_cv_equals_per_fold_spark_ml(spark):
    from heliopanel.operators.linear import lasso_cv_gram
    tr = model_frame(spark, SF).where("split = 'train'")
    alphas = [0.1, 5.0]
    got = {(r.alpha, r.fold): r.mse for r in lasso_cv_gram(tr, FEATS, "pv_production", alphas, 3, ["site_id"]).collect()}
    pairs = fold_pairs(ts_folds(tr, 3, ["site_id"]), 3).cache()
    for f in range(3):
        ftr = pairs.where((F.col("fold") == f) & (F.col("role") == "train"))
        fte = pairs.where((F.col("fold") == f) & (F.col("role") == "test"))
        for a in alphas:
            fm = M.fit(ftr, FEATS, "pv_production", "lasso", {"alpha": a})
            mse = fm.transform(fte).agg(F.avg((F.col("prediction") - F.col("pv_production")) ** 2)).first()[0]
            assert abs(mse - got[(a, f)]) < 1e-6 * max(1.0, mse)
