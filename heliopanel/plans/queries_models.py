"""Registered queries: Spark ML fits and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import models as M
from . import fixture_sql as FX
from .fixtures import model_frame
from .registry import query
from .sqlparts import q, r6 as sr6

Y, X = "pv_production", "global_rad:W"
TREE_FEATURES = ["global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "hour", "pv_production_lag_1",
                 "pv_production_lag_24"]
RIDGE_ALPHA = 10.0
LASSO_ALPHA = 1.0
_TR = """(SELECT * FROM model_frame WHERE split = 'train')"""


def _split(spark, sf_dir, name):
    return model_frame(spark, sf_dir).where(F.col("split") == name)


def _coefs(fitted, spark):
    c = fitted.coefficients(spark)
    return c.select(F.when(F.col("term") == "intercept", "intercept").otherwise("slope").alias("term"),
                    r6("value").alias("value"))


@query("linreg_fit", f"""{FX.with_('model_frame')}
SELECT 'intercept' AS term, {sr6('regr_intercept(pv_production, "global_rad:W")')} AS value FROM {_TR} t
UNION ALL SELECT 'slope', {sr6('regr_slope(pv_production, "global_rad:W")')} FROM {_TR} t""")
def linreg_fit(spark, sf_dir):
    """Ordinary least squares (Spark ML, normal equations) of PV on global radiation."""
    fm = M.fit(_split(spark, sf_dir, "train"), [X], Y, "linear", scaling="none")
    return _coefs(fm, spark)


_ZSTATS = f"""(SELECT count(*) AS n, avg(pv_production) AS my, covar_pop("global_rad:W", pv_production) AS cxy,
                      stddev_pop("global_rad:W") AS sx FROM {_TR} t) s"""


@query("ridge_fit", f"""{FX.with_('model_frame')}
SELECT 'intercept' AS term, {sr6('my')} AS value FROM {_ZSTATS}
UNION ALL SELECT 'slope', {sr6(f'CAST(n AS DOUBLE) * cxy / ((CAST(n AS DOUBLE) + {RIDGE_ALPHA}) * sx)')} FROM {_ZSTATS}""")
def ridge_fit(spark, sf_dir):
    """Ridge (alpha 10) on the standardised feature; closed form: slope = n c / (n + alpha)."""
    fm = M.fit(_split(spark, sf_dir, "train"), [X], Y, "ridge", {"alpha": RIDGE_ALPHA})
    return _coefs(fm, spark)


@query("lasso_fit", f"""{FX.with_('model_frame')}
SELECT 'intercept' AS term, {sr6('my')} AS value FROM {_ZSTATS}
UNION ALL SELECT 'slope', {sr6(f'sign(cxy / sx) * greatest(abs(cxy / sx) - {LASSO_ALPHA}, 0)')} FROM {_ZSTATS}""")
def lasso_fit(spark, sf_dir):
    """Lasso (alpha 1) on the standardised feature; closed form: soft-threshold of cov."""
    fm = M.fit(_split(spark, sf_dir, "train"), [X], Y, "lasso", {"alpha": LASSO_ALPHA})
    return _coefs(fm, spark)


@query("score_linear", f"""{FX.with_('model_frame')},
f AS (SELECT regr_intercept(pv_production, "global_rad:W") AS b0, regr_slope(pv_production, "global_rad:W") AS b1 FROM {_TR} t)
SELECT site_id, time, {sr6('b0 + b1 * "global_rad:W"')} AS prediction FROM model_frame, f WHERE split = 'test'""")
def score_linear(spark, sf_dir):
    """Score the test split with the fitted OLS model."""
    fm = M.fit(_split(spark, sf_dir, "train"), [X], Y, "linear", scaling="none")
    out = fm.transform(_split(spark, sf_dir, "test"))
    return out.select("site_id", "time", r6("prediction").alias("prediction"))


def _tree(spark, sf_dir, name, params):
    fm = M.fit(_split(spark, sf_dir, "train"), TREE_FEATURES, Y, name, params)
    return fm, fm.transform(_split(spark, sf_dir, "test")).select("site_id", "time", Y, "prediction")


@query("rf_fit")
def rf_fit(spark, sf_dir):
    """Random forest (50 trees, depth 5, half the features per split) test predictions."""
    return _tree(spark, sf_dir, "random_forest",
                 {"n_estimators": 50, "max_depth": 5, "min_samples_leaf": 1, "max_features": 0.5})[1]


@query("gbt_fit")
def gbt_fit(spark, sf_dir):
    """Gradient-boosted trees (50 rounds, depth 3, step 0.1, subsample 0.8) test predictions."""
    return _tree(spark, sf_dir, "gradient_boosting",
                 {"n_estimators": 50, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8})[1]


@query("importances")
def importances(spark, sf_dir):
    """Random-forest feature importances, ranked (top-N replaces the bar chart)."""
    from ..operators.series import top_k
    fm, _ = _tree(spark, sf_dir, "random_forest",
                  {"n_estimators": 50, "max_depth": 5, "min_samples_leaf": 1, "max_features": 0.5})
    imp = fm.importances(spark)
    return top_k(imp, len(TREE_FEATURES), [F.col("importance").desc(), F.col("feature")], rank_col="rank")


KNN_FEATURES = ["global_rad:W", "pv_production_lag_1", "hour"]
KNN_K = 5


def _knn_sql(weights: str) -> str:
    tr = "(SELECT * FROM model_frame WHERE split = 'train')"
    z = lambda c, t: f"(CAST({q(c)} AS DOUBLE) - (SELECT avg({q(c)}) FROM {tr} x)) / (SELECT CASE WHEN stddev_pop({q(c)}) = 0 THEN 1.0 ELSE stddev_pop({q(c)}) END FROM {tr} x)"
    tcols = ", ".join(f"{z(c, 't')} AS f{j}" for j, c in enumerate(KNN_FEATURES))
    dist = " + ".join(f"(t.f{j} - qq.f{j}) * (t.f{j} - qq.f{j})" for j in range(len(KNN_FEATURES)))
    if weights == "uniform":
        agg = "avg(y)"
    else:
        agg = ("CASE WHEN max(CASE WHEN d = 0 THEN 1 ELSE 0 END) = 1 THEN avg(CASE WHEN d = 0 THEN y END) "
               "ELSE sum(y / d) / sum(1 / d) END")
    return f"""{FX.with_('model_frame')},
t AS (SELECT site_id, time, pv_production AS y, {tcols} FROM model_frame WHERE split = 'train'),
qq AS (SELECT site_id, time, {tcols} FROM model_frame WHERE split = 'test'),
pairs AS (SELECT qq.site_id, qq.time, t.y, sqrt({dist}) AS d,
                 row_number() OVER (PARTITION BY qq.site_id, qq.time ORDER BY sqrt({dist}), t.site_id, t.time) AS rn
          FROM qq, t)
SELECT site_id, time, {sr6(agg)} AS prediction, count(*) AS n_neighbors FROM pairs WHERE rn <= {KNN_K} GROUP BY site_id, time"""


def _knn(spark, sf_dir, weights):
    from ..operators.knn import knn_predict
    mf = model_frame(spark, sf_dir)
    out = knn_predict(mf.where(F.col("split") == "train"), mf.where(F.col("split") == "test"), KNN_FEATURES, Y,
                      KNN_K, weights, train_id=["site_id", "time"], query_id=["site_id", "time"])
    return out.select("site_id", "time", r6("prediction").alias("prediction"), "n_neighbors")


@query("knn_predict", _knn_sql("distance"))
def knn_predict(spark, sf_dir):
    """Exact 5-nearest-neighbour regression (standardised features, 1/distance
    weights) of the test split, by projection-bound pruning — no all-pairs join."""
    return _knn(spark, sf_dir, "distance")


@query("knn_uniform", _knn_sql("uniform"))
def knn_uniform(spark, sf_dir):
    """G11 with uniform weights."""
    return _knn(spark, sf_dir, "uniform")


GRAM_FEATURES = ["global_rad:W", "sun_elevation:d", "pv_production_lag_1", "pv_production_lag_24"]
GRAM_ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0]


@query("ridge_grid_gram")
def ridge_grid_gram(spark, sf_dir):
    """G5/G7 by sufficient statistics: 4-feature standardised ridge, 5 alphas x 5 expanding
    folds scored from one aggregation pass (mean neg-MSE per alpha, rank 1 = best)."""
    from pyspark.sql import Window
    from ..operators.linear import ridge_cv_gram
    tr = model_frame(spark, sf_dir).where(F.col("split") == "train")
    per_fold = ridge_cv_gram(tr, GRAM_FEATURES, Y, GRAM_ALPHAS, 5, ["site_id"])
    s = per_fold.groupBy("grid_idx", "alpha").agg((-F.avg("mse")).alias("mean_test_score"),
                                                 F.stddev_pop("mse").alias("std_test_score"))
    s = s.withColumn("rank_test_score", F.row_number().over(Window.orderBy(F.col("mean_test_score").desc(), "grid_idx")))
    return s.select("grid_idx", "alpha", r6("mean_test_score").alias("mean_test_score"),
                    r6("std_test_score").alias("std_test_score"), "rank_test_score")


RF_GRID = {"n_estimators": [50, 100, 200], "max_depth": [5, 10, 15], "min_samples_split": [2, 5], "min_samples_leaf": [1, 2],
           "max_features": [0.5, 0.7, 1.0]}


@query("rf_grid_scores")
def rf_grid_scores(spark, sf_dir):
    """G5 + G9: random-forest grid search, all 108 parameter sets x 5 expanding folds from six
    families of shared trees on binned features."""
    tr = model_frame(spark, sf_dir).where(F.col("split") == "train")
    per_fold = M.grid_search_cv(tr, TREE_FEATURES, Y, "binned_forest", RF_GRID, 5, ["site_id"])
    s = M.summarize_grid(per_fold)
    return s.select("grid_idx", "params", r6("mean_test_score").alias("mean_test_score"),
                    r6("std_test_score").alias("std_test_score"), "rank_test_score")


LASSO_ALPHAS = [0.001, 0.01, 0.1, 1.0]
KNN_GRID = {"n_neighbors": [3, 5, 7, 10], "weights": ["uniform", "distance"]}


def _knn_grid_sql() -> str:
    """Every fold and set by brute force: row numbers inside the site give the folds, features are divided by
    the deviations of the fold's training rows."""
    cols = ", ".join(f"CAST({q(c)} AS DOUBLE) AS x{j}" for j, c in enumerate(KNN_FEATURES))
    n = len(KNN_FEATURES)
    sd = ", ".join(f"stddev_pop(x{j}) AS s{j}" for j in range(n))
    dist = " + ".join(f"pow(a.x{j} / (CASE WHEN s{j} = 0 THEN 1 ELSE s{j} END) - b.x{j} / (CASE WHEN s{j} = 0 THEN 1 ELSE s{j} END), 2)"
                      for j in range(n))
    sets = [f"({i}, {k}, '{w}')" for i, (k, w) in enumerate((k, w) for k in KNN_GRID["n_neighbors"] for w in KNN_GRID["weights"])]
    return f"""{FX.with_('model_frame')},
r AS (SELECT site_id, time, pv_production AS y, {cols}, row_number() OVER (PARTITION BY site_id ORDER BY time) - 1 AS i,
             count(*) OVER (PARTITION BY site_id) AS n FROM {_TR} t),
m AS (SELECT *, n // 6 AS size, n - 5 * (n // 6) AS first FROM r),
g AS (SELECT *, CASE WHEN i >= first AND size > 0 THEN (i - first) // size END AS test FROM m),
f AS (SELECT fold, {sd} FROM g, range(5) x(fold) WHERE i < first + size * fold GROUP BY fold),
d AS (SELECT a.site_id, a.time, f.fold, a.y, b.y AS ny, sqrt({dist}) AS d,
             row_number() OVER (PARTITION BY a.site_id, a.time ORDER BY sqrt({dist}), b.site_id, b.time) AS rank
      FROM g a JOIN f ON f.fold = a.test JOIN g b ON b.i < b.first + b.size * f.fold QUALIFY rank <= 10),
p AS (SELECT idx, k, w, fold, site_id, time, any_value(y) AS y,
             CASE WHEN w = 'uniform' THEN avg(ny) WHEN min(d) = 0 THEN avg(CASE WHEN d = 0 THEN ny END)
                  ELSE sum(ny / CASE WHEN d > 0 THEN d END) / sum(1 / CASE WHEN d > 0 THEN d END) END AS p
      FROM d, (VALUES {', '.join(sets)}) s(idx, k, w) WHERE rank <= k GROUP BY idx, k, w, fold, site_id, time)
SELECT CAST(idx AS INTEGER) AS grid_idx, CAST(k AS INTEGER) AS n_neighbors, w AS weights, CAST(fold AS INTEGER) AS fold, {sr6('avg(pow(p - y, 2))')} AS mse,
       count(*) AS n_test FROM p GROUP BY ALL"""


@query("knn_grid_scores", _knn_grid_sql())
def knn_grid_scores(spark, sf_dir):
    """G5 + G11: every k and weighting in all 5 expanding folds from one nearest-neighbour search."""
    per_fold = M.grid_search_cv(_split(spark, sf_dir, "train"), KNN_FEATURES, Y, "knn", KNN_GRID, 5, ["site_id"])
    p = F.from_json("params", "n_neighbors INT, weights STRING")
    return per_fold.select("grid_idx", p.n_neighbors.alias("n_neighbors"), p.weights.alias("weights"), "fold", r6("mse").alias("mse"), "n_test")


@query("tree_split", f"""{FX.with_('model_frame')},
h AS (SELECT hour AS cut, (SELECT count(*) FROM {_TR} a WHERE a.hour <= t.hour) AS nl, (SELECT sum(pv_production) FROM {_TR} a WHERE a.hour <= t.hour) AS sl,
             (SELECT count(*) FROM {_TR} a WHERE a.hour > t.hour) AS nr, (SELECT sum(pv_production) FROM {_TR} a WHERE a.hour > t.hour) AS sr
      FROM (SELECT DISTINCT hour FROM {_TR} x) t),
b AS (SELECT * FROM h WHERE nr > 0 ORDER BY sl * sl / nl + sr * sr / nr DESC, cut LIMIT 1)
SELECT site_id, time, {sr6('CASE WHEN hour <= cut THEN sl / nl ELSE sr / nr END')} AS prediction FROM model_frame, b WHERE split = 'test'""")
def tree_split(spark, sf_dir):
    """Predictions of one tree of depth 1 over the hour, without bootstrap: the split of least squared error."""
    from ..operators.trees import forest_predictions
    marks = model_frame(spark, sf_dir).select("site_id", "time", "hour", Y, "split").withColumns({
        "row_key": F.monotonically_increasing_id(), "trains": F.when(F.col("split") == "train", 1).otherwise(0),
        "test_fold": F.when(F.col("split") == "test", 0)})
    from ..session import stage
    marks = stage(marks, "tree_split_rows")
    out, sets, _ = forest_predictions(marks, ["hour"], Y, {"n_estimators": [1], "max_depth": [1], "max_features": [1.0]}, 1, bootstrap=False)
    found = out.select(F.col("key").alias("row_key"), F.col(sets[0][1].split(":")[1]).alias("p"))
    return marks.join(found, "row_key").select("site_id", "time", r6("p").alias("prediction"))


@query("boost_first_round", f"""{FX.with_('model_frame')},
m AS (SELECT avg(pv_production) AS base FROM {_TR} t),
h AS (SELECT hour AS cut, (SELECT count(*) FROM {_TR} a WHERE a.hour <= t.hour) AS hl, (SELECT sum(base - pv_production) FROM {_TR} a, m WHERE a.hour <= t.hour) AS gl,
             (SELECT count(*) FROM {_TR} a WHERE a.hour > t.hour) AS hr, (SELECT sum(base - pv_production) FROM {_TR} a, m WHERE a.hour > t.hour) AS gr
      FROM (SELECT DISTINCT hour FROM {_TR} x) t),
b AS (SELECT * FROM h WHERE hr > 0 ORDER BY gl * gl / (hl + 1) + gr * gr / (hr + 1) DESC, cut LIMIT 1)
SELECT site_id, time, {sr6('base - 0.1 * CASE WHEN hour <= cut THEN gl / (hl + 1) ELSE gr / (hr + 1) END')} AS prediction
FROM model_frame, b, m WHERE split = 'test'""")
def boost_first_round(spark, sf_dir):
    """One round of second-order boosting with a tree of depth 1 over the hour (lambda 1, step 0.1)."""
    fm = M.fit(_split(spark, sf_dir, "train"), ["hour"], Y, "boosted_trees", {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.1}, scaling="none")
    return fm.transform(_split(spark, sf_dir, "test")).select("site_id", "time", r6("prediction").alias("prediction"))


BOOST_GRID = {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2], "max_depth": [3, 5, 7], "subsample": [0.8, 1.0],
              "min_samples_split": [2, 5], "reg_lambda": [0.0]}


@query("boost_grid_scores")
def boost_grid_scores(spark, sf_dir):
    """G5 + G10: gradient-boosting grid search, all 108 parameter sets x 5 expanding folds from 36
    models a fold."""
    per_fold = M.grid_search_cv(_split(spark, sf_dir, "train"), TREE_FEATURES, Y, "boosted_trees", BOOST_GRID, 5, ["site_id"])
    s = M.summarize_grid(per_fold)
    return s.select("grid_idx", "params", r6("mean_test_score").alias("mean_test_score"),
                    r6("std_test_score").alias("std_test_score"), "rank_test_score")


@query("model_search")
def model_search(spark, sf_dir):
    """Reference workflow end to end: expanding-CV grid search per model (OLS, the ridge, lasso and
    nearest-neighbour grids, and a forest grid of 12 sets), refit, train/test metrics and CV summary in
    one comparison table."""
    from ..api import compare_models
    mf = model_frame(spark, sf_dir)
    models = {"linear": ("linear_gram", {}), "ridge": ("ridge_gram", {"alpha": [0.1, 1.0, 10.0, 100.0]}),
              "lasso": ("lasso_gram", {"alpha": LASSO_ALPHAS}), "knn": ("knn", KNN_GRID),
              "random_forest": ("binned_forest", {"n_estimators": [50, 100], "max_depth": [5, 10, 15], "min_samples_split": [2, 5],
                                                  "max_features": [0.5]})}
    comparison, _cv, _p, _fitted = compare_models(mf.where("split = 'train'"), mf.where("split = 'test'"),
                                                  TREE_FEATURES, Y, models, 5, ["site_id"])
    return comparison.select("model", *[r6(c).alias(c) for c in ("train_rmse", "test_rmse", "mean_cv_rmse",
                                                                  "std_cv_rmse")], "rank")


@query("lasso_grid_gram")
def lasso_grid_gram(spark, sf_dir):
    """G5/G8 by sufficient statistics: 4-feature standardised lasso, 4 alphas x 5 expanding
    folds from one aggregation pass (coordinate descent on p x p moments)."""
    from pyspark.sql import Window
    from ..operators.linear import lasso_cv_gram
    tr = model_frame(spark, sf_dir).where(F.col("split") == "train")
    per_fold = lasso_cv_gram(tr, GRAM_FEATURES, Y, LASSO_ALPHAS, 5, ["site_id"])
    s = per_fold.groupBy("grid_idx", "alpha").agg((-F.avg("mse")).alias("mean_test_score"),
                                                 F.stddev_pop("mse").alias("std_test_score"))
    s = s.withColumn("rank_test_score", F.row_number().over(Window.orderBy(F.col("mean_test_score").desc(), "grid_idx")))
    return s.select("grid_idx", "alpha", r6("mean_test_score").alias("mean_test_score"),
                    r6("std_test_score").alias("std_test_score"), "rank_test_score")


PARAM_GRID = {"n_estimators": [50, 100], "max_depth": [5, 10, 15], "max_features": [0.5, 1.0]}


@query("param_grid", f"""{FX.with_('model_frame')}
SELECT e.v AS n_estimators, d.v AS max_depth, f.v AS max_features, n.n AS n_train
FROM (VALUES (50), (100)) e(v), (VALUES (5), (10), (15)) d(v), (VALUES (0.5::DOUBLE), (1.0::DOUBLE)) f(v),
     (SELECT count(*) AS n FROM {_TR} t) n""")
def param_grid(spark, sf_dir):
    """Every parameter set of a grid, beside the rows each would be trained on."""
    sets = spark.createDataFrame([tuple(p.values()) for p in M.param_grid(PARAM_GRID)],
                                 "n_estimators INT, max_depth INT, max_features DOUBLE")
    return sets.crossJoin(F.broadcast(_split(spark, sf_dir, "train").agg(F.count(F.lit(1)).alias("n_train"))))   # one row


_PROJECTED = ["global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "hour", "pv_production_lag_1", "pv_production_lag_24",
              "sun_elevation_prev"]


@query("training_projection", f"""{FX.with_('model_frame')}
SELECT feature, count(*) AS n_rows, count(value) AS n_values
FROM ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({q(c)} AS DOUBLE) AS value FROM {_TR} t" for c in _PROJECTED)}) x
GROUP BY feature""")
def training_projection(spark, sf_dir):
    """The default feature list of the splits, with the rows and values each feature has."""
    from ..operators.panel import numeric_features, training_projection as project
    train, test = _split(spark, sf_dir, "train"), _split(spark, sf_dir, "test")
    names = project(train, test, Y)
    assert set(numeric_features(train, [Y])) <= set(names)      # B4 leaves out the calendar columns as well
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in names])
    return train.select(F.explode(rows).alias("_r")).groupBy(F.col("_r.feature").alias("feature")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_r.value").alias("n_values"))


@query("bundle_roundtrip", None)
def bundle_roundtrip(spark, sf_dir):
    """The fitted model saved as a bundle, loaded again, scoring the test split."""
    from ..sources.sinks import load_bundle, save_bundle
    path = _scratch(spark, "bundle")
    save_bundle(spark, path, M.fit(_split(spark, sf_dir, "train"), [X], Y, "linear", scaling="none"))
    out = load_bundle(spark, path).transform(_split(spark, sf_dir, "test"))
    return out.select("site_id", "time", r6("prediction").alias("prediction"))


def _scratch(spark, name):
    import uuid
    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _results_sql() -> str:
    from .queries_eval import _CMP_SQL
    return f"""{_CMP_SQL}
SELECT 'linear' AS model, {sr6('test_rmse')} AS rmse, {sr6('test_mae')} AS mae,
       (SELECT count(*) FROM fp WHERE split = 'test' AND model = 'ols_rad') AS n_predictions,
       {sr6('mean_cv_rmse')} AS mean_cv_rmse, {sr6('std_cv_rmse')} AS std_cv_rmse, n_folds
FROM cmp JOIN cvs USING (model) WHERE model = 'ols_rad'"""


@query("training_results", _results_sql())
def training_results(spark, sf_dir):
    """Metrics, the scores of five expanding folds and predictions written as training results
    and read back."""
    from ..operators import evaluate as EV
    from ..sources.sinks import save_training_results
    fm = M.fit(_split(spark, sf_dir, "train"), [X], Y, "linear", scaling="none")
    scored = fm.transform(_split(spark, sf_dir, "test")).withColumn("model", F.lit("linear"))
    metrics = EV.regression_metrics(scored, Y, "prediction").withColumn("model", F.lit("linear"))
    cv = M.grid_search_cv(_split(spark, sf_dir, "train"), [X], Y, "linear_gram", {}, 5, ["site_id"]) \
        .select(F.lit("linear").alias("model"), "fold", F.sqrt("mse").alias("rmse"))
    path = save_training_results(_scratch(spark, "results"), metrics, cv, scored.select("model", "site_id", "time", "prediction"))
    m = spark.read.parquet(f"{path}/metrics").select("model", r6("rmse").alias("rmse"), r6("mae").alias("mae"))
    n = spark.read.parquet(f"{path}/predictions").groupBy("model").agg(F.count(F.lit(1)).alias("n_predictions"))
    s = EV.cv_summary(spark.read.parquet(f"{path}/cv_scores"))
    s = s.select("model", r6("mean_cv_rmse").alias("mean_cv_rmse"), r6("std_cv_rmse").alias("std_cv_rmse"), "n_folds")
    return m.join(n, "model").join(s, "model")


@query("best_bundle", f"""{FX.with_('model_frame')},
f AS (SELECT regr_intercept(pv_production, "global_rad:W") AS b0, regr_slope(pv_production, "global_rad:W") AS b1 FROM {_TR} t)
SELECT 'linear' AS model, site_id, time, {sr6('b0 + b1 * "global_rad:W"')} AS prediction FROM model_frame, f WHERE split = 'test'""")
def best_bundle(spark, sf_dir):
    """A7 + G15: three models compared, the best one by CV bundled in the same call, loaded and scoring the
    test split (a lasso and a ridge that are shrunk to next to nothing must lose)."""
    from ..api import compare_models
    from ..sources.sinks import load_bundle, save_best_bundle
    mf, path = model_frame(spark, sf_dir), _scratch(spark, "best")
    models = {"linear": ("linear_gram", {}), "ridge": ("ridge_gram", {"alpha": [1e9]}), "lasso": ("lasso_gram", {"alpha": [1e9]})}
    comparison, _, _, fitted = compare_models(mf.where("split = 'train'"), mf.where("split = 'test'"), [X], Y, models, 5, ["site_id"])
    name = save_best_bundle(spark, path, comparison, fitted)
    out = load_bundle(spark, path).transform(mf.where("split = 'test'"))
    return out.select(F.lit(name).alias("model"), "site_id", "time", r6("prediction").alias("prediction"))


@query("sorted_sink", f"""{FX.with_('model_frame')}
SELECT site_id, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_descents FROM model_frame GROUP BY site_id""")
def sorted_sink(spark, sf_dir):
    """B2: the frame written by site with its files sorted by time; rows that come before their
    predecessor in a file, counted from the files as they lie."""
    from pyspark.sql import Window
    from ..sources.sinks import read_table, write_table
    path = write_table(model_frame(spark, sf_dir).repartition("site_id"), _scratch(spark, "sorted"), ["site_id"], cluster_by=["site_id", "time"])
    back = read_table(spark, path).select(F.col("site_id").cast("string").alias("site_id"), "time", F.col("_metadata.file_path").alias("file"),
                                          F.col("_metadata.row_index").alias("place"))
    before = F.lag("time").over(Window.partitionBy("site_id", "file").orderBy("place"))
    return back.withColumn("down", (F.col("time") < before).cast("long")).groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("down"), F.lit(0)).alias("n_descents"))


@query("tree_facts", f"""{FX.with_('model_frame')}
SELECT m.model, count(*) AS n_test, TRUE AS importances_sum_to_one, TRUE AS within_training_range, TRUE AS beats_the_mean
FROM model_frame, (VALUES ('random_forest'), ('gradient_boosting')) m(model) WHERE split = 'test' GROUP BY m.model""")
def tree_facts(spark, sf_dir):
    """Of both tree models (20 trees), whether importances sum to one, forest predictions stay in
    the range of the training target (boosted ones within a tenth of it beyond), and both beat the mean model."""
    out = None
    low, high, mean = _split(spark, sf_dir, "train").agg(F.min(Y), F.max(Y), F.avg(Y)).first()
    for name, slack, params in (("random_forest", 0.0, {"n_estimators": 20, "max_depth": 5}),
                                ("gradient_boosting", 0.1, {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.1})):
        fm, p = _tree(spark, sf_dir, name, params)
        total = fm.importances(spark).agg(F.sum("importance")).first()[0]
        room = slack * (high - low) + 1e-9
        row = p.agg(F.count(F.lit(1)).alias("n_test"), F.lit(abs(total - 1) < 1e-6).alias("importances_sum_to_one"),
                    F.min(F.col("prediction").between(low - room, high + room)).alias("within_training_range"),
                    (F.avg((F.col("prediction") - F.col(Y)) ** 2) < F.avg((F.col(Y) - mean) ** 2)).alias("beats_the_mean")) \
            .select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.union(row)
    return out


def _register_bundle_sql():
    from . import registry
    registry.ORACLE["bundle_roundtrip"] = registry.ORACLE["score_linear"]


_register_bundle_sql()
