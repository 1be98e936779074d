"""Registered queries: metrics, CV, grid search, significance, benchmark, error analysis
(D11-D16, F8-F10, G3-G5, G12, G15, G16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import segments as SG
from ..functions.numeric import r6
from ..operators import cv as CV, evaluate as EV
from ..operators.splits import kfold as kfold_op, ts_folds as ts_folds_op
from . import fixture_sql as FX
from .fixtures import model_frame
from .registry import query
from .sqlparts import metrics_sql, r6 as sr6

Y, X, L1, L24 = "pv_production", "global_rad:W", "pv_production_lag_1", "pv_production_lag_24"
N_SPLITS = 5
ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0]

# --------------------------------------------------------------------- SQL twins ------
_MF = FX.with_("model_frame")
_FOLDS = f"""
ix AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY time) - 1 AS row_idx,
              count(*) OVER (PARTITION BY site_id) AS _n FROM model_frame WHERE split = 'train'),
fx AS (SELECT *, _n // {N_SPLITS + 1} AS _sz, _n - (_n // {N_SPLITS + 1}) * {N_SPLITS} AS _first FROM ix),
pairs AS (SELECT f.fold, fx.*, CASE WHEN row_idx < _first + _sz * f.fold THEN 'train' ELSE 'test' END AS role
          FROM fx JOIN (SELECT range AS fold FROM range({N_SPLITS})) f
            ON fx.row_idx < fx._first + fx._sz * f.fold
            OR (fx._sz > 0 AND fx.row_idx >= fx._first + fx._sz * f.fold AND fx.row_idx < fx._first + fx._sz * (f.fold + 1))),
fits AS (SELECT fold, count(pv_production) AS n_fit, avg(pv_production) AS my, avg("global_rad:W") AS mx,
                covar_pop("global_rad:W", pv_production) AS cxy, var_pop("global_rad:W") AS vx
         FROM pairs WHERE role = 'train' GROUP BY fold)"""

_PRED_COLS = """pv_production_lag_1 AS naive_lag1, pv_production_lag_24 AS naive_lag24, my AS train_mean,
                my + cxy / vx * ("global_rad:W" - mx) AS ols_rad"""

_CV = f"""{_MF}, {_FOLDS},
pr AS (SELECT fold, pv_production AS y, {_PRED_COLS} FROM pairs JOIN fits USING (fold) WHERE role = 'test'),
lg AS (SELECT * FROM pr UNPIVOT (pred FOR model IN (naive_lag1, naive_lag24, train_mean, ols_rad))),
cv AS (SELECT model, fold, sqrt(avg((pred - y) * (pred - y))) AS rmse FROM lg GROUP BY model, fold),
cvs AS (SELECT model, avg(rmse) AS mean_cv_rmse, stddev_pop(rmse) AS std_cv_rmse, count(rmse) AS n_folds,
               row_number() OVER (ORDER BY avg(rmse), model) AS rank FROM cv GROUP BY model)"""

_FULL = f"""{_CV},
ff AS (SELECT count(pv_production) AS n_fit, avg(pv_production) AS my, avg("global_rad:W") AS mx,
              covar_pop("global_rad:W", pv_production) AS cxy, var_pop("global_rad:W") AS vx
       FROM model_frame WHERE split = 'train'),
fp AS (SELECT * FROM (SELECT m.*, {_PRED_COLS} FROM model_frame m, ff)
       UNPIVOT (pred FOR model IN (naive_lag1, naive_lag24, train_mean, ols_rad)))"""


def _tt_sql():
    from ..functions.stats import t_cdf_df4_sql
    return f"""{_CV},
d AS (SELECT a.model AS model_a, b.model AS model_b, a.rmse - b.rmse AS _d FROM cv a JOIN cv b USING (fold) WHERE a.model <> b.model),
g AS (SELECT model_a, model_b, avg(_d) AS mean_diff, stddev_samp(_d) AS _sd, count(_d) AS n FROM d GROUP BY 1, 2),
tt AS (SELECT model_a, model_b, mean_diff, n, CASE WHEN _sd > 0 THEN mean_diff / (_sd / sqrt(CAST(n AS DOUBLE))) END AS t_stat FROM g),
ptt AS (SELECT *, {t_cdf_df4_sql('t_stat')} AS p_value FROM tt)"""


# --------------------------------------------------------------------- Spark side -----
def _cv(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    return CV.cv_scores(mf.where(F.col("split") == "train"), Y, X, L1, L24, N_SPLITS, ["site_id"])


def _full_predictions(spark, sf_dir):
    mf = model_frame(spark, sf_dir)
    fits = CV.fit_stats(mf.where(F.col("split") == "train"), Y, X)
    keep = ["site_id", "time", "split", X, "clear_sky_rad:W", "sun_elevation:d", "sun_elevation_prev", "hour"]
    return CV.predictions(mf, fits, Y, X, L1, L24, keep=keep)


@query("ts_folds", f"""{_MF}, {_FOLDS}
SELECT site_id, time, row_idx, CASE WHEN row_idx >= _first AND _sz > 0 THEN CAST((row_idx - _first) // _sz AS INTEGER) ELSE -1 END AS test_fold
FROM fx""")
def ts_folds(spark, sf_dir):
    """Expanding-window fold of each training row (per site); -1 = only ever trained on."""
    mf = model_frame(spark, sf_dir).where(F.col("split") == "train").select("site_id", "time")
    f = ts_folds_op(mf, N_SPLITS, ["site_id"])
    return f.select("site_id", "time", "row_idx", F.coalesce("test_fold", F.lit(-1)).alias("test_fold"))


@query("kfold", f"""{_MF},
n AS (SELECT site_id, count(*) AS _n FROM model_frame WHERE split = 'train' GROUP BY site_id)
SELECT site_id, CAST(f.fold AS INTEGER) AS fold,
       CAST(_n // {N_SPLITS} + CASE WHEN f.fold < _n % {N_SPLITS} THEN 1 ELSE 0 END AS BIGINT) AS n_rows
FROM n JOIN (SELECT range AS fold FROM range({N_SPLITS})) f ON TRUE""")
def kfold(spark, sf_dir):
    """Seeded shuffled k-fold per site; checked through the fold sizes (KFold sizes)."""
    mf = model_frame(spark, sf_dir).where(F.col("split") == "train").select("site_id", "time")
    k = kfold_op(mf, N_SPLITS, 42, ["site_id"], ["site_id", "time"])
    return k.groupBy("site_id", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


@query("cv_summary", f"""{_CV}
SELECT model, {sr6('mean_cv_rmse')} AS mean_cv_rmse, {sr6('std_cv_rmse')} AS std_cv_rmse, n_folds, CAST(rank AS INTEGER) AS rank FROM cvs""")
def cv_summary(spark, sf_dir):
    """Mean and population std of the fold RMSEs, ranked."""
    s = EV.cv_summary(_cv(spark, sf_dir))
    return s.select("model", r6("mean_cv_rmse").alias("mean_cv_rmse"), r6("std_cv_rmse").alias("std_cv_rmse"),
                    "n_folds", F.col("rank").cast("int").alias("rank"))


@query("grid_scores", f"""{_MF}, {_FOLDS},
g AS (SELECT * FROM (VALUES {', '.join(f'({i}, {a}::DOUBLE)' for i, a in enumerate(ALPHAS))}) t(grid_idx, alpha)),
pf AS (SELECT grid_idx, alpha, fold,
              -avg(pow(my + CAST(n_fit AS DOUBLE) * cxy / ((CAST(n_fit AS DOUBLE) + alpha) * vx) * ("global_rad:W" - mx) - pv_production, 2)) AS score
       FROM pairs JOIN fits USING (fold) JOIN g ON TRUE WHERE role = 'test' GROUP BY ALL),
s AS (SELECT grid_idx, alpha, avg(score) AS mean_test_score, stddev_pop(score) AS std_test_score FROM pf GROUP BY 1, 2)
SELECT CAST(grid_idx AS INTEGER) AS grid_idx, alpha, {sr6('mean_test_score')} AS mean_test_score, {sr6('std_test_score')} AS std_test_score,
       CAST(row_number() OVER (ORDER BY mean_test_score DESC, grid_idx) AS INTEGER) AS rank_test_score FROM s""")
def grid_scores(spark, sf_dir):
    """Grid search of one-feature ridge (standardised) over alpha, mean neg-MSE over
    expanding folds, all grid points and folds from one aggregation."""
    mf = model_frame(spark, sf_dir).where(F.col("split") == "train")
    g = CV.ridge_grid_scores(mf, Y, X, ALPHAS, N_SPLITS, ["site_id"])
    return g.select(F.col("grid_idx").cast("int").alias("grid_idx"), "alpha",
                    r6("mean_test_score").alias("mean_test_score"), r6("std_test_score").alias("std_test_score"),
                    F.col("rank_test_score").cast("int").alias("rank_test_score"))


@query("paired_ttest", f"""{_tt_sql()}
SELECT model_a, model_b, {sr6('mean_diff')} AS mean_diff, {sr6('t_stat')} AS t_stat, {sr6('p_value')} AS p_value, n FROM ptt""")
def paired_ttest(spark, sf_dir):
    """One-sided paired t-test of fold RMSEs for every ordered model pair."""
    t = EV.paired_ttest(_cv(spark, sf_dir))
    return t.select("model_a", "model_b", *[r6(c).alias(c) for c in ("mean_diff", "t_stat", "p_value")], "n")


@query("metrics", f"""{_FULL}
{metrics_sql('fp', 'pv_production', 'pred', ['model', 'split'])}""")
def metrics(spark, sf_dir):
    """Rmse, mae, r2, mape per model and split (fit on the training split)."""
    m = EV.regression_metrics(_full_predictions(spark, sf_dir), "y", "pred", ["model", "split"])
    return m.select("model", "split", "n", *[r6(c).alias(c) for c in ("rmse", "mae", "r2", "mape")])


@query("naive_baselines", f"""{_FULL}
{metrics_sql("(SELECT * FROM fp WHERE split = 'test' AND model LIKE 'naive%')", 'pv_production', 'pred', ['site_id', 'model'])}""")
def naive_baselines(spark, sf_dir):
    """Persistence (lag 1) and day-ahead persistence (lag 24) on the test split, per site."""
    p = _full_predictions(spark, sf_dir).where((F.col("split") == "test") & F.col("model").startswith("naive"))
    m = EV.regression_metrics(p, "y", "pred", ["site_id", "model"])
    return m.select("site_id", "model", "n", *[r6(c).alias(c) for c in ("rmse", "mae", "r2", "mape")])


_CMP_SQL = f"""{_FULL},
mt AS (SELECT model, split, sqrt(avg((pred - pv_production) * (pred - pv_production))) AS rmse,
              avg(abs(pred - pv_production)) AS mae,
              CASE WHEN var_pop(pv_production) = 0 THEN CASE WHEN avg((pred - pv_production) * (pred - pv_production)) = 0 THEN 1.0 ELSE 0.0 END
                   ELSE 1.0 - avg((pred - pv_production) * (pred - pv_production)) / var_pop(pv_production) END AS r2
       FROM fp GROUP BY model, split),
cmp AS (SELECT model,
       max(CASE WHEN split = 'train' THEN rmse END) AS train_rmse, max(CASE WHEN split = 'test' THEN rmse END) AS test_rmse,
       max(CASE WHEN split = 'train' THEN r2 END) AS train_r2, max(CASE WHEN split = 'test' THEN r2 END) AS test_r2,
       max(CASE WHEN split = 'train' THEN mae END) AS train_mae, max(CASE WHEN split = 'test' THEN mae END) AS test_mae
       FROM mt GROUP BY model)"""

_CMP_COLS = ["train_rmse", "test_rmse", "train_r2", "test_r2", "train_mae", "test_mae", "mean_cv_rmse", "std_cv_rmse"]


def _comparison(spark, sf_dir):
    m = EV.regression_metrics(_full_predictions(spark, sf_dir), "y", "pred", ["model", "split"])
    wide = m.groupBy("model").agg(*[F.max(F.when(F.col("split") == s, F.col(k))).alias(f"{s}_{k}")
                                    for s in ("train", "test") for k in ("rmse", "r2", "mae")])
    return wide.join(EV.cv_summary(_cv(spark, sf_dir)), "model")


@query("model_comparison", f"""{_CMP_SQL}
SELECT model, {', '.join(f'{sr6(c)} AS {c}' for c in _CMP_COLS)}, CAST(rank AS INTEGER) AS rank
FROM cmp JOIN cvs USING (model)""")
def model_comparison(spark, sf_dir):
    """One row per model: train/test rmse, r2, mae and CV rmse (mean, std), ranked by CV."""
    c = _comparison(spark, sf_dir)
    return c.select("model", *[r6(k).alias(k) for k in _CMP_COLS], F.col("rank").cast("int").alias("rank"))


@query("best_model", f"""{_CMP_SQL}
SELECT arg_min(model, mean_cv_rmse) AS model, {sr6('min(mean_cv_rmse)')} AS mean_cv_rmse,
       {sr6('arg_min(test_rmse, mean_cv_rmse)')} AS test_rmse FROM cmp JOIN cvs USING (model)""")
def best_model(spark, sf_dir):
    """The model with the lowest mean CV RMSE (test RMSE only reported)."""
    c = _comparison(spark, sf_dir)
    return c.agg(F.min_by("model", "mean_cv_rmse").alias("model"), r6(F.min("mean_cv_rmse")).alias("mean_cv_rmse"),
                 r6(F.min_by("test_rmse", "mean_cv_rmse")).alias("test_rmse"))


@query("benchmark", f"""{_tt_sql()},
sig AS (SELECT model_a AS model, bool_or(p_value < 0.05) AS beats_any_baseline, bool_and(coalesce(p_value < 0.05, false)) AS beats_all_baselines
        FROM ptt WHERE model_b IN ('naive_lag1', 'naive_lag24') GROUP BY model_a)
SELECT c.model, c.model IN ('naive_lag1', 'naive_lag24') AS is_baseline, {sr6('c.mean_cv_rmse')} AS mean_cv_rmse,
       coalesce(s.beats_any_baseline, false) AS beats_any_baseline, coalesce(s.beats_all_baselines, false) AS beats_all_baselines
FROM cvs c LEFT JOIN sig s USING (model)""")
def benchmark(spark, sf_dir):
    """Baselines and trained models in one table, with 'significantly beats any / all
    baselines' flags from the paired t-tests (alpha 0.05)."""
    cv = _cv(spark, sf_dir)
    tt = EV.paired_ttest(cv).where(F.col("model_b").isin(CV.BASELINES))
    sig = tt.groupBy(F.col("model_a").alias("model")).agg(
        F.bool_or(F.col("p_value") < 0.05).alias("beats_any_baseline"),
        F.bool_and(F.coalesce(F.col("p_value") < 0.05, F.lit(False))).alias("beats_all_baselines"))
    s = EV.cv_summary(cv)
    return (s.join(sig, "model", "left")
             .select("model", F.col("model").isin(CV.BASELINES).alias("is_baseline"), r6("mean_cv_rmse").alias("mean_cv_rmse"),
                     F.coalesce("beats_any_baseline", F.lit(False)).alias("beats_any_baseline"),
                     F.coalesce("beats_all_baselines", F.lit(False)).alias("beats_all_baselines")))


# --------------------------------------------------------------------- D14 ------------
_SEG_SQL = {
    "hour": "CAST(hour AS VARCHAR)",
    "weather": """CASE WHEN r IS NULL THEN 'unknown' WHEN r >= 0.8 THEN 'clear_like'
                       WHEN r >= 0.4 THEN 'partly_cloudy_like' ELSE 'cloudy_like' END""",
    "radiation": """CASE WHEN "global_rad:W" IS NULL OR "global_rad:W" < 0 THEN 'unknown'
                         WHEN "global_rad:W" < 50 THEN '[0,50)' WHEN "global_rad:W" < 200 THEN '[50,200)'
                         WHEN "global_rad:W" < 400 THEN '[200,400)' WHEN "global_rad:W" < 600 THEN '[400,600)'
                         ELSE '[600,inf)' END""",
    "phase": """CASE WHEN e IS NULL THEN 'unknown' WHEN e < 2 THEN 'night' WHEN e >= 15 THEN 'midday_high_sun'
                     WHEN e >= 2 AND e <= 10 AND e > ep THEN 'sunrise_ramp_up'
                     WHEN e >= 2 AND e <= 10 AND e < ep THEN 'sunset_ramp_down' ELSE 'daylight_other' END""",
}


def _segments():
    return {
        "hour": F.col("hour").cast("string"),
        "weather": SG.weather_state("global_rad:W", "clear_sky_rad:W"),
        "radiation": SG.radiation_bin("global_rad:W"),
        "phase": SG.ramp_phase(F.col("`sun_elevation:d`"), F.col("sun_elevation_prev")),
    }


def _error_query(seg):
    def run(spark, sf_dir):
        p = _full_predictions(spark, sf_dir).where((F.col("split") == "test") & (F.col("model") == "ols_rad"))
        b = EV.error_breakdown(p, "y", "pred", {seg: _segments()[seg]})
        return b.select(
            "segment", "n", *[r6(c).alias(c) for c in ("rmse", "mae", "bias")])
    run.__doc__ = f"D14: test errors of the one-feature OLS model by {seg} segment."
    sql = f"""{_FULL},
seg AS (SELECT {_SEG_SQL[seg]} AS segment, pred - pv_production AS _e FROM
        (SELECT *, CASE WHEN "clear_sky_rad:W" = 0 THEN NULL ELSE "global_rad:W" / "clear_sky_rad:W" END AS r,
                "sun_elevation:d" AS e, sun_elevation_prev AS ep FROM fp WHERE split = 'test' AND model = 'ols_rad') x)
SELECT segment, count(_e) AS n, {sr6('sqrt(avg(_e * _e))')} AS rmse, {sr6('avg(abs(_e))')} AS mae, {sr6('avg(_e)')} AS bias
FROM seg GROUP BY segment"""
    query(f"error_by_{seg}", sql)(run)


for _s in ("hour", "weather", "radiation", "phase"):
    _error_query(_s)


_ERRORS_SQL = " UNION ALL ".join(f"""SELECT '{s}' AS segmentation, segment, count(_e) AS n, {sr6('sqrt(avg(_e * _e))')} AS rmse,
       {sr6('avg(abs(_e))')} AS mae, {sr6('avg(_e)')} AS bias FROM (SELECT {_SEG_SQL[s]} AS segment, _e FROM x) t GROUP BY segment"""
                                 for s in _SEG_SQL)


@query("error_segments", f"""{_FULL},
x AS (SELECT *, pred - pv_production AS _e, CASE WHEN "clear_sky_rad:W" = 0 THEN NULL ELSE "global_rad:W" / "clear_sky_rad:W" END AS r,
             "sun_elevation:d" AS e, sun_elevation_prev AS ep FROM fp WHERE split = 'test' AND model = 'ols_rad')
{_ERRORS_SQL}""")
def error_segments(spark, sf_dir):
    """Test errors of the one-feature OLS model by all four segmentations, in one pass."""
    p = _full_predictions(spark, sf_dir).where((F.col("split") == "test") & (F.col("model") == "ols_rad"))
    b = EV.error_breakdown(p, "y", "pred", _segments())
    return b.select("segmentation", "segment", "n", *[r6(c).alias(c) for c in ("rmse", "mae", "bias")])


@query("comparison_csv", f"""{_CMP_SQL}{_tt_sql()[len(_CV):]}
SELECT model, {', '.join(f'{sr6(c)} AS {c}' for c in _CMP_COLS)}, {sr6('min(p_value)')} AS least_p, count(p_value) AS n_p
FROM cmp JOIN cvs USING (model) JOIN ptt ON ptt.model_a = model GROUP BY ALL""")
def comparison_csv(spark, sf_dir):
    """The comparison and its p-values written as CSV and read back."""
    from ..sources.sinks import read_comparison, write_comparison
    from .queries_io import _scratch
    cv = _cv(spark, sf_dir)
    c = _comparison(spark, sf_dir)
    path = write_comparison(_scratch(spark, "comparison"), c, EV.paired_ttest(cv), sorted([*CV.BASELINES, *CV.TRAINED]))
    back, p = read_comparison(spark, path)
    least = p.groupBy(F.col("model_a").alias("model")).agg(F.min("p_value").alias("least_p"), F.count("p_value").alias("n_p"))
    return back.join(least, "model").select("model", *[r6(k).alias(k) for k in (*_CMP_COLS, "least_p")], "n_p")


@query("weather_state", f"""{FX.with_('panel')}
SELECT site_id, time, {sr6('r')} AS clear_sky_ratio, {_SEG_SQL['weather']} AS weather_state
FROM (SELECT *, CASE WHEN "clear_sky_rad:W" = 0 THEN NULL ELSE "global_rad:W" / "clear_sky_rad:W" END AS r FROM panel) x""")
def weather_state(spark, sf_dir):
    """F8: clear-sky ratio and weather state per panel hour."""
    from .fixtures import panel
    p = panel(spark, sf_dir)
    return p.select("site_id", "time", r6(SG.clear_sky_ratio()).alias("clear_sky_ratio"),
                    SG.weather_state().alias("weather_state"))


@query("ramp_phase", f"""{FX.with_('panel')}
SELECT site_id, time, {_SEG_SQL['phase']} AS ramp_phase
FROM (SELECT *, "sun_elevation:d" AS e, lag("sun_elevation:d") OVER (PARTITION BY site_id ORDER BY time) AS ep FROM panel) x""")
def ramp_phase(spark, sf_dir):
    """sun phase from elevation and its change since the previous row of the site."""
    from .fixtures import panel
    from ..operators.series import positional
    p = panel(spark, sf_dir).select("site_id", "time", "sun_elevation:d")
    p = positional(p, lambda w: [F.lag("`sun_elevation:d`", 1).over(w).alias("_ep")], 1, ["site_id"])
    return p.select("site_id", "time", SG.ramp_phase(F.col("`sun_elevation:d`"), F.col("_ep")).alias("ramp_phase"))
