"""Batch vs stream scoring; sink round trips."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from heliopanel.operators import models as M, scoring as SC
from heliopanel.plans import fixtures as FX
from heliopanel.sources import sinks
from heliopanel.streaming.requests import request_stream, start_scoring


def _scorer(spark, sf):
    fc = SC.latest_forecast(FX.forecast(spark, sf))
    fm = M.fit(FX.model_frame(spark, sf).where("split = 'train'"), ["global_rad:W"], "pv_production", "linear",
               scaling="none")

    def score(reqs):
        j = SC.attach_weather(reqs, fc)
        w = F.create_map(F.lit("global_rad:W"), F.col("`global_rad:W`"))
        b = SC.build_features(j.select("request_id", "target_time", "latitude", "longitude", w.alias("_w")),
                              ["global_rad:W", "hour"], weather=F.col("_w")).drop("_w")
        return fm.transform(b.where("valid")).select("request_id", "prediction")
    return score


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "requests")
    reqs = FX.requests(spark, SF_SMALL)
    reqs.repartition(3).write.parquet(src)
    score = _scorer(spark, SF_SMALL)
    out = os.path.join(tmpdir_path, "scored")
    q = start_scoring(request_stream(spark, src, reqs.schema, max_files_per_trigger=1), score, out,
                      checkpoint=os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(out).drop("batch_id")
    batch = score(spark.read.parquet(src))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_selection_round_trip(spark, tmpdir_path):
    from heliopanel.plans.queries_quality import PARAMS, _fit
    from heliopanel.operators import selection as SEL
    tr, corr, sel = _fit(spark, SF_SMALL)
    rep = SEL.feature_report(tr, corr, sel, PARAMS)
    path = os.path.join(tmpdir_path, "sel")
    sinks.save_selection(spark, path, PARAMS, sel, rep)
    params, names, report = sinks.load_selection(spark, path)
    assert names == SEL.selected_names(sel) and params.exclude_patterns == PARAMS.exclude_patterns
    assert report.count() == rep.count()


def test_bundle_round_trip(spark, tmpdir_path):
    mf = FX.model_frame(spark, SF_SMALL)
    fm = M.fit(mf.where("split = 'train'"), ["global_rad:W", "hour"], "pv_production", "ridge", {"alpha": 1.0})
    path = sinks.save_bundle(spark, os.path.join(tmpdir_path, "bundle"), fm)
    back = sinks.load_bundle(spark, path)
    a = fm.transform(mf).select("site_id", "time", "prediction")
    b = back.transform(mf).select("site_id", "time", "prediction")
    assert a.exceptAll(b).count() == 0


def test_table_sink_partitioned(spark, tmpdir_path):
    p = FX.panel(spark, SF_SMALL)
    path = sinks.write_table(p, os.path.join(tmpdir_path, "panel"), ["site_id"])
    back = sinks.read_table(spark, path).where("site_id = 'click-0'")
    assert "PartitionFilters: [isnotnull(site_id" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == p.where("site_id = 'click-0'").count()
    csv = sinks.write_table(p, os.path.join(tmpdir_path, "panel_csv"), fmt="csv")
    assert sinks.read_table(spark, csv, "csv").count() == p.count()


def test_training_results_and_comparison_sinks(spark, tmpdir_path):
    from heliopanel.operators import evaluate as EV
    from heliopanel.plans.queries_eval import _cv, _full_predictions
    cv = _cv(spark, SF_SMALL)
    preds = _full_predictions(spark, SF_SMALL)
    metrics = EV.regression_metrics(preds, "y", "pred", ["model", "split"])
    path = sinks.save_training_results(os.path.join(tmpdir_path, "train"), metrics, cv, preds)
    assert spark.read.parquet(f"{path}/metrics").count() == metrics.count()
    assert spark.read.parquet(f"{path}/predictions").where("model = 'ols_rad'").count() == \
        preds.where("model = 'ols_rad'").count()
    tt = EV.paired_ttest(cv)
    models = sorted(r.model for r in cv.select("model").distinct().collect())
    out = sinks.write_comparison(os.path.join(tmpdir_path, "cmp"), EV.cv_summary(cv), tt, models)
    pv = spark.read.option("header", "true").csv(f"{out}_pvalues")
    assert pv.count() == len(models) and set(models) <= set(pv.columns)


def test_training_projection_and_grid(spark):
    import pytest
    from heliopanel.operators.panel import training_projection
    mf = FX.model_frame(spark, SF_SMALL)
    tr, te = mf.where("split = 'train'"), mf.where("split = 'test'")
    feats = training_projection(tr, te, "pv_production")
    assert "pv_production" not in feats and "global_rad:W" in feats
    with pytest.raises(ValueError):
        training_projection(tr, te.drop("hour"), "pv_production", ["hour"])
    g = M.param_grid({"n_estimators": [50, 100], "max_depth": [5, 10, 15]})
    assert len(g) == 6 and g[0] == {"n_estimators": 50, "max_depth": 5}


def test_missing_time_column_raises(spark):
    import pytest
    from heliopanel.operators.panel import check_columns
    with pytest.raises(ValueError):
        check_columns(spark.createDataFrame([(1,)], "x INT"), "time")
