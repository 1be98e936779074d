"""Registered queries for sources/sinks and the streaming path."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..session import checkpoint_dir
from ..sources import sinks
from ..sources.tables import load_csv
from . import fixture_sql as FX
from .fixtures import model_frame, panel
from .registry import query
from .sqlparts import r6 as sr6

def _scratch(spark, name):
    """A fresh folder under the shared checkpoint location (never a machine-local temp dir)."""
    import uuid
    return os.path.join(checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex}")


PANEL_SCHEMA = ("site_id STRING, time TIMESTAMP_NTZ, pv_production DOUBLE, `global_rad:W` DOUBLE, "
                "`clear_sky_rad:W` DOUBLE, `sun_elevation:d` DOUBLE, temp DOUBLE")


@query("csv_scan", f"{FX.with_('panel')} SELECT * FROM panel")
def csv_scan(spark, sf_dir):
    """A1 + A4: the panel written as CSV (header, partitioned files) and scanned back with a
    declared schema — no inference pass, FAILFAST on malformed rows."""
    path = _scratch(spark, "panel_csv")
    sinks.write_table(panel(spark, sf_dir), path, fmt="csv")
    return load_csv(spark, path, PANEL_SCHEMA)


_STORE_FROM, _STORE_TO = "2024-01-05", "2024-01-20"


@query("store_lags", f"""{FX.with_('panel')},
s AS (SELECT * FROM panel WHERE CAST(time AS DATE) >= DATE '{_STORE_FROM}' AND CAST(time AS DATE) < DATE '{_STORE_TO}')
SELECT site_id, time, pv_production, lag(pv_production, 1) OVER w AS pv_production_lag_1, lag(pv_production, 24) OVER w AS pv_production_lag_24
FROM s WINDOW w AS (PARTITION BY site_id ORDER BY time)""")
def store_lags(spark, sf_dir):
    """A4 + B10 + E1: the panel saved as a store, a range of dates read from its own partitions, lags without a shuffle."""
    from ..sources.store import read_store, save_store, store_lags as lags
    table = save_store(panel(spark, sf_dir), _scratch(spark, "store"), ["site_id"])
    out = lags(read_store(spark, table, _STORE_FROM, _STORE_TO), ["pv_production"], [1, 24], ["site_id"])
    return out.select("site_id", "time", "pv_production", "pv_production_lag_1", "pv_production_lag_24")


@query("selection_audit", None)
def selection_audit(spark, sf_dir):
    """A5: selection parameters, selected names and report saved as JSON and loaded back;
    returns the restored report (same rows as feature_report)."""
    from ..operators import selection as SEL
    from .queries_quality import PARAMS, _fit
    tr, corr, sel = _fit(spark, sf_dir)
    rep = SEL.feature_report(tr, corr, sel, PARAMS)
    path = _scratch(spark, "selection")
    sinks.save_selection(spark, path, PARAMS, sel, rep)
    _params, _names, report = sinks.load_selection(spark, path)
    return report.select("feature", *[r6(c).alias(c) for c in ("correlation", "abs_correlation", "missing_rate")],
                         "selected", "must_include")


def _register_audit_sql():
    from . import registry
    from .queries_quality import feature_report  # noqa: F401  (ensures the twin exists)
    registry.ORACLE["selection_audit"] = registry.ORACLE["feature_report"]


@query("residuals", f"""{FX.with_('model_frame')},
f AS (SELECT regr_intercept(pv_production, "global_rad:W") AS b0, regr_slope(pv_production, "global_rad:W") AS b1
      FROM model_frame WHERE split = 'train')
SELECT site_id, time, split, pv_production, {sr6('b0 + b1 * "global_rad:W"')} AS prediction,
       {sr6('b0 + b1 * "global_rad:W" - pv_production')} AS residual FROM model_frame, f""")
def residuals(spark, sf_dir):
    """Row-level residuals of the OLS model on both splits."""
    from ..operators import models as M
    mf = model_frame(spark, sf_dir)
    fm = M.fit(mf.where("split = 'train'"), ["global_rad:W"], "pv_production", "linear_gram", scaling="none")
    out = fm.transform(mf)
    return out.select("site_id", "time", "split", "pv_production", r6("prediction").alias("prediction"),
                      r6(F.col("prediction") - F.col("pv_production")).alias("residual"))


_C2 = """(SELECT avg(pv_production) AS my, avg("global_rad:W") AS m1, avg("sun_elevation:d") AS m2,
        var_pop("global_rad:W") AS c11, var_pop("sun_elevation:d") AS c22,
        covar_pop("global_rad:W", "sun_elevation:d") AS c12,
        covar_pop("global_rad:W", pv_production) AS c1y, covar_pop("sun_elevation:d", pv_production) AS c2y
        FROM model_frame WHERE split = 'train') s"""


@query("ols_two_features", f"""{FX.with_('model_frame')},
b AS (SELECT my, m1, m2, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2 FROM {_C2})
SELECT 'intercept' AS term, {sr6('my - b1 * m1 - b2 * m2')} AS value FROM b
UNION ALL SELECT 'global_rad:W', {sr6('b1')} FROM b
UNION ALL SELECT 'sun_elevation:d', {sr6('b2')} FROM b""")
def ols_two_features(spark, sf_dir):
    """G6 by sufficient statistics: OLS on two features from one aggregation pass and a
    2 x 2 solve on the driver (SURVEY §4.5)."""
    from ..operators.linear import fit_gram
    c = fit_gram(model_frame(spark, sf_dir).where("split = 'train'"), ["global_rad:W", "sun_elevation:d"],
                 "pv_production")
    return c.select("term", r6("value").alias("value"))


@query("score_stream", None)
def score_stream(spark, sf_dir):
    """H3 as a stream: requests arrive as files, each micro-batch is scored by the batch
    functions inside foreachBatch (stream-static joins, stateless), output read back."""
    from ..operators import models as M
    from ..streaming.requests import request_stream, start_scoring
    from .fixtures import requests
    from .queries_scoring import _score_batch
    src, out = _scratch(spark, "requests_in"), _scratch(spark, "requests_scored")
    reqs = requests(spark, sf_dir)
    reqs.repartition(4).write.parquet(src)
    fm = M.fit(model_frame(spark, sf_dir).where("split = 'train'"), ["global_rad:W"], "pv_production", "linear_gram",
               scaling="none")
    q = start_scoring(request_stream(spark, src, reqs.schema, max_files_per_trigger=2),
                      lambda b: _score_batch(spark, sf_dir, b, fm), out, checkpoint=_scratch(spark, "stream_ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out).select("request_id", "prediction")


def _register_stream_sql():
    from . import registry
    registry.ORACLE["score_stream"] = registry.ORACLE["score_requests"]
