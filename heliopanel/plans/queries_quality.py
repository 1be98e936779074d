"""Registered queries: quality tables, outliers/scaling and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import clean as C, quality as QL, selection as SEL
from . import fixture_sql as FX
from .fixtures import N_LAGS, TRAIN_END, engineered, line_features, panel, splits
from .registry import query
from .sqlparts import null_sum_sql, pearson_sql, q, r6 as sr6

PANEL_VALUES = ["pv_production", "global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "temp"]
ENG_COLS = (["site_id", "time"] + PANEL_VALUES + ["hour", "day_of_week", "month", "day_of_year",
            "global_rad_trend_1h", "global_rad_acceleration_1h", "pv_change_1h"]
            + [f"pv_production_lag_{k}" for k in range(1, N_LAGS + 1)] + ["is_daylight"])
ENG_NUMERIC = ENG_COLS[2:]
LINE_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


# ------------------------------------------------------------------ D1-D4, D15 ------
@query("quality_report", f"""{FX.with_('panel')}
SELECT site_id, count(*) AS total_records, min(time) AS min_time, max(time) AS max_time,
       {null_sum_sql(['time'] + PANEL_VALUES)} AS missing_values, '{','.join(PANEL_VALUES)}' AS numeric_columns
FROM panel GROUP BY site_id""")
def quality_report(spark, sf_dir):
    """Rows, time range, nulls and numeric columns per site."""
    return QL.quality_report(panel(spark, sf_dir), ["site_id"])


def _hourly_events(spark, sf_dir):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select(F.col("event_type").alias("site_id"),
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), "user_id")


@query("day_profile", f"""
WITH h AS (SELECT event_type AS site_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS time, user_id FROM events),
d AS (SELECT site_id, count(_d) AS n_days,
             {sr6('avg(_pts)')} AS mean_points_per_day, min(_pts) AS min_points_per_day, max(_pts) AS max_points_per_day
      FROM (SELECT site_id, CAST(time AS DATE) AS _d, count(time) AS _pts FROM h GROUP BY 1, 2) x
      GROUP BY site_id),
u AS (SELECT site_id, CAST(sum(_m - 1) AS BIGINT) AS duplicate_rows, CAST(sum(_m) AS BIGINT) AS total_records
      FROM (SELECT site_id, time, user_id, count(*) AS _m FROM h GROUP BY ALL) x GROUP BY site_id),
n AS (SELECT site_id, {null_sum_sql(['time', 'user_id'])} AS missing_values FROM h GROUP BY site_id)
SELECT * FROM d JOIN u USING (site_id) JOIN n USING (site_id)""")
def day_profile(spark, sf_dir):
    """Days, points per day, duplicated rows and nulls per site, on hourly-stamped events."""
    out = QL.day_profile(_hourly_events(spark, sf_dir), ["site_id"])
    return out.withColumn("mean_points_per_day", r6("mean_points_per_day"))


@query("feature_summary", f"""{FX.with_('engineered')}
SELECT CAST({len(ENG_COLS)} AS BIGINT) AS total_features, CAST({len(ENG_NUMERIC)} AS BIGINT) AS numeric_features,
       CAST(1 AS BIGINT) AS categorical_features, count(*) AS rows, {null_sum_sql(ENG_COLS)} AS missing_values
FROM engineered""")
def feature_summary(spark, sf_dir):
    """D3: counts of columns by kind, rows and nulls of the engineered table."""
    return QL.feature_summary(engineered(spark, sf_dir))


def _describe_sql(src, cols):
    parts = [f"""SELECT '{c}' AS "column", count({q(c)}) AS count, {sr6(f'avg({q(c)})')} AS mean,
       {sr6(f'stddev_samp({q(c)})')} AS std, CAST(min({q(c)}) AS DOUBLE) AS min, CAST(max({q(c)}) AS DOUBLE) AS max FROM {src}"""
             for c in cols]
    return "\nUNION ALL ".join(parts)


@query("describe", f"{FX.with_('panel')} {_describe_sql('panel', PANEL_VALUES)}")
def describe(spark, sf_dir):
    """Count, mean, sample std, min, max per panel column."""
    d = QL.describe(panel(spark, sf_dir), PANEL_VALUES)
    return d.withColumn("mean", r6("mean")).withColumn("std", r6("std"))


@query("split_validation", f"""{FX.with_('splits')},
lt AS (SELECT site_id, max(time) AS _lt FROM splits WHERE split = 'train' GROUP BY site_id),
pt AS (SELECT site_id, time, sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS _tr,
              sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS _te FROM splits GROUP BY site_id, time)
SELECT 'order' AS "check", 'test' AS split,
       CAST(coalesce(sum(CASE WHEN s.time <= lt._lt THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_bad
FROM splits s LEFT JOIN lt USING (site_id) WHERE s.split = 'test'
UNION ALL SELECT 'overlap', 'all', CAST(sum(CASE WHEN _tr > 0 AND _te > 0 THEN 1 ELSE 0 END) AS BIGINT) FROM pt
UNION ALL SELECT 'duplicates', 'train', CAST(sum(greatest(_tr - 1, 0)) AS BIGINT) FROM pt
UNION ALL SELECT 'duplicates', 'test', CAST(sum(greatest(_te - 1, 0)) AS BIGINT) FROM pt
UNION ALL SELECT 'nulls', split, CAST(sum(CASE WHEN temp IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM splits GROUP BY split
""".replace("SELECT 'order' AS \"check\"", "SELECT *, n_bad = 0 AS ok FROM (SELECT 'order' AS \"check\"") + ") v")
def split_validation(spark, sf_dir):
    """Ordering, overlap, duplicate and null checks of a train/test split."""
    return QL.split_validation(splits(spark, sf_dir), ["site_id"], value_cols=["temp"])


@query("gap_check", f"""{FX.with_('panel')}
SELECT site_id, time, prev_time, CAST(epoch(time) - epoch(prev_time) AS DOUBLE) / 3600.0 AS gap_hours
FROM (SELECT site_id, time, lag(time) OVER (PARTITION BY site_id ORDER BY time) AS prev_time FROM panel) x
WHERE epoch(time) - epoch(prev_time) > 3600""")
def gap_check(spark, sf_dir):
    """Missing hours inside each site's series."""
    return QL.gaps(panel(spark, sf_dir), ["site_id"], "time", 3600)


# ------------------------------------------------------------------ D5, D6, F7 -------
def _iqr_sql():
    parts = [f"""SELECT '{c}' AS "column", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM line_features"""
             for c in LINE_COLS]
    return "iq AS (SELECT \"column\", q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (" + \
        " UNION ALL ".join(parts) + ") x)"


@query("iqr_bounds", f"""{FX.with_('line_features')}, {_iqr_sql()}
SELECT "column", {sr6('q1')} AS q1, {sr6('q3')} AS q3, {sr6('lower')} AS lower, {sr6('upper')} AS upper FROM iq""")
def iqr_bounds(spark, sf_dir):
    """D5 fit: exact linear quantiles (distributed rank selection) and Tukey fences."""
    b = C.fit_iqr_bounds(line_features(spark, sf_dir), LINE_COLS)
    return b.select("column", *[r6(c).alias(c) for c in ("q1", "q3", "lower", "upper")])


def _clip_sql(c):
    lo = f"(SELECT lower FROM iq WHERE \"column\" = '{c}')"
    hi = f"(SELECT upper FROM iq WHERE \"column\" = '{c}')"
    return f"{sr6(f'CASE WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE CAST({c} AS DOUBLE) END')} AS {c}"


@query("iqr_clip", f"""{FX.with_('line_features')}, {_iqr_sql()}
SELECT {', '.join(LINE_KEYS)}, {', '.join(_clip_sql(c) for c in LINE_COLS)} FROM line_features""")
def iqr_clip(spark, sf_dir):
    """D5 apply: winsorise at the fences (NULL stays NULL)."""
    lf = line_features(spark, sf_dir).select(*LINE_KEYS, *LINE_COLS)
    out = C.apply_clip(lf, C.fit_iqr_bounds(lf, LINE_COLS))
    return out.select(*LINE_KEYS, *[r6(c).alias(c) for c in LINE_COLS])


def _z_sql(c):
    m, s = f"(SELECT avg({c}) FROM line_features)", f"(SELECT stddev_samp({c}) FROM line_features)"
    return (f"{sr6(f'CASE WHEN {s} IS NULL OR {s} = 0 THEN CAST({c} AS DOUBLE) WHEN abs(({c} - {m}) / {s}) > 3 THEN {m} ELSE CAST({c} AS DOUBLE) END')} AS {c}")


@query("zscore_replace", f"""{FX.with_('line_features')}
SELECT {', '.join(LINE_KEYS)}, {', '.join(_z_sql(c) for c in LINE_COLS)} FROM line_features""")
def zscore_replace(spark, sf_dir):
    """Values with |z| > 3 (sample std) replaced by the column mean."""
    lf = line_features(spark, sf_dir).select(*LINE_KEYS, *LINE_COLS)
    out = C.apply_zscore(lf, C.fit_zscore(lf, LINE_COLS))
    return out.select(*LINE_KEYS, *[r6(c).alias(c) for c in LINE_COLS])


_FIT_WHERE = "l_shipdate < TIMESTAMP '1999-01-01 00:00:00'"


def _scale_sql(c, method):
    tr = f"line_features WHERE {_FIT_WHERE}"
    if method == "standard":
        center, spread = f"(SELECT avg({c}) FROM {tr})", f"(SELECT stddev_pop({c}) FROM {tr})"
    else:
        center, spread = f"(SELECT min({c}) FROM {tr})", f"(SELECT max({c}) - min({c}) FROM {tr})"
    scale = f"(CASE WHEN {spread} = 0 THEN 1.0 ELSE {spread} END)"
    return f"{sr6(f'(CAST({c} AS DOUBLE) - {center}) / {scale}')} AS {c}"


def _scaled(spark, sf_dir, method):
    lf = line_features(spark, sf_dir)
    train = lf.where(F.col("l_shipdate") < F.lit("1999-01-01 00:00:00").cast("timestamp_ntz"))
    stats = C.fit_scaler(train, LINE_COLS, method)
    out = C.apply_scaler(lf.select(*LINE_KEYS, *LINE_COLS), stats)
    return out.select(*LINE_KEYS, *[r6(c).alias(c) for c in LINE_COLS])


@query("standard_scale", f"""{FX.with_('line_features')}
SELECT {', '.join(LINE_KEYS)}, {', '.join(_scale_sql(c, 'standard') for c in LINE_COLS)} FROM line_features""")
def standard_scale(spark, sf_dir):
    """standard scaling fitted on rows shipped before 1999 (population std)."""
    return _scaled(spark, sf_dir, "standard")


@query("minmax_scale", f"""{FX.with_('line_features')}
SELECT {', '.join(LINE_KEYS)}, {', '.join(_scale_sql(c, 'minmax') for c in LINE_COLS)} FROM line_features""")
def minmax_scale(spark, sf_dir):
    """min-max scaling fitted on rows shipped before 1999."""
    return _scaled(spark, sf_dir, "minmax")


# ------------------------------------------------------------------ D7-D10, B7, E9 ---
PARAMS = SEL.SelectorParams(target="pv_production", threshold=0.1, top_k=10,
                            must_include=["temp", "month", "hour"],
                            exclude_columns=["clear_sky_rad:W"], exclude_patterns=["_lag_2"])
CANDIDATES = [c for c in ENG_NUMERIC if not PARAMS.excluded(c)]
_TRAIN_SQL = f"(SELECT * FROM engineered WHERE time < TIMESTAMP '{TRAIN_END}')"


def _train(spark, sf_dir):
    e = engineered(spark, sf_dir)
    return e.where(F.col("time") < F.lit(TRAIN_END).cast("timestamp_ntz"))


def _selection_sql() -> str:
    corr = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {pearson_sql(q(c), 'pv_production')} AS correlation FROM tr" for c in CANDIDATES)
    extra = [m for m in PARAMS.must_include if m in ENG_COLS and not PARAMS.excluded(m)]
    values = ", ".join(f"('{m}', {i})" for i, m in enumerate(extra))
    return f"""{FX.with_('engineered')},
tr AS {_TRAIN_SQL},
rc AS ({corr}),
ranked AS (SELECT feature, correlation, abs(correlation) AS abs_correlation,
                  row_number() OVER (ORDER BY abs(correlation) DESC, feature) AS rank
           FROM rc WHERE correlation IS NOT NULL),
chosen AS (SELECT feature, correlation, position FROM
             (SELECT *, row_number() OVER (ORDER BY rank) AS position FROM ranked WHERE abs_correlation >= {PARAMS.threshold}) x
           WHERE position <= {PARAMS.top_k}),
must AS (SELECT * FROM (VALUES {values}) t(feature, _mi)),
sel AS (SELECT feature, CAST(position AS INTEGER) AS position, correlation FROM chosen
        UNION ALL
        SELECT m.feature, CAST((SELECT count(*) FROM chosen) + row_number() OVER (ORDER BY _mi) AS INTEGER), r.correlation
        FROM must m LEFT JOIN ranked r USING (feature) WHERE m.feature NOT IN (SELECT feature FROM chosen))"""


@query("target_corr", f"""{_selection_sql()}
SELECT feature, {sr6('correlation')} AS correlation, {sr6('abs_correlation')} AS abs_correlation, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE abs_correlation >= {PARAMS.threshold}""")
def target_corr(spark, sf_dir):
    """Pearson r of every numeric, non-excluded column with the target on the training
    rows, |r| >= threshold, ranked by |r| (one aggregation pass)."""
    c = SEL.target_correlation(_train(spark, sf_dir), PARAMS, ["site_id"])
    c = c.where(F.col("abs_correlation") >= PARAMS.threshold)
    return c.select("feature", r6("correlation").alias("correlation"), r6("abs_correlation").alias("abs_correlation"),
                    F.col("rank").cast("int").alias("rank"))


CORR_COLS = ["pv_production", "global_rad:W", "clear_sky_rad:W", "sun_elevation:d", "temp", "hour",
             "global_rad_trend_1h", "pv_change_1h", "pv_production_lag_1", "pv_production_lag_24", "is_daylight"]


def _corr_matrix_sql():
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS[i + 1:]:
            v = sr6(pearson_sql(q(a), q(b)))
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {v} AS corr FROM engineered")
            parts.append(f"SELECT '{b}' AS feature_a, '{a}' AS feature_b, {v} AS corr FROM engineered")
        parts.append(f"SELECT '{a}' AS feature_a, '{a}' AS feature_b, 1.0::DOUBLE AS corr")
    return " UNION ALL ".join(parts)


@query("corr_matrix", f"{FX.with_('engineered')} {_corr_matrix_sql()}")
def corr_matrix(spark, sf_dir):
    """Full pairwise correlation matrix in long form (one aggregation)."""
    m = SEL.correlation_matrix(engineered(spark, sf_dir), CORR_COLS)
    return m.withColumn("corr", r6("corr"))


def _fit(spark, sf_dir):
    tr = _train(spark, sf_dir)
    corr = SEL.target_correlation(tr, PARAMS, ["site_id"])
    return tr, corr, SEL.fit_selection(corr, PARAMS, tr.columns)


@query("select_features", f"""{_selection_sql()}
SELECT feature, position, {sr6('correlation')} AS correlation, feature IN ({', '.join(f"'{m}'" for m in PARAMS.must_include)}) AS must_include
FROM sel""")
def select_features(spark, sf_dir):
    """Threshold -> top_k by |r| -> must-include names appended."""
    _, _, sel = _fit(spark, sf_dir)
    return sel.withColumn("correlation", r6("correlation"))


@query("feature_report", f"""{_selection_sql()},
mr AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, avg(CASE WHEN {q(c)} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS missing_rate FROM tr" for c in CANDIDATES)})
SELECT r.feature, {sr6('r.correlation')} AS correlation, {sr6('r.abs_correlation')} AS abs_correlation,
       {sr6('mr.missing_rate')} AS missing_rate, r.feature IN (SELECT feature FROM sel) AS selected,
       r.feature IN ({', '.join(f"'{m}'" for m in PARAMS.must_include)}) AS must_include
FROM ranked r JOIN mr USING (feature)""")
def feature_report(spark, sf_dir):
    """Correlation, missing rate and selection flags per candidate feature."""
    tr, corr, sel = _fit(spark, sf_dir)
    rep = SEL.feature_report(tr, corr, sel, PARAMS)
    return rep.select("feature", *[r6(c).alias(c) for c in ("correlation", "abs_correlation", "missing_rate")],
                      "selected", "must_include")


@query("apply_selection", f"""{_selection_sql()},
te AS (SELECT * FROM engineered WHERE time >= TIMESTAMP '{TRAIN_END}'),
tec AS (SELECT site_id, time, {', '.join(f'CAST({q(c)} AS DOUBLE) AS {q(c)}' for c in ENG_NUMERIC)} FROM te),
lg AS (SELECT * FROM tec UNPIVOT INCLUDE NULLS (value FOR feature IN ({', '.join(q(c) for c in ENG_NUMERIC)})))
SELECT site_id, time, feature, value FROM lg
WHERE feature IN (SELECT feature FROM sel) OR feature = 'pv_production'""")
def apply_selection(spark, sf_dir):
    """The fitted columns (+ target) projected from the test split, shown long
    (site_id, time, feature, value) so the oracle can follow a data-dependent selection."""
    _, _, sel = _fit(spark, sf_dir)
    names = SEL.selected_names(sel)
    e = engineered(spark, sf_dir)
    te = e.where(F.col("time") >= F.lit(TRAIN_END).cast("timestamp_ntz"))
    wide = SEL.apply_selection(te, names, "pv_production", keep=["site_id", "time"])
    vals = [c for c in wide.columns if c not in ("site_id", "time")]
    wide = wide.select("site_id", "time", *[F.col(f"`{c}`").cast("double").alias(c) for c in vals])
    return wide.unpivot(["site_id", "time"], vals, "feature", "value")


@query("top_features", f"""{_selection_sql()}
SELECT feature, {sr6('abs_correlation')} AS abs_correlation, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 5""")
def top_features(spark, sf_dir):
    """Top-5 features by |r| (row_number with name tie-break)."""
    from ..operators.series import top_k
    c = SEL.target_correlation(_train(spark, sf_dir), PARAMS, ["site_id"]).drop("rank")
    t = top_k(c, 5, [F.col("abs_correlation").desc(), F.col("feature")], rank_col="rank")
    return t.select("feature", r6("abs_correlation").alias("abs_correlation"), F.col("rank").cast("int").alias("rank"))
