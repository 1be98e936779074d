"""Quality tables on hand-made frames; approximate quantiles; selection is fitted on train only."""

import datetime as dt

from pyspark.sql import functions as F

from heliopanel.operators import clean as C, quality as QL, selection as SEL

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "site_id STRING, time TIMESTAMP_NTZ, split STRING, temp DOUBLE")


def test_split_validation_flags(spark):
    h = lambda i: T0 + dt.timedelta(hours=i)
    rows = [("a", h(0), "train", 1.0), ("a", h(1), "train", None), ("a", h(1), "test", 2.0),
            ("a", h(2), "test", 3.0), ("a", h(2), "test", 3.0), ("b", h(5), "train", 1.0), ("b", h(6), "test", 1.0)]
    out = {(r["check"], r["split"]): (r["n_bad"], r["ok"]) for r in
           QL.split_validation(_rows(spark, rows), ["site_id"], value_cols=["temp"]).collect()}
    assert out[("order", "test")] == (1, False)          # a@1h test is not after a's last train hour
    assert out[("overlap", "all")] == (1, False)
    assert out[("duplicates", "test")] == (1, False) and out[("duplicates", "train")] == (0, True)
    assert out[("nulls", "train")] == (1, False) and out[("nulls", "test")] == (0, True)


def test_gaps_and_day_profile(spark):
    hours = [0, 1, 2, 5, 6, 30]
    rows = [("a", T0 + dt.timedelta(hours=i), "x", 1.0) for i in hours] + [("a", T0, "x", 1.0)]
    df = _rows(spark, rows)
    g = sorted((r.gap_hours for r in QL.gaps(df.dropDuplicates(), ["site_id"]).collect()))
    assert g == [3.0, 24.0]
    p = QL.day_profile(df.select("site_id", "time", "temp"), ["site_id"]).first()
    assert (p.n_days, p.min_points_per_day, p.max_points_per_day, p.duplicate_rows, p.total_records) == (2, 1, 6, 1, 7)


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(0, 20001).select((F.col("id") * 0.5).alias("x"))
    ex = {r["p"]: r["quantile"] for r in C.exact_quantiles(df, ["x"], [0.25, 0.75]).collect()}
    ap = {r["p"]: r["quantile"] for r in C.approx_quantiles(df, ["x"], [0.25, 0.75], 10000).collect()}
    assert ex == {0.25: 2500.0, 0.75: 7500.0}
    assert all(abs(ap[p] - ex[p]) <= 10000 * 0.5 / 10000 * 2 for p in ex)


def test_selection_ignores_rows_outside_training(spark):
    rows = [(float(i), float(i % 7), float(2 * i + (i % 3)), "train" if i < 60 else "test") for i in range(100)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y DOUBLE, split STRING")
    changed = df.withColumn("y", F.when(F.col("split") == "test", -F.col("y") * 1000).otherwise(F.col("y")))
    params = SEL.SelectorParams(target="y", threshold=0.0, top_k=5)

    def fit(d):
        tr = d.where("split = 'train'").drop("split")
        c = SEL.target_correlation(tr, params)
        return [(r.feature, round(r.position)) for r in SEL.fit_selection(c, params, tr.columns).orderBy("position").collect()]
    assert fit(df) == fit(changed)
