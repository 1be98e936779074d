"""

Each job is executed into a no-op sink; the executed plan is inspected for shuffles and
scans; task row counts come from the partition sizes of the window input.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window
from pyspark.sql import functions as F

from heliopanel.session import get_spark


def run(df):
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    dt = time.perf_counter() - t0
    plan = df._jdf.queryExecution().executedPlan().toString()
    return round(dt, 2), plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") + \
        plan.count("Exchange SinglePartition"), len(re.findall(r"FileScan parquet", plan)), plan


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", "measure", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hp-measure-"))
    spark.range(10).count()
    from heliopanel.operators import panel as P, series as S, selection as SEL
    from heliopanel.operators.knn import knn_predict
    from heliopanel.operators.linear import ridge_cv_gram
    from heliopanel.plans import fixtures as FX
    out = {}
    p = FX.panel(spark, sf)
    feat = S.handle_missing(S.radiation_features(P.complete_days(p, ["site_id"]), ["site_id"], n_lags=24),
                            "forward_fill", keys=["site_id"])
    t, ex, sc, _ = run(feat)
    out["feature_job_unstaged"] = {"sec": t, "exchanges": ex, "scans_of_panel": sc}
    from heliopanel.session import stage
    t0 = time.perf_counter()
    cd = stage(P.complete_days(p, ["site_id"]))
    ft = stage(S.radiation_features(cd, ["site_id"], n_lags=24))
    t, ex, sc, _ = run(S.handle_missing(ft, "forward_fill", keys=["site_id"]))
    out["feature_job_staged"] = {"sec": round(time.perf_counter() - t0, 2), "scans_last_stage": sc, "stage_writes": 2}
    lf = FX.line_features(spark, sf)
    params = SEL.SelectorParams(target="l_extendedprice", threshold=0.0)
    t, ex, sc, _ = run(SEL.target_correlation(lf, params, ["l_orderkey", "l_partkey", "l_suppkey"]))
    out["target_corr_line_features"] = {"sec": t, "exchanges": ex, "scans": sc}
    feats = ["l_quantity", "l_discount", "l_tax", "line_no"]
    t0 = time.perf_counter()
    g = ridge_cv_gram(lf.withColumn("time", F.col("l_shipdate")), feats, "l_extendedprice",
                      [0.1, 1.0, 10.0, 100.0], 5, [], "time")
    g.collect()
    out["ridge_grid_gram_line_features"] = {"sec": round(time.perf_counter() - t0, 2), "grid": 4, "folds": 5,
                                            "aggregations_over_data": 1}
    one = lf.select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    blocked = S.positional(one, lambda w: [F.lag("l_extendedprice", 24).over(w).alias("l24")], 24, [], "l_shipdate",
                           tiebreak=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    t, ex, sc, plan = run(blocked)
    out["lag24_one_series_blocked"] = {"sec": t, "exchanges": ex, "single_partition_exchanges": plan.count("SinglePartition"),
                                       "max_rows_per_window_group": 8192 + 24}
    plain = one.select("*", F.lag("l_extendedprice", 24).over(
        Window.orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("l24"))
    t, ex, sc, plan = run(plain)
    out["lag24_one_series_plain_window"] = {"sec": t, "exchanges": ex, "single_partition_exchanges": plan.count("SinglePartition"),
                                            "max_rows_per_window_group": lf.count()}
    # "1,000 queries"); the train side is the whole table.  Not a registered query.
    q = lf.where(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 600 == 0).limit(1000)
    q = q.select(F.monotonically_increasing_id().alias("qid"), *feats)
    q = q.cache()
    nq = q.count()
    tr = lf.withColumn("tid", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    t, ex, sc, _ = run(knn_predict(tr, q, feats, "l_extendedprice", 5, "uniform", ["tid"], ["qid"]))
    out["knn_line_features"] = {"sec": t, "queries": nq, "train_rows": tr.count(), "k": 5}
    print(json.dumps(out, indent=1))


if __name__ == "__main__":
    main()
