"""Property tests: blocked/bucketed window operators equal plain pandas semantics for
random series (gaps, nulls, several keys, tiny blocks)."""

import datetime as dt
import os

import pandas as pd
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from heliopanel.operators import series as S

T0 = dt.datetime(2024, 1, 1)

series_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 24 * 6),
              st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 3)))),
    min_size=1, max_size=120)


def _frame(spark, rows):
    seen, out = set(), []
    for k, h, v in rows:
        if (k, h) not in seen:
            seen.add((k, h))
            out.append((k, T0 + dt.timedelta(hours=h), v))
    pdf = pd.DataFrame(out, columns=["site_id", "time", "x"]).astype({"x": "float64"})
    return (spark.createDataFrame(out, "site_id STRING, time TIMESTAMP_NTZ, x DOUBLE"),
            pdf.sort_values(["site_id", "time"]).reset_index(drop=True))


@settings(max_examples=int(os.environ.get("HP_EXAMPLES", "8")), deadline=None, suppress_health_check=list(HealthCheck),
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(rows=series_st, block=st.integers(3, 9), lag=st.integers(1, 3))
def test_lags_fill_interpolate(spark, rows, block, lag):
    df, pdf = _frame(spark, rows)
    got = S.positional(df, lambda w: [F.lag("x", lag).over(w).alias("l")], lag, ["site_id"], block_rows=block)
    got = got.toPandas().sort_values(["site_id", "time"]).reset_index(drop=True)
    exp = pdf.groupby("site_id")["x"].shift(lag)
    assert got["l"].fillna(1e300).tolist() == exp.fillna(1e300).tolist()

    ff = S.fill_forward_backward(df, ["x"], ["site_id"]).toPandas().sort_values(["site_id", "time"]).reset_index(drop=True)
    exp = pdf.groupby("site_id")["x"].transform(lambda s: s.ffill().bfill())
    assert ff["x"].fillna(1e300).tolist() == exp.fillna(1e300).tolist()

    ip = S.interpolate_linear(df, ["x"], ["site_id"]).toPandas().sort_values(["site_id", "time"]).reset_index(drop=True)
    exp = pdf.groupby("site_id")["x"].transform(lambda s: s.interpolate(method="linear"))
    assert ((ip["x"].fillna(1e300) - exp.fillna(1e300)).abs() < 1e-9).all()
