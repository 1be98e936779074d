"""SQL text helpers for the oracle twins (DuckDB dialect)."""

from __future__ import annotations


def r6(expr: str) -> str:
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6)"


def q(c: str) -> str:
    return '"' + c.replace('"', '""') + '"'


def metrics_sql(src: str, y: str, yhat: str, group: list[str]) -> str:
    """Twin of evaluate.metric_exprs, rounded like the Spark side."""
    g = ", ".join(group)
    gsel = (g + ", ") if g else ""
    inner = (f"SELECT {gsel}CASE WHEN {y} IS NOT NULL AND {yhat} IS NOT NULL THEN {y} END AS _y, "
             f"CASE WHEN {y} IS NOT NULL AND {yhat} IS NOT NULL THEN {yhat} - {y} END AS _e FROM {src}")
    r2 = ("CASE WHEN var_pop(_y) = 0 THEN CASE WHEN avg(_e*_e) = 0 THEN 1.0 ELSE 0.0 END "
          "ELSE 1.0 - avg(_e*_e) / var_pop(_y) END")
    return (f"SELECT {gsel}count(_e) AS n, {r6('sqrt(avg(_e*_e))')} AS rmse, {r6('avg(abs(_e))')} AS mae, "
            f"{r6(r2)} AS r2, {r6('avg(CASE WHEN _y <> 0 THEN abs(_e / _y) END) * 100.0')} AS mape "
            f"FROM ({inner}) m" + (f" GROUP BY {g}" if g else ""))


def lag_sql(col: str, k: int, part: str, order: str = "time") -> str:
    over = f"OVER (PARTITION BY {part} ORDER BY {order})" if part else f"OVER (ORDER BY {order})"
    return f"lag({q(col)}, {k}) {over}"


COMPLETE_DAYS = """
_days AS (SELECT site_id, CAST(time AS DATE) AS _d, count(time) AS _c FROM {src} GROUP BY 1, 2),
_keep AS (SELECT site_id, _d FROM (SELECT *, bool_or(_c = {ppd}) OVER (PARTITION BY site_id) AS _any FROM _days) x
          WHERE _c = {ppd} OR NOT _any),
{name} AS (SELECT p.* FROM {src} p WHERE EXISTS (SELECT 1 FROM _keep k WHERE k.site_id = p.site_id
                                                 AND k._d = CAST(p.time AS DATE)))"""


def complete_days_sql(src: str = "panel", name: str = "cd", ppd: int = 24) -> str:
    return COMPLETE_DAYS.format(src=src, name=name, ppd=ppd)


def pearson_sql(a: str, b: str) -> str:
    """Twin of selection.pearson over one column pair (aggregate expression)."""
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    aa = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END"
    bb = f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    den = f"(stddev_pop({aa}) * stddev_pop({bb}))"
    return f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({aa}, {bb}) / {den} END"


def null_sum_sql(cols: list[str]) -> str:
    return "CAST(" + " + ".join(f"sum(CASE WHEN {q(c)} IS NULL THEN 1 ELSE 0 END)" for c in cols) + " AS BIGINT)"
