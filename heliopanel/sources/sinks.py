"""Sinks (A4-A8): tables written by Spark's distributed writers, never through the driver.

Small artefacts (selection parameters, model metadata) are one-row DataFrames written as
JSON next to the tables they describe.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "overwrite", cluster_by: Sequence[str] = ()) -> str:
    """A4: intermediate table sink (Parquet by default, CSV with header on request).
    Partitioning by series key / date enables partition pruning when read back;
    ``cluster_by`` (e.g. the time column) sorts inside files so row-group statistics prune
    range filters.  The only ordering the reference needs (B2) happens here, at the sink."""
    if cluster_by:
        df = df.sortWithinPartitions(*cluster_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """A4: intermediate table source."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", "true").option("inferSchema", "true" if schema is None else "false").csv(path)
    return r.format(fmt).load(path)


def save_selection(spark: SparkSession, path: str, params, selection: DataFrame, report: DataFrame) -> str:
    """A5: selection audit — parameters (1 row), selected features and the feature report."""
    meta = {"target_column": params.target, "correlation_threshold": params.threshold,
            "top_k_features": params.top_k, "must_include": list(params.must_include),
            "exclude_columns": sorted(params.exclude_columns), "exclude_patterns": list(params.exclude_patterns)}
    (spark.createDataFrame([(json.dumps(meta),)], "params STRING")
          .withColumn("created_at", F.current_timestamp()).write.mode("overwrite").json(f"{path}/params"))
    selection.write.mode("overwrite").json(f"{path}/selected")
    report.write.mode("overwrite").json(f"{path}/report")
    return path


def load_selection(spark: SparkSession, path: str):
    """A5: restore (params, ordered selected names, report DataFrame)."""
    from ..operators.selection import SelectorParams
    meta = json.loads(spark.read.json(f"{path}/params").first()["params"])
    params = SelectorParams(target=meta["target_column"], threshold=meta["correlation_threshold"],
                            top_k=meta["top_k_features"], must_include=meta["must_include"],
                            exclude_columns=meta["exclude_columns"], exclude_patterns=meta["exclude_patterns"])
    sel = spark.read.json(f"{path}/selected")
    names = [r["feature"] for r in sel.orderBy("position").select("feature").collect()]   # <= top_k rows
    return params, names, spark.read.json(f"{path}/report")


def save_training_results(path: str, metrics: DataFrame, cv: DataFrame, predictions: DataFrame | None = None,
                          grid: DataFrame | None = None) -> str:
    """Metrics, per-fold CV scores, grid scores and predictions as Parquet tables."""
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    cv.write.mode("overwrite").parquet(f"{path}/cv_scores")
    if grid is not None:
        grid.write.mode("overwrite").parquet(f"{path}/grid_scores")
    if predictions is not None:
        predictions.write.mode("overwrite").partitionBy("model").parquet(f"{path}/predictions")
    return path


def save_bundle(spark: SparkSession, path: str, fitted, comparison: DataFrame | None = None) -> str:
    """Inference bundle = fitted Spark ML model + one metadata row (features, target,
    model name, scaler statistics).  With ``comparison`` the caller passes the best model
    (lowest mean CV RMSE, see evaluate.cv_summary)."""
    from ..operators.models import GramLinear, RowModel
    if isinstance(fitted.model, RowModel):
        fitted.model.train.write.mode("overwrite").parquet(f"{path}/model")
    meta = {"name": fitted.name, "params": fitted.params, "features": fitted.features, "target": fitted.target,
            "scaler": fitted.scaler, "model_class": type(fitted.model).__name__}
    if isinstance(fitted.model, GramLinear):
        meta["gram"] = {"intercept": fitted.model.intercept, "coefficients": fitted.model.coefficients,
                        "alpha": fitted.model.alpha}
    elif not isinstance(fitted.model, RowModel):
        fitted.model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(meta),)], "meta STRING").write.mode("overwrite").json(f"{path}/meta")
    if comparison is not None:
        comparison.write.mode("overwrite").parquet(f"{path}/comparison")
    return path


def save_best_bundle(spark: SparkSession, path: str, comparison: DataFrame, fitted: dict) -> str:
    """A7 + G15: the bundle of the model of the lowest mean CV RMSE (ties: the first by name) among the
    fitted ones, with the comparison it won.  Returns the model's name."""
    names = [r["model"] for r in comparison.select("model", "mean_cv_rmse").orderBy("mean_cv_rmse", "model").collect()]  # a row a model
    best = next(n for n in names if n in fitted)
    save_bundle(spark, path, fitted[best], comparison)
    return best


def read_comparison(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_comparison`` wrote: the comparison, and (model_a, model_b, p_value)."""
    comparison = spark.read.option("header", "true").option("inferSchema", "true").csv(f"{path}_comparison")
    wide = spark.read.option("header", "true").option("inferSchema", "true").csv(f"{path}_pvalues")
    others = [c for c in wide.columns if c != "model_a"]
    cells = F.array(*[F.struct(F.lit(c).alias("model_b"), F.col(f"`{c}`").cast("double").alias("p_value")) for c in others])
    long = wide.select("model_a", F.explode(cells).alias("_c")).select("model_a", "_c.model_b", "_c.p_value")
    return comparison, long.where("model_a != model_b")


def load_bundle(spark: SparkSession, path: str):
    from pyspark.ml import regression as R
    from ..operators.models import FittedModel, GramLinear, RowModel
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    if "gram" in meta:
        model = GramLinear(**meta["gram"])
    elif meta["model_class"] == "RowModel":
        model = RowModel(meta["name"], spark.read.parquet(f"{path}/model"), meta["params"])
    else:
        model = getattr(R, meta["model_class"]).load(f"{path}/model")
    return FittedModel(meta["name"], meta["params"], meta["features"], meta["target"], meta["scaler"], model)


def write_comparison(path: str, comparison: DataFrame, pvalues: DataFrame, models: Sequence[str]) -> str:
    """Comparison CSV and p-value CSV (kept long internally, pivoted for export over the
    given model list, so the pivot needs no distinct-values pass)."""
    comparison.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}_comparison")
    wide = pvalues.groupBy("model_a").pivot("model_b", list(models)).agg(F.first("p_value"))
    wide.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{path}_pvalues")
    return path
