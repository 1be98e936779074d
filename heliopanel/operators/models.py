"""Regressors as Spark ML jobs.

Pipeline = standardise (population std, fitted on the training rows; F7) -> assemble ->
regressor.  Spark's own StandardScaler uses the sample std, so scaling is done with the
fit/apply operators and the estimator gets already-standardised features
(``standardization=False``).

Penalty mapping to the usual (scikit-learn) parametrisation, verified numerically:
  ridge  alpha -> regParam = alpha * std_pop(y) / n, elasticNetParam = 0, solver 'normal'
  lasso  alpha -> regParam = alpha, elasticNetParam = 1
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import apply_scaler, fit_scaler

FEATURES_COL = "features"
PRED_COL = "prediction"


def _ridge(p: dict, n: int, y_std: float):
    return LinearRegression(featuresCol=FEATURES_COL, labelCol="_y", elasticNetParam=0.0, solver="normal",
                            standardization=False, regParam=float(p.get("alpha", 1.0)) * y_std / max(n, 1))


def _lasso(p: dict, n: int, y_std: float):
    return LinearRegression(featuresCol=FEATURES_COL, labelCol="_y", elasticNetParam=1.0, standardization=False,
                            regParam=float(p.get("alpha", 1.0)), maxIter=int(p.get("max_iter", 1000)), tol=1e-12)


def _ols(p: dict, n: int, y_std: float):
    return LinearRegression(featuresCol=FEATURES_COL, labelCol="_y", regParam=0.0, solver="normal",
                            standardization=False)


def _rf(p: dict, n: int, y_std: float):
    mf = p.get("max_features", 1.0)
    return RandomForestRegressor(featuresCol=FEATURES_COL, labelCol="_y", numTrees=int(p.get("n_estimators", 100)),
                                 maxDepth=int(p.get("max_depth", 5)), minInstancesPerNode=int(p.get("min_samples_leaf", 1)),
                                 featureSubsetStrategy="all" if float(mf) >= 1.0 else str(float(mf)),
                                 seed=int(p.get("random_state", 42)))


def _gbt(p: dict, n: int, y_std: float):
    return GBTRegressor(featuresCol=FEATURES_COL, labelCol="_y", maxIter=int(p.get("n_estimators", 100)),
                        stepSize=float(p.get("learning_rate", 0.1)), maxDepth=int(p.get("max_depth", 3)),
                        subsamplingRate=float(p.get("subsample", 1.0)), seed=int(p.get("random_state", 42)))


# name -> factory(params, n_train_rows, std_pop(y)); the extension point for estimators.
ESTIMATORS: dict[str, Callable] = {
    "linear": _ols, "ridge": _ridge, "lasso": _lasso, "random_forest": _rf, "gradient_boosting": _gbt,
}


def register_estimator(name: str, factory: Callable) -> None:
    ESTIMATORS[name] = factory


def param_grid(grid: dict[str, Sequence]) -> list[dict]:
    """Cartesian product of a parameter grid, in declaration order."""
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])] or [{}]


@dataclass
class GramLinear:
    """Least squares / ridge solved from one pass of sufficient statistics (operators.linear):
    exact normal equations on the driver (p x p), prediction as a literal column expression."""
    intercept: float
    coefficients: list[float]
    alpha: float = 0.0

    def prediction(self, cols: Sequence) -> "F.Column":
        expr = F.lit(self.intercept)
        for w, c in zip(self.coefficients, cols):
            expr = expr + F.lit(w) * c
        return expr


# estimators fitted from sufficient statistics instead of a Spark ML job -> kind of operators.moments
GRAM_ESTIMATORS = {"linear_gram": "linear", "ridge_gram": "ridge", "lasso_gram": "lasso"}
DEFAULT_ALPHA = 1.0


@dataclass
class RowModel:
    """A model that scores rows beside its training rows: nearest neighbours, or binned trees that are
    grown while the rows go down them (the same trees every time, by their seed)."""
    kind: str
    train: DataFrame            # features as x0, x1, ..., target as y, row_key; written once
    params: dict

    def predict(self, df: DataFrame, cols: Sequence) -> DataFrame:
        """``df`` with ``prediction`` (null where a feature is null)."""
        from ..session import stage
        names = [f"x{j}" for j in range(len(cols))]
        ask = stage(df.withColumn("_row", F.monotonically_increasing_id()), "to_score")
        rows = self.train.select(*names, "y", (-1 - F.col("row_key")).alias("row_key"), F.lit(1).alias("trains"),
                                 F.lit(None).cast("int").alias("test_fold")) \
            .union(ask.select(*[c.cast("double") for c in cols], F.lit(None).cast("double"), F.col("_row"), F.lit(0), F.lit(0)))
        if self.kind == "knn":
            from .neighbours import neighbour_values, weighted
            k = int(self.params.get("n_neighbors", 5))
            scored = neighbour_values(rows, names, "y", k, 1, [weighted(k, self.params.get("weights", "uniform")).alias(PRED_COL)]) \
                .select("query", PRED_COL)
        elif self.kind == "boosted_trees":
            from .boosting import boost_predictions
            out, _ = boost_predictions(rows, names, "y", {c: [v] for c, v in self.params.items()}, 1)
            scored = out.select(F.col("key").alias("query"), F.col("p")[0].alias(PRED_COL))
        else:
            from .trees import forest_predictions
            out, sets, _ = forest_predictions(rows, names, "y", {c: [v] for c, v in self.params.items()}, 1)
            scored = out.select(F.col("key").alias("query"), F.col(sets[0][1].split(":")[1]).alias(PRED_COL))
        return ask.join(scored, F.col("_row") == F.col("query"), "left").drop("_row", "query")


# estimators whose models are RowModels
ROW_ESTIMATORS = ("knn", "binned_forest", "boosted_trees")


@dataclass
class FittedModel:
    name: str
    params: dict
    features: list[str]
    target: str
    scaler: dict
    model: object

    def transform(self, df: DataFrame) -> DataFrame:
        """Score any DataFrame holding the feature columns (adds ``prediction``)."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"missing feature columns: {missing}")
        zs = []
        for c in self.features:          # scaled copies; the caller's columns stay untouched
            st = self.scaler.get(c)
            x = F.col(f"`{c}`").cast("double")
            zs.append(x if st is None or st["center"] is None else (x - F.lit(st["center"])) / F.lit(st["scale"]))
        if isinstance(self.model, GramLinear):
            return df.withColumn(PRED_COL, self.model.prediction(zs))
        if isinstance(self.model, RowModel):
            return self.model.predict(df, zs)
        tmp = [f"__z{j}" for j in range(len(zs))]
        d = df.select("*", *[z.alias(t) for z, t in zip(zs, tmp)])
        asm = VectorAssembler(inputCols=tmp, outputCol=FEATURES_COL, handleInvalid="keep")
        return self.model.transform(asm.transform(d)).drop(FEATURES_COL, *tmp)

    def coefficients(self, spark) -> DataFrame:
        """(term, value) for linear models, in the standardised feature space."""
        coefs = (self.model.coefficients if isinstance(self.model, GramLinear)
                 else self.model.coefficients.toArray())
        rows = [("intercept", float(self.model.intercept))]
        rows += [(f, float(c)) for f, c in zip(self.features, coefs)]
        return spark.createDataFrame(rows, "term STRING, value DOUBLE")

    def importances(self, spark) -> DataFrame:
        """Tree importances, or |coefficient| for linear models."""
        if hasattr(self.model, "featureImportances"):
            vals = self.model.featureImportances.toArray()
        elif isinstance(self.model, RowModel):
            raise ValueError(f"{self.name} has no importances")
        elif isinstance(self.model, GramLinear):
            vals = [abs(c) for c in self.model.coefficients]
        else:
            vals = [abs(c) for c in self.model.coefficients.toArray()]
        return spark.createDataFrame([(f, float(v)) for f, v in zip(self.features, vals)],
                                     "feature STRING, importance DOUBLE")


def training_facts(train: DataFrame, features: Sequence[str], target: str, scaling: str = "standard"):
    """(scaler statistics by column, rows, target's population std) of the rows with a target."""
    train = train.where(F.col(f"`{target}`").isNotNull())
    stats = {r["column"]: r.asDict() for r in fit_scaler(train, list(features), scaling).collect()}   # one row per feature
    n, y_std = train.agg(F.count(F.lit(1)), F.stddev_pop(f"`{target}`")).first()
    return stats, int(n or 0), float(y_std or 0.0)


def fit(train: DataFrame, features: Sequence[str], target: str, name: str, params: dict | None = None,
        scaling: str = "standard", facts=None) -> FittedModel:
    """G1: fit scaler + estimator on the training rows (rows with a NULL target are ignored).

    ``facts``: what ``training_facts`` says of these rows, if the caller has it already."""
    params = dict(params or {})
    features = list(features)
    if name in GRAM_ESTIMATORS:
        from .moments import fit as fit_moments, segment_moments
        rows, own = train.select(*[F.col(f"`{c}`") for c in features], F.col(f"`{target}`")), scaling != "standard"
        if own:
            stats = (facts or training_facts(train, features, target, scaling))[0]
            rows = apply_scaler(rows, stats)
        whole = segment_moments(rows.withColumns({"trains": F.lit(1), "test_fold": F.lit(None).cast("int")}), features, target)
        if not whole:
            raise ValueError("no training rows")
        alpha = float(params.get("alpha", DEFAULT_ALPHA)) if GRAM_ESTIMATORS[name] != "linear" else 0.0
        b0, w, mean, sd = fit_moments(whole[1, -1], GRAM_ESTIMATORS[name], alpha, standardise=not own)
        if own:
            return FittedModel(name, params, features, target, stats, GramLinear(b0 - float(mean @ w), [float(v) for v in w], alpha))
        stats = {c: {"column": c, "center": float(m), "scale": float(d)} for c, m, d in zip(features, mean, sd)}
        return FittedModel(name, params, features, target, stats, GramLinear(b0, [float(v) for v in w], alpha))
    if name in ROW_ESTIMATORS:
        from ..session import stage
        stats = {r["column"]: r.asDict() for r in fit_scaler(train.where(F.col(f"`{target}`").isNotNull()), features, scaling).collect()}
        z = apply_scaler(train.select(*[F.col(f"`{c}`") for c in features], F.col(f"`{target}`").cast("double").alias("_y")), stats)
        kept = z.where(F.col("_y").isNotNull()).select(*[F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(features)],
                                                       F.col("_y").alias("y"), F.monotonically_increasing_id().alias("row_key"))
        return FittedModel(name, params, features, target, stats, RowModel(name, stage(kept, "model_rows"), params))
    stats, n, y_std = facts or training_facts(train, features, target, scaling)
    train = train.where(F.col(f"`{target}`").isNotNull())
    data = apply_scaler(train.select(*[F.col(f"`{c}`") for c in features],
                                     F.col(f"`{target}`").cast("double").alias("_y")), stats)
    asm = VectorAssembler(inputCols=features, outputCol=FEATURES_COL, handleInvalid="skip")
    est = ESTIMATORS[name](params, n, y_std)
    model = est.fit(asm.transform(data))
    return FittedModel(name, params, features, target, stats, model)


def cv_marks(train: DataFrame, features: Sequence[str], target: str, n_splits: int = 5, keys: Sequence[str] = (),
             time_col: str = "time", cv_strategy: str = "timeseries", seed: int = 42) -> DataFrame:
    """The training rows that have a target, with their fold marks and a ``row_key`` that ascends by (keys,
    time), written once for all models of a comparison.  ``cv_strategy``: 'timeseries' (expanding) or 'kfold' (shuffled)."""
    from ..session import stage
    from .splits import fold_marks

    cols = list(keys) + [time_col] + list(features) + [target]
    rows = train.select(*[F.col(f"`{c}`") for c in dict.fromkeys(cols)]).where(F.col(f"`{target}`").isNotNull())
    marks = fold_marks(rows, n_splits, cv_strategy, keys, time_col, seed=seed)
    order = [F.col(f"`{c}`") for c in (*keys, time_col)]
    return stage(marks.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row_key", F.monotonically_increasing_id()),
                 "cv_marks")


def grid_search_cv(train: DataFrame, features: Sequence[str], target: str, name: str, grid: dict,
                   n_splits: int = 5, keys: Sequence[str] = (), time_col: str = "time",
                   parallelism: int = 4, scaling: str = "standard", cv_strategy: str = "timeseries",
                   marks: DataFrame | None = None) -> DataFrame:
    """G5 for any registered estimator under expanding-window or shuffled k-fold CV.

    Rows are marked with their folds once (``cv_marks``; given as ``marks`` by callers that search
    several models) and never copied.  Linear models from sufficient statistics, the binned random
    forest and nearest neighbours score their whole grid in all folds together; for the others every
    (parameter set, fold) is a distributed Spark ML job over the marked rows, and ``parallelism``
    driver threads submit them concurrently, the scaler fitted on each fold's own training rows.
    Returns (grid_idx, params, fold, mse, n_test)."""
    import json
    from concurrent.futures import ThreadPoolExecutor

    spark = train.sparkSession
    schema = "grid_idx INT, params STRING, fold INT, mse DOUBLE, n_test LONG"
    if marks is None:
        marks = cv_marks(train, features, target, n_splits, keys, time_col, cv_strategy)
    combos = param_grid(grid)
    if name in GRAM_ESTIMATORS:
        from .moments import linear_grid, segment_moments
        if scaling != "standard":
            raise ValueError("estimators from moments standardise their features")
        alphas = [float(c.get("alpha", DEFAULT_ALPHA)) for c in combos]
        scores = linear_grid(segment_moments(marks, features, target), n_splits, GRAM_ESTIMATORS[name], alphas)
        return spark.createDataFrame([(gi, json.dumps(combos[gi], sort_keys=True), f, m, n) for gi, _, f, m, n in scores], schema)
    if name == "binned_forest":
        from .trees import forest_grid_scores
        return _in_order(forest_grid_scores(marks, features, target, grid, n_splits), combos, schema)
    if name == "boosted_trees":
        from .boosting import boost_grid_scores
        return _in_order(boost_grid_scores(marks, features, target, grid, n_splits), combos, schema)
    if name == "knn":
        from .neighbours import knn_grid_scores
        return _in_order(knn_grid_scores(marks, features, target, grid, n_splits), combos, schema)

    def part(f, role):
        return marks.where(F.col("trains").bitwiseAND(F.lit(1 << f)) != 0) if role == "train" else marks.where(F.col("test_fold") == f)

    # scaler and row counts depend on the fold alone
    facts = [training_facts(part(f, "train"), features, target, scaling) for f in range(n_splits)]

    def run(task):
        gi, params, f = task
        tr, te = part(f, "train"), part(f, "test")
        fm = fit(tr, features, target, name, params, scaling, facts[f])
        e = F.col(PRED_COL) - F.col(f"`{target}`")
        row = fm.transform(te).agg(F.avg(e * e).alias("mse"), F.count(e).alias("n")).first()
        return (gi, json.dumps(params, sort_keys=True), f, row["mse"], row["n"])

    tasks = [(gi, p, f) for gi, p in enumerate(combos) for f in range(n_splits)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = list(pool.map(run, tasks))
    return spark.createDataFrame(results, schema)


def _in_order(scores: DataFrame, combos: list[dict], schema: str) -> DataFrame:
    """Scores of a grid (a row per set and fold) with the places of the caller's sets: parameters that
    the grid leaves out have their defaults."""
    import json
    rows = []
    found = [(json.loads(r["params"]), r) for r in scores.collect()]        # sets x folds rows
    for gi, combo in enumerate(combos):
        rows += [(gi, json.dumps(combo, sort_keys=True), r["fold"], r["mse"], r["n_test"])
                 for p, r in found if all(p.get(k, v) == v for k, v in combo.items())]
    return scores.sparkSession.createDataFrame(rows, schema)


def summarize_grid(per_fold: DataFrame) -> DataFrame:
    """Mean negative MSE per parameter set (rank 1 = best; ties -> earlier grid entry)."""
    from pyspark.sql import Window
    s = per_fold.groupBy("grid_idx", "params").agg((-F.avg("mse")).alias("mean_test_score"),
                                                   F.stddev_pop("mse").alias("std_test_score"))
    return s.withColumn("rank_test_score", F.row_number().over(Window.orderBy(F.col("mean_test_score").desc(),
                                                                                 "grid_idx")))
