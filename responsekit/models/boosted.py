"""Tree classifiers (M1-M4, M9) and probability scoring.

The three boosted variants of the reference are presets of one booster
(``histboost.py``): it continues from stored margins, watches the validation
curve with a patience of 50 rounds, and the best prefix of the rounds is the
model. The random forest is Spark ML's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import ID_COL, TARGET_COL
from responsekit.models.histboost import Booster, BoostedModel, Curve, Params, Prepared, prepare
from responsekit.operators import evaluate as V
from responsekit.operators.encode import vector_column, vector_stages
from responsekit.operators.sampling import class_counts, class_weights, with_weights
from responsekit.session import discard

FEATURES, LABEL, WEIGHT, FOLD = "features", "label", "weight", "_fold"
ROWS_PER_TASK = 20_000

# --- Fixed values: parameter presets carried over from the reference.
PRESETS = {
    # single boosted model with early stopping (the CatBoost setup)
    "catboost": dict(maxIter=5000, stepSize=0.02, maxDepth=6, maxBins=254, minInstancesPerNode=10,
                     featureSubsetStrategy=0.9, l2=10.0),
    # alternative boosted model (the XGBoost setup)
    "xgboost": dict(maxIter=2000, stepSize=0.05, maxDepth=6, maxBins=256, subsamplingRate=0.8,
                    featureSubsetStrategy=0.8, levelColumns=0.8, minInfoGain=0.1, minHessian=3.0, l1=0.1, l2=1.0),
    # simple mode: 500 rounds, rate 0.05, depth 6
    "simple": dict(maxIter=500, stepSize=0.05, maxDepth=6, l2=3.0),
    # stacking base learners (300 estimators each)
    "stack_gbt_a": dict(maxIter=300, stepSize=0.05, maxDepth=6, l2=5.0),
    "stack_gbt_b": dict(maxIter=300, stepSize=0.05, maxDepth=6, subsamplingRate=0.8, featureSubsetStrategy=0.8, minHessian=1.0, l2=1.0),
}
FOREST = dict(numTrees=100, maxDepth=4)
PATIENCE = 50
# --- end of fixed values

#: Parameter names of presets and search ranges, and the booster's.
NAMES = {"maxIter": "rounds", "stepSize": "rate", "maxDepth": "depth", "maxBins": "bins", "minInstancesPerNode": "min_rows",
         "featureSubsetStrategy": "columns", "levelColumns": "level_columns", "subsamplingRate": "rows", "minInfoGain": "min_gain",
         "minHessian": "min_hessian", "l1": "l1", "l2": "l2"}


def booster_params(preset: str = "catboost", max_iter: int | None = None, seed: int = 42, **overrides) -> Params:
    """The booster's parameters of a preset; ``max_iter`` replaces its number of rounds."""
    given = {**PRESETS[preset], **overrides}
    if max_iter is not None:
        given["maxIter"] = max_iter
    return Params(seed=seed, **{NAMES[k]: v for k, v in given.items()})


def assembler(cols) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=FEATURES, handleInvalid="keep")


def with_label(df: DataFrame, label: str = TARGET_COL) -> DataFrame:
    return df.withColumn(LABEL, F.col(label).cast("double"))


def forest(seed: int = 42, weighted: bool = False, **overrides) -> RandomForestClassifier:
    params = dict(FOREST)
    params.update(overrides)
    if weighted:
        params["weightCol"] = WEIGHT
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def fit_pipeline(estimator, df: DataFrame, cols, categories=()) -> PipelineModel:
    """Fit on ``df``; partitions of fewer than ``ROWS_PER_TASK`` rows are joined first, because a tree fit runs many
    short jobs whose cost is their number of tasks. ``categories`` (string columns without nulls) enter as sparse
    one-hot vectors of any number of levels, in fitting and in scoring."""
    data = with_label(df)
    data = data.coalesce(max(1, math.ceil(data.count() / ROWS_PER_TASK)))
    categories = list(categories)
    stages = vector_stages(categories) if categories else []
    return Pipeline(stages=[*stages, assembler([*cols, *map(vector_column, categories)]), estimator]).fit(data)


def probability(model, df: DataFrame, keep=(ID_COL,)) -> DataFrame:
    """M9: ``p`` = probability of class 1, next to the kept columns."""
    keep = [c for c in keep if c in df.columns]
    if isinstance(model, BoostedModel):
        return df.select(*keep, model.p().alias("p"))
    return model.transform(df).select(*keep, vector_to_array(F.col("probability"))[1].alias("p"))


@dataclass
class TrainResult:
    model: BoostedModel
    features: list
    threshold: float = 0.5
    metrics: dict = field(default_factory=dict)
    curve: list = field(default_factory=list)  # the watched value on the validation rows, by round
    curves: Curve = field(default_factory=Curve)
    stopped: bool = False  # the clock ended the fit


def validation_metrics(scored: DataFrame, label: str = TARGET_COL, threshold: float = 0.5,
                       strict: bool = True) -> dict:
    s = scored.select(F.col(label).alias("y"), "p").withColumn(
        "pred", V.label_threshold(F.col("p"), threshold, strict))
    acc = V.accuracy(s).first()["accuracy"]
    auc = V.auc_exact(s).first()["auc"]
    ll = V.log_loss(s).first()["log_loss"]
    return {"accuracy": acc, "auc": auc, "log_loss": ll}


def prepare_split(train: DataFrame, valid: DataFrame, cols, label: str, bins: int, weight: str | None = None) -> Prepared:
    """Training rows (fold 0) and validation rows (fold 1, weight 1) binned at quantiles of the training rows."""
    def side(df, fold):
        w = F.col(weight).cast("double") if weight and not fold else F.lit(1.0)
        return df.select(F.col(ID_COL), F.col(label).alias(LABEL), w.alias(WEIGHT), F.lit(fold).alias(FOLD), *[f"`{c}`" for c in cols])
    return prepare(side(train, 0).unionByName(side(valid, 1)), list(cols), LABEL, ID_COL, bins, WEIGHT, FOLD, edge_rows=train)


def fit_rounds(train: DataFrame, cols, preset: str = "simple", rounds: int | None = None, seed: int = 42, label: str = TARGET_COL,
               **overrides) -> BoostedModel:
    """All rounds of a preset on all of ``train``, without validation rows."""
    params = booster_params(preset, rounds, seed, **overrides)
    data = prepare(train, list(cols), label, ID_COL, params.bins)
    fit = Booster(data, params)
    fit.run(params.rounds)
    fit.close()
    discard(data.table)
    return fit.model()


def train_boosted(train: DataFrame, valid: DataFrame, cols, preset: str = "catboost", max_iter: int | None = None,
                  class_weight: str | None = "Balanced", tune_threshold: bool = True, seed: int = 42,
                  label: str = TARGET_COL, watch: str = "log_loss", weight_col: str | None = None, patience: int | None = None,
                  deadline: float | None = None, **overrides) -> TrainResult:
    """M1/M2/M3: boosting until ``watch`` has not improved for ``patience`` rounds or the rounds are used up, cut to the
    best round; optional class weights (or weights in ``weight_col``) and F1-tuned threshold."""
    params = booster_params(preset, max_iter, seed, **overrides)
    rows = train
    if class_weight not in (None, "None"):
        weight_col, rows = WEIGHT, with_weights(train, class_weights(class_counts(train, label), class_weight), label, WEIGHT)
    data = prepare_split(rows, valid, cols, label, params.bins, weight_col)
    fit = Booster(data, params, held_out=1, watch=watch)
    best = fit.run_until(params.rounds, PATIENCE if patience is None else patience, deadline)
    fit.close()
    discard(data.table)
    model = fit.model(best)
    sv = probability(model, valid, keep=(ID_COL, label))
    res = TrainResult(model, list(cols), curve=fit.curve.watched(watch), curves=fit.curve, stopped=fit.stopped)
    if tune_threshold:
        sweep = V.f1_sweep(sv.select(F.col(label).alias("y"), "p"))
        res.threshold, _ = V.best_threshold(sweep, "f1")
    res.metrics = validation_metrics(sv, label, 0.5, strict=True)
    res.metrics["threshold"] = res.threshold
    res.metrics["trees"] = len(model.trees)
    return res


def train_forest(train: DataFrame, cols, seed: int = 42, **kw) -> PipelineModel:
    """M4: random forest, 100 trees of depth 4 (the selection base)."""
    return fit_pipeline(forest(seed, **kw), train, cols)


def importances(model) -> dict[str, float]:
    """Importance of every input column of a fitted tree model, by name."""
    if isinstance(model, BoostedModel):
        return model.importances()
    names = model.stages[0].getInputCols()
    return dict(zip(names, map(float, model.stages[-1].featureImportances.toArray())))
