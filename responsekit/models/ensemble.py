"""Stacked ensemble (M5), soft voting (M6) and the leaderboard (M8).

Stacking builds out-of-fold probabilities with one fit per fold and base
(folds from ``kfold_assign``), each fold scored by its models in one
projection, fits a logistic meta-learner on the base probabilities, then
fits every base on all training rows. The fits are a bounded number and run
side by side; the boosted ones read one binned table in which a fold is held
out. Metrics per fold and base (M13) come from the same out-of-fold table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import ID_COL, TARGET_COL
from responsekit.models.boosted import LABEL, booster_params, fit_pipeline, forest, validation_metrics
from responsekit.models.histboost import BoostedModel, Booster, Params, Prepared, fit_jobs, prepare
from responsekit.operators import evaluate as V
from responsekit.operators.sampling import kfold_assign
from responsekit.session import discard, materialize


def base_learners(max_iter: int | None = None, seed: int = 42) -> dict:
    """Three bases: boosted (depth 6), boosted (rows and columns drawn), random forest. Boosted ones are their
    parameters, others estimators."""
    return {
        "gbt_a": booster_params("stack_gbt_a", max_iter, seed),
        "gbt_b": booster_params("stack_gbt_b", max_iter, seed),
        "forest": forest(seed, numTrees=100, maxDepth=6),
    }


def fit_bases(learners: dict, data: Prepared, folded: DataFrame, cols, folds) -> dict:
    """(fold, name) -> base fitted on all rows but those of the fold (None: on all), side by side."""
    each = [(f, n) for f in folds for n in learners]
    boosted = {(f, n): Booster(data, learners[n], held_out=f) for f, n in each if isinstance(learners[n], Params)}

    def other(f, n):
        return {(f, n): fit_pipeline(learners[n].copy(), folded if f is None else folded.filter(F.col("fold") != f), cols)}

    jobs = {**fit_jobs(boosted), **{(f, n): (lambda f=f, n=n: other(f, n)) for f, n in each if (f, n) not in boosted}}
    found = {k: v for part in fit_all(jobs).values() for k, v in part.items()}
    return {k: found[k][0].model() if k in boosted else found[k] for k in each}


@dataclass
class StackModel:
    bases: dict        # name -> model fitted on all training rows
    meta: object       # LogisticRegressionModel over the base probabilities
    names: list
    out_of_fold: DataFrame | None = None  # the table the meta-learner was fitted on

    def predict(self, df: DataFrame, keep=(ID_COL,)) -> DataFrame:
        keep = [c for c in keep if c in df.columns]
        cols = [f"p_{n}" for n in self.names]
        cur = base_probabilities({n: self.bases[n] for n in self.names}, df, keep)
        meta_in = VectorAssembler(inputCols=cols, outputCol="meta_features").transform(cur)
        out = self.meta.transform(meta_in)
        return out.select(*keep, *cols, vector_to_array(F.col("probability"))[1].alias("p"))


def fit_all(jobs: dict, at_once: int = 16) -> dict:
    """Run independent fits side by side; Spark schedules their jobs together."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(jobs, pool.map(lambda job: job(), jobs.values())))


def base_probabilities(bases: dict, df: DataFrame, keep) -> DataFrame:
    """``keep`` and one probability column per base model, in one projection."""
    cur = df
    for n, model in bases.items():
        if isinstance(model, BoostedModel):
            cur = cur.withColumn(f"p_{n}", model.p())
            continue
        cur = model.transform(cur).withColumn(f"p_{n}", vector_to_array(F.col("probability"))[1]) \
            .drop("features", "rawPrediction", "probability", "prediction", LABEL)
    return cur.select(*keep, *[f"p_{n}" for n in bases])


def out_of_fold(folded: DataFrame, models: dict, names, k: int, label: str = TARGET_COL) -> DataFrame:
    """(ID, fold, label, p_<base>...) for every row, predicted by the models (fold, base) that did not see its fold.

    All bases share the folds, so a fold is scored by its models in one projection: no join."""
    out = None
    for f in range(k):
        part = base_probabilities({n: models[f, n] for n in names}, folded.filter(F.col("fold") == f), (ID_COL, "fold", label))
        out = part if out is None else out.unionByName(part)
    return out


def fold_metrics(table: DataFrame, names, label: str = TARGET_COL) -> DataFrame:
    """(fold, model, n, accuracy, auc, log_loss) of every base in an out-of-fold table, in one grouped pass."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"p_{n}").alias("p")) for n in names]))
    rows = table.select("fold", F.col(label).alias("y"), each.alias("s")).select("fold", "y", "s.*")
    rows = rows.withColumn("of", F.struct("fold", "model"))
    right = (F.col("p") > 0.5).cast("int") == F.col("y")
    p = F.least(F.greatest(F.col("p"), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -F.when(F.col("y") == 1, F.log(p)).otherwise(F.log(1 - p))
    sums = rows.groupBy("of").agg(F.count("*").alias("n"), F.avg(right.cast("double")).alias("accuracy"), F.avg(loss).alias("log_loss"))
    return sums.join(V.auc_by_group(rows, "of"), "of").select("of.fold", "of.model", "n", "accuracy", "auc", "log_loss")


def train_stacked(train: DataFrame, cols, cv: int = 3, max_iter: int | None = None, seed: int = 42,
                  label: str = TARGET_COL, meta_c: float = 1.0, meta_iter: int = 500) -> StackModel:
    folded = materialize(kfold_assign(train, k=cv, label=label, seed=seed))
    learners = base_learners(max_iter, seed)
    names = list(learners)
    data = prepare(folded, list(cols), label, ID_COL, max(x.bins for x in learners.values() if isinstance(x, Params)), fold="fold")
    fits = fit_bases(learners, data, folded, cols, [*range(cv), None])
    discard(data.table)
    table = materialize(out_of_fold(folded, fits, names, cv, label).withColumn(LABEL, F.col(label).cast("double")))
    n_rows = table.count()
    meta_in = VectorAssembler(inputCols=[f"p_{n}" for n in names], outputCol="meta_features").transform(table)
    # scikit-learn's C penalises the summed loss; Spark's regParam the mean loss.
    lr = LogisticRegression(featuresCol="meta_features", labelCol=LABEL, maxIter=meta_iter,
                            regParam=1.0 / (meta_c * max(n_rows, 1)), elasticNetParam=0.0, standardization=False)
    meta = lr.fit(meta_in)
    return StackModel({n: fits[None, n] for n in names}, meta, names, table)


def soft_vote(scored: DataFrame, prob_cols, out: str = "p") -> DataFrame:
    """M6: mean of member probabilities (columns already joined on the id)."""
    s = sum((F.col(c) for c in prob_cols[1:]), F.col(prob_cols[0]))
    return scored.withColumn(out, s / F.lit(float(len(prob_cols))))


def leaderboard(spark, results: dict) -> DataFrame:
    """M8: (model, accuracy, auc, log_loss) from per-model validation metrics; best = max accuracy."""
    rows = [(k, float(v.get("accuracy") or 0.0), float(v.get("auc") or 0.0), float(v.get("log_loss") or 0.0))
            for k, v in results.items()]
    return spark.createDataFrame(rows, "model string, accuracy double, auc double, log_loss double")


def evaluate_stack(model: StackModel, valid: DataFrame, label: str = TARGET_COL) -> dict:
    s = model.predict(valid, keep=(ID_COL, label))
    out = {"stacked": validation_metrics(s, label)}
    for n in model.names:
        out[n] = validation_metrics(s.select(label, F.col(f"p_{n}").alias("p")), label)
    return out
