"""Fitted advanced features: k-means (A2, A3), PCA (A4, A5), covariance (A6),
non-negativity flags for the extra logs (A11), and the whole advanced step.

Every fit is a distributed Spark job returning a handful of literals
(centres, loadings, flags); the transform is a projection over them.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.catalog import (DEFAULT_AS_OF_YEAR, EXTRA_LOG_INPUTS, ID_COL, PAIR_INPUTS, POLY_INPUTS,
                                 TARGET_COL)
from responsekit.functions.advanced import (add_row_stats, euclidean_sql, exp_decay, extra_logs, pair_differences,
                                            pair_ratios, poly_interactions)
from responsekit.functions.dates import tenure_season
from responsekit.operators.align import numeric_columns
from responsekit.operators.scale import ScalerModel, fit_scaler

N_CLUSTER_INPUTS = 10
N_PCA_INPUTS = 15


def advanced_inputs(df: DataFrame) -> list[str]:
    """Numeric feature columns in order (dummies and id/label excluded), as the reference sees them."""
    return [c for c in numeric_columns(df, exclude=[ID_COL, TARGET_COL])
            if not c.startswith(("Education_", "Marital_Status_", "Age_Group_", "Edu_Marital_"))]


# ---------------------------------------------------------------- k-means
@dataclass
class ClusterModel:
    k: int
    cols: list[str]
    scaler: ScalerModel
    centres: list[list[float]]   # renumbered: sorted lexicographically
    cost: float

    def columns(self) -> dict:
        z = self.scaler.columns(self.cols)
        tmp = {f"__z_{c}": e for c, e in z.items()}
        return tmp

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``Cluster_{k}`` then ``Cluster_{k}_Dist_{i}`` (label first, as the reference orders them)."""
        zcols = [f"__z_{c}" for c in self.cols]
        df = df.withColumns(self.columns())
        dists = [euclidean_sql(zcols, ctr) for ctr in self.centres]
        if self.k > 1:
            # first centre wins ties, like argmin
            best = "least(" + ", ".join(dists) + ")"
            label = "CASE " + " ".join(f"WHEN {dd} = {best} THEN {i}" for i, dd in enumerate(dists)) + " END"
        else:
            label = "0"
        out = {f"Cluster_{self.k}": F.expr(f"CAST({label} AS BIGINT)")}
        out.update({f"Cluster_{self.k}_Dist_{i}": F.expr(dd) for i, dd in enumerate(dists)})
        return df.withColumns(out).drop(*zcols)


def fit_kmeans(df: DataFrame, cols, k: int, seed: int = 42, n_init: int = 10, max_iter: int = 300,
               tol: float = 1e-4, parallelism: int = 10) -> ClusterModel:
    """A2: standardise ``cols``, fit k-means ``n_init`` times, keep the lowest cost."""
    scaler = fit_scaler(df, cols)
    z = df.select(*[F.coalesce(e, F.lit(0.0)).alias(f"z{i}") for i, e in enumerate(scaler.columns(cols).values())])
    vec = VectorAssembler(inputCols=[f"z{i}" for i in range(len(cols))], outputCol="features").transform(z).select("features").cache()
    def one(r):
        m = KMeans(k=k, seed=seed + r, maxIter=max_iter, tol=tol, featuresCol="features").fit(vec)
        return m.summary.trainingCost, r, [list(map(float, c)) for c in m.clusterCenters()]
    try:
        # restarts are independent Spark jobs: submit them concurrently (the
        # scheduler interleaves their tasks), keep the lowest cost, first wins ties
        with ThreadPoolExecutor(max_workers=min(parallelism, n_init)) as pool:
            fits = list(pool.map(one, range(n_init)))
    finally:
        vec.unpersist()
    cost, _, cs = min(fits, key=lambda f: (f[0], f[1]))
    best = (cost, cs)
    centres = sorted(best[1])
    return ClusterModel(k, list(cols), scaler, centres, float(best[0]))


# ---------------------------------------------------------------- PCA
@dataclass
class PCAFeatureModel:
    cols: list[str]
    scaler: ScalerModel
    loadings: list[list[float]]   # n_components x n_cols, sign-fixed
    variance_ratio: list[float]

    def columns(self) -> dict:
        z = list(self.scaler.columns(self.cols).values())
        out = {}
        for j, row in enumerate(self.loadings):
            terms = [zc * F.lit(float(w)) for zc, w in zip(z, row)]
            out[f"PCA_{j + 1}"] = sum(terms[1:], terms[0])
        out["PCA_Variance_Ratio"] = F.lit(float(sum(self.variance_ratio)))
        return out


def fit_pca(df: DataFrame, cols, n_components: int = 3) -> PCAFeatureModel:
    """A4/A5: own scaler over ``cols``, Spark ``PCA`` on the standardised vectors."""
    scaler = fit_scaler(df, cols)
    z = df.select(*[F.coalesce(e, F.lit(0.0)).alias(f"z{i}") for i, e in enumerate(scaler.columns(cols).values())])
    vec = VectorAssembler(inputCols=[f"z{i}" for i in range(len(cols))], outputCol="features").transform(z)
    m = PCA(k=n_components, inputCol="features", outputCol="pca").fit(vec)
    pc = m.pc.toArray().T  # components x features
    fixed = []
    for row in pc:
        if row[int(np.argmax(np.abs(row)))] < 0:
            row = -row
        fixed.append([float(x) for x in row])
    return PCAFeatureModel(list(cols), scaler, fixed, [float(x) for x in m.explainedVariance.toArray()])


# ---------------------------------------------------------------- covariance
def covariance_long(df: DataFrame, cols) -> DataFrame:
    """Sample covariance of every pair (i <= j), long form, in one aggregate pass."""
    pairs_ = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.covar_samp(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias(f"c{i}")
                   for i, (a, b) in enumerate(pairs_)])
    stack = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                         F.col(f"c{i}").alias("covariance")) for i, (a, b) in enumerate(pairs_)]))
    return row.select(stack.alias("s")).select("s.col_a", "s.col_b", "s.covariance")


# ---------------------------------------------------------------- extra logs
def fit_nonneg(df: DataFrame, cols) -> dict[str, bool]:
    """A11 condition: the whole training column is >= 0."""
    cols = [c for c in cols if c in df.columns]
    row = df.agg(*[F.min(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"] is not None and row[f"m{i}"] >= 0) for i, c in enumerate(cols)}


# ---------------------------------------------------------------- whole step
@dataclass
class AdvancedModel:
    as_of_year: int = DEFAULT_AS_OF_YEAR
    cluster_models: list = field(default_factory=list)
    pca: PCAFeatureModel | None = None
    nonneg: dict = field(default_factory=dict)
    poly_cols: list = field(default_factory=list)
    pair_cols: list = field(default_factory=list)


def fit_advanced(df: DataFrame, cluster_count: int = 2, add_pca: bool = True, n_components: int = 3,
                 as_of_year: int = DEFAULT_AS_OF_YEAR, n_init: int = 10) -> AdvancedModel:
    """Fit the advanced step on (filled) training features."""
    num = advanced_inputs(df)
    model = AdvancedModel(as_of_year=as_of_year)
    model.poly_cols = [c for c in POLY_INPUTS if c in num][:5]
    model.pair_cols = [c for c in PAIR_INPUTS if c in df.columns][:4]
    ccols = num[:min(N_CLUSTER_INPUTS, len(num))]
    model.cluster_models = [fit_kmeans(df, ccols, k, n_init=n_init) for k in range(2, cluster_count + 1)]
    if add_pca and len(num) > n_components:
        model.pca = fit_pca(df, num[:min(N_PCA_INPUTS, len(num))], n_components)
    model.nonneg = fit_nonneg(df, [c for c in EXTRA_LOG_INPUTS if c in num])
    return model


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.IntegerType, T.LongType, T.DoubleType, T.FloatType))


def transform_advanced(df: DataFrame, model: AdvancedModel) -> DataFrame:
    """Apply the advanced step; column order follows the reference's creation order."""
    if model.poly_cols:
        df = df.withColumns(poly_interactions(model.poly_cols))
    for cm in model.cluster_models:
        df = cm.transform(df)
    if model.pca is not None:
        df = df.withColumns(model.pca.columns())
    if len(model.pair_cols) >= 2:
        r, d = pair_ratios(model.pair_cols), pair_differences(model.pair_cols)
        both = {}
        for (a, b) in zip(r, d):
            both[a] = r[a]
            both[b] = d[b]
        df = df.withColumns(both)
    purchase = [c for c in df.columns if "Purchase" in c and _is_numeric(df, c) and c != TARGET_COL]
    spending = [c for c in df.columns if "Mnt" in c and _is_numeric(df, c)]
    groups = {}
    if purchase:
        groups["Purchase"] = purchase
    if spending:
        groups["Spending"] = spending
    if groups:
        df = add_row_stats(df, groups)
    if "Dt_Year" in df.columns and "Dt_Month" in df.columns:
        df = df.withColumns(tenure_season(F.col("Dt_Year"), F.col("Dt_Month"), model.as_of_year))
    df = df.withColumns(extra_logs(model.nonneg))
    if "Recency" in model.nonneg:
        df = df.withColumn("Recency_Exp_Decay", exp_decay("Recency"))
    if TARGET_COL in df.columns and df.columns[-1] != TARGET_COL:  # keep the label last
        df = df.withColumnRenamed(TARGET_COL, "__label").withColumn(TARGET_COL, F.col("__label")).drop("__label")
    return df
