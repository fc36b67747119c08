"""Named queries: one DataFrame per operator group, each over the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame; small
fitted statistics (minimum date, levels, medians) are computed by Spark
aggregates on the way and enter the returned plan as literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from responsekit.catalog import DATE_COL, DEFAULT_AS_OF_YEAR
from responsekit.functions.base import add_base_features
from responsekit.functions.dates import min_parsed_date, parse_mixed_date, tenure_season
from responsekit.session import materialize
from responsekit.sources.profile import customer_profile

QUERIES: dict = {}


def query(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_sig(x):
    """Round to 6 decimals, or to ~11 significant digits for large magnitudes,
    so results are compared at the precision a double actually carries."""
    a = F.abs(x)
    return (F.when(a >= 1e14, F.round(x, -3)).when(a >= 1e11, F.round(x, 0))
            .when(a >= 1e8, F.round(x, 3)).otherwise(F.round(x, 6)))


def rounded(df: DataFrame, cols=None) -> DataFrame:
    """Project ``cols`` (default all) with double columns rounded by ``round_sig``."""
    types = dict(df.dtypes)
    cols = cols or df.columns
    return df.select(*[round_sig(F.col(f"`{c}`")).alias(c) if types[c] in ("double", "float")
                       else F.col(f"`{c}`") for c in cols])


_PROFILES: dict = {}


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer profile, checkpointed once per session and input folder.

    Every fit (date minimum, levels, medians, scalers) then reads the small
    checkpointed table instead of re-joining lineitem/orders/part each time,
    and a lost executor recomputes from the checkpoint, not the raw tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PROFILES:
        _PROFILES[key] = materialize(customer_profile(spark, sf_dir))
    return _PROFILES[key]


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile plus all base features, statistics fitted on the table itself."""
    prof = profile(spark, sf_dir)
    return add_base_features(prof, min_parsed_date(prof), DEFAULT_AS_OF_YEAR)


def _feature_query(name, cols):
    @query(name)
    def q(spark, sf_dir):
        return rounded(base_table(spark, sf_dir), ["ID"] + cols)
    return q


@query("customer_profile")
def q_customer_profile(spark, sf_dir):
    return rounded(profile(spark, sf_dir))


@query("date_parse")
def q_date_parse(spark, sf_dir):
    p = profile(spark, sf_dir)
    return p.select("ID", DATE_COL, parse_mixed_date(F.col(DATE_COL)).alias("parsed_date"))


_feature_query("date_features", ["Dates", "Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear",
                                 "Dt_Quarter", "Dt_Is_Weekend", "Dt_Is_Month_Start", "Dt_Is_Month_End"])


@query("tenure_season")
def q_tenure_season(spark, sf_dir):
    b = base_table(spark, sf_dir)
    return b.select("ID", *[e.alias(n) for n, e in
                            tenure_season(F.col("Dt_Year"), F.col("Dt_Month"), DEFAULT_AS_OF_YEAR).items()])


_feature_query("age_features", ["Age", "Age_Group", "Age_Squared"])
_feature_query("household_features", ["Total_Children", "Has_Children", "Has_Kid", "Has_Teen", "Child_Ratio"])
_feature_query("purchase_features", ["Total_Purchases", "NumWebPurchases_Ratio", "NumCatalogPurchases_Ratio",
                                     "NumStorePurchases_Ratio", "NumDealsPurchases_Ratio",
                                     "Purchase_Channels_Used", "Web_Store_Ratio"])
@query("spending_features")
def q_spending_features(spark, sf_dir):
    b = base_table(spark, sf_dir)
    return rounded(b, ["ID", "Total_Spent", "MntWines_Ratio", "MntFruits_Ratio", "MntMeatProducts_Ratio",
                       "MntFishProducts_Ratio", "MntSweetProducts_Ratio", "MntGoldProds_Ratio",
                       "Spending_Categories_Used", "Avg_Spent_Per_Purchase", "Total_Spent_Squared"])
_feature_query("spending_logs", ["MntWines_Log", "MntFruits_Log", "MntMeatProducts_Log", "MntFishProducts_Log",
                                 "MntSweetProducts_Log", "MntGoldProds_Log"])
_feature_query("campaign_features", ["Campaign_Response_Rate", "Campaign_Response_Count", "Last_Campaign_Accepted",
                                     "Previous_Response_Rate"])
_feature_query("income_features", ["Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age",
                                   "Income_Spent_Ratio"])
_feature_query("recency_features", ["Recency_Squared", "Recency_Log", "Recency_Purchase_Ratio"])
_feature_query("web_features", ["NumWebVisitsMonth_Log", "Web_Conversion_Rate"])
_feature_query("interactions", ["Recency_X_Campaign", "Recency_X_WebPurchases", "Campaign_X_WebPurchases"])
_feature_query("edu_marital", ["Edu_Marital_Combined"])


# ---------------------------------------------------------------- encoding, fill, scaling, alignment (E*)
from responsekit.catalog import AGE_GROUP_LABELS, EDU_COL, ENGINEERED_COLS, MARITAL_COL, NUMERICAL_COLS  # noqa: E402
from responsekit.operators.align import align_columns, numeric_columns  # noqa: E402
from responsekit.operators.encode import fit_levels, onehot_capped, onehot_map_join  # noqa: E402
from responsekit.operators.scale import fit_scaler  # noqa: E402
from responsekit.plans.preprocess import fit_features, transform_features  # noqa: E402

FILLED_COLS = ["Income", "Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age", "Income_Spent_Ratio",
               "Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear", "Dt_Quarter"]


_FEATURE_MODELS: dict = {}


def filled_table(spark: SparkSession, sf_dir: str):
    """Preprocessed table (ID, numeric features, dummies, Target), fitted on itself.

    The fitted model is a handful of literals and deterministic for a given
    input, so it is kept per session and input folder and shared by queries.
    """
    prof = profile(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FEATURE_MODELS:
        _FEATURE_MODELS[key] = fit_features(prof)
    model = _FEATURE_MODELS[key]
    return transform_features(prof, model), model


@query("median_fill")
def q_median_fill(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(t.select("ID", *[F.col(c).cast("double").alias(c) for c in FILLED_COLS]))


@query("onehot_wide")
def q_onehot_wide(spark, sf_dir):
    t, m = filled_table(spark, sf_dir)
    return t.select("ID", *[F.col(f"`{c}`") for c in m.dummy_cols])


@query("onehot_capped")
def q_onehot_capped(spark, sf_dir):
    p = profile(spark, sf_dir)
    edu, mar = fit_levels(p, EDU_COL), fit_levels(p, MARITAL_COL)
    return p.select("ID", onehot_capped(EDU_COL, edu, 5).alias("Education_vec"),
                    onehot_capped(MARITAL_COL, mar, 6).alias("Marital_Status_vec"))


@query("onehot_map_join")
def q_onehot_map_join(spark, sf_dir):
    p = profile(spark, sf_dir).select("ID", MARITAL_COL)
    return onehot_map_join(p, MARITAL_COL, fit_levels(p, MARITAL_COL), out="Marital_Status_onehot")


@query("column_select")
def q_column_select(spark, sf_dir):
    b = base_table(spark, sf_dir)
    return rounded(b, ["ID"] + numeric_columns(b, exclude=["ID", "Target"]))


ALIGN_REFERENCE = (["Education_UNSEEN"] + list(reversed(NUMERICAL_COLS[:8]))
                   + ["Marital_Status_AFRICA", "Age_Group_60+", "Edu_Marital_UNSEEN_UNSEEN"])


@query("align_reference")
def q_align_reference(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(align_columns(t, ALIGN_REFERENCE, keep=["ID"]))


@query("standardise")
def q_standardise(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    cols = NUMERICAL_COLS[:10]
    sc = fit_scaler(t, cols)
    return rounded(t.select("ID", *[e.alias(f"{c}_z") for c, e in sc.columns(cols).items()]))


# ---------------------------------------------------------------- advanced features (A*)
from responsekit.catalog import EXTRA_LOG_INPUTS, PAIR_INPUTS, POLY_INPUTS  # noqa: E402
from responsekit.functions.advanced import (add_row_stats, euclidean, exp_decay, extra_logs,  # noqa: E402
                                            pair_differences, pair_ratios, poly_interactions)
from responsekit.operators.advanced import (advanced_inputs, covariance_long, fit_kmeans, fit_nonneg,  # noqa: E402
                                            fit_pca)


@query("poly_interactions")
def q_poly(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(t.select("ID", *[e.alias(n) for n, e in poly_interactions(POLY_INPUTS).items()]))


@query("centre_distances")
def q_centre_distances(spark, sf_dir):
    """A3 with centres that SQL can reproduce: the per-class means of the standardised inputs."""
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)[:10]
    sc = fit_scaler(t, cols)
    z = t.select("ID", "Target", *[e.alias(f"z_{c}") for c, e in sc.columns(cols).items()])
    zc = [f"z_{c}" for c in cols]
    rows = {r["Target"]: [r[c] for c in zc] for r in z.groupBy("Target").agg(*[F.avg(c).alias(c) for c in zc]).collect()}
    return rounded(z.select("ID", *[euclidean(zc, rows[k]).alias(f"Dist_{k}") for k in sorted(rows)]))


@query("covariance_long")
def q_covariance_long(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)[:15]
    sc = fit_scaler(t, cols)
    return rounded(covariance_long(t.select(*[e.alias(c) for c, e in sc.columns(cols).items()]), cols))


@query("pair_ratios")
def q_pair_ratios(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(t.select("ID", *[e.alias(n) for n, e in pair_ratios(PAIR_INPUTS).items()]))


@query("pair_differences")
def q_pair_differences(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(t.select("ID", *[e.alias(n) for n, e in pair_differences(PAIR_INPUTS).items()]))


def _with_pairs(t):
    cols = {}
    r, d = pair_ratios(PAIR_INPUTS), pair_differences(PAIR_INPUTS)
    for a, b in zip(r, d):
        cols[a], cols[b] = r[a], d[b]
    return t.withColumns(cols)


def _row_stats_query(name, token, prefix):
    @query(name)
    def q(spark, sf_dir):
        t, _ = filled_table(spark, sf_dir)
        t = _with_pairs(t)
        cols = [c for c in advanced_inputs(t) if token in c]
        t = add_row_stats(t, {prefix: cols})
        return rounded(t.select("ID", f"{prefix}_Mean", f"{prefix}_Std"))
    return q


_row_stats_query("purchase_stats", "Purchase", "Purchase")
_row_stats_query("spending_stats", "Mnt", "Spending")


@query("extra_logs")
def q_extra_logs(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    flags = fit_nonneg(t, EXTRA_LOG_INPUTS)
    return rounded(t.select("ID", *[e.alias(n) for n, e in extra_logs(flags).items()]))


@query("exp_decay")
def q_exp_decay(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    return rounded(t.select("ID", exp_decay("Recency").alias("Recency_Exp_Decay")))


@query("kmeans_features")
def q_kmeans(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    cm = fit_kmeans(t, advanced_inputs(t)[:10], k=2)
    out = cm.transform(t)
    return out.select("ID", "Cluster_2", "Cluster_2_Dist_0", "Cluster_2_Dist_1")


@query("pca_features")
def q_pca(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    pm = fit_pca(t, advanced_inputs(t)[:15], 3)
    return t.select("ID", *[e.alias(n) for n, e in pm.columns().items()])


# ---------------------------------------------------------------- sampling (B*) and evaluation (V*, M6, M10, P6, P7, S7)
from responsekit.models.ensemble import soft_vote  # noqa: E402
from responsekit.operators import evaluate as V  # noqa: E402
from responsekit.operators.sampling import (class_counts, class_weights, imbalance_ratio, is_imbalanced,  # noqa: E402
                                            kfold_assign, pos_weight, random_split, stratified_split,
                                            with_pos_weight)


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    return stratified_split(profile(spark, sf_dir).select("ID", "Target"), fraction=0.3, seed=42)


@query("random_split")
def q_random_split(spark, sf_dir):
    return random_split(profile(spark, sf_dir).select("ID"), fraction=0.2, seed=42)


@query("kfold_assign")
def q_kfold_assign(spark, sf_dir):
    return kfold_assign(profile(spark, sf_dir).select("ID", "Target"), k=5, seed=42)


@query("imbalance_ratio")
def q_imbalance_ratio(spark, sf_dir):
    counts = class_counts(profile(spark, sf_dir))
    row = (counts.get(0, 0), counts.get(1, 0), imbalance_ratio(counts), int(is_imbalanced(counts)))
    return rounded(spark.createDataFrame([row], "n_0 long, n_1 long, ratio double, imbalanced int"))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    p = profile(spark, sf_dir)
    counts = class_counts(p)
    bal, sq = class_weights(counts, "Balanced"), class_weights(counts, "SqrtBalanced")
    c = p.groupBy("Target").agg(F.count("*").alias("n"))
    wb, ws = F.lit(None).cast("double"), F.lit(None).cast("double")
    for y in counts:
        wb = F.when(F.col("Target") == y, F.lit(bal[y])).otherwise(wb)
        ws = F.when(F.col("Target") == y, F.lit(sq[y])).otherwise(ws)
    return rounded(c.select("Target", "n", wb.alias("w_balanced"), ws.alias("w_sqrt")))


@query("pos_weight")
def q_pos_weight(spark, sf_dir):
    p = profile(spark, sf_dir).select("ID", "Target")
    return rounded(with_pos_weight(p, pos_weight(class_counts(p))))


def scorecard_p(z):
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 6)


def scored(spark, sf_dir) -> DataFrame:
    """A deterministic scorecard over real features: metrics can be checked without a learned model."""
    b = base_table(spark, sf_dir)
    z = (F.lit(0.8) * F.col("Campaign_Response_Count") + F.lit(0.15) * F.col("NumWebPurchases")
         - F.lit(0.005) * F.col("Recency") - F.lit(1.0))
    p = scorecard_p(z)
    return b.select("ID", F.col("Target").alias("y"), p.alias("p")).withColumn(
        "pred", V.label_threshold(F.col("p"), 0.5))


@query("accuracy")
def q_accuracy(spark, sf_dir):
    return rounded(V.accuracy(scored(spark, sf_dir)))


@query("auc_exact")
def q_auc(spark, sf_dir):
    return rounded(V.auc_exact(scored(spark, sf_dir)))


@query("class_report")
def q_class_report(spark, sf_dir):
    return rounded(V.class_report(scored(spark, sf_dir)))


@query("confusion")
def q_confusion(spark, sf_dir):
    return V.confusion(scored(spark, sf_dir))


@query("f1_sweep")
def q_f1_sweep(spark, sf_dir):
    return rounded(V.f1_sweep(scored(spark, sf_dir)))


@query("accuracy_sweep")
def q_accuracy_sweep(spark, sf_dir):
    return rounded(V.accuracy_sweep(scored(spark, sf_dir)))


@query("log_loss")
def q_log_loss(spark, sf_dir):
    return rounded(V.log_loss(scored(spark, sf_dir)))


@query("label_threshold")
def q_label_threshold(spark, sf_dir):
    s = scored(spark, sf_dir)
    p = F.col("p")
    return s.select("ID", "p", V.label_threshold(p, 0.5).alias("pred_ge"), V.label_threshold(p, 0.5, True).alias("pred_gt"),
                    V.label_threshold(p, 0.35).alias("pred_stored"))


@query("soft_vote")
def q_soft_vote(spark, sf_dir):
    """M6: mean of three member probabilities, each a scorecard over different features."""
    b = base_table(spark, sf_dir)
    p1 = scorecard_p(F.lit(0.8) * F.col("Campaign_Response_Count") - F.lit(1.0))
    p2 = scorecard_p(F.lit(0.15) * F.col("NumWebPurchases") - F.lit(0.005) * F.col("Recency"))
    p3 = scorecard_p(F.lit(0.5) * F.col("Complain") + F.lit(0.1) * F.col("NumWebVisitsMonth") - F.lit(0.5))
    voted = soft_vote(b.select("ID", p1.alias("p1"), p2.alias("p2"), p3.alias("p3")), ["p1", "p2", "p3"], "p_vote")
    return rounded(voted.select("ID", "p_vote", V.label_threshold(F.col("p_vote"), 0.5).alias("pred")))


@query("class_distribution")
def q_class_distribution(spark, sf_dir):
    p = profile(spark, sf_dir)
    c = p.groupBy("Target").agg(F.count("*").alias("n"))
    tot = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return rounded(c.select("Target", "n", (F.col("n") * 100.0 / tot).alias("percent")))


@query("prediction_distribution")
def q_prediction_distribution(spark, sf_dir):
    s = scored(spark, sf_dir)
    c = s.groupBy("pred").agg(F.count("*").alias("n"))
    tot = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return rounded(c.select("pred", "n", (F.col("n") * 100.0 / tot).alias("percent")))


@query("validation_dump")
def q_validation_dump(spark, sf_dir):
    """(true_values, predicted_probabilities, predictions) for the validation rows."""
    s = scored(spark, sf_dir)
    v = stratified_split(s.withColumnRenamed("y", "Target"), fraction=0.3, seed=42).filter("is_valid = 1")
    return v.select("ID", F.col("Target").cast("int").alias("true_values"),
                    F.col("p").alias("predicted_probabilities"), F.col("pred").alias("predictions"))


# ---------------------------------------------------------------- SMOTE
from responsekit.operators.smote import knn_exact, smote  # noqa: E402


def minority_z(spark, sf_dir):
    """Standardised cluster inputs of every row (scaler fitted on all rows)."""
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)[:10]
    sc = fit_scaler(t, cols)
    z = t.select("ID", "Target", *[e.alias(f"z_{c}") for c, e in sc.columns(cols).items()])
    return z, [f"z_{c}" for c in cols]


@query("smote_neighbours")
def q_smote_neighbours(spark, sf_dir):
    z, zc = minority_z(spark, sf_dir)
    nb = knn_exact(z.filter("Target = 1"), zc, k=5)
    return rounded(nb.select("ID", F.col("nb_id").alias("neighbour_id"), "nb_rank", F.col("dist").alias("distance")))


@query("smote_rows")
def q_smote_rows(spark, sf_dir):
    z, zc = minority_z(spark, sf_dir)
    return rounded(smote(z, zc, label="Target", k=5, seed=42))


# ---------------------------------------------------------------- profiling (P*)
from responsekit.plans.preprocess import INPUT_COLUMNS  # noqa: E402


@query("profile_shape")
def q_profile_shape(spark, sf_dir):
    p = profile(spark, sf_dir)
    return p.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(p.columns)))


@query("profile_info")
def q_profile_info(spark, sf_dir):
    """Type and non-null count per column, unpivoted."""
    p = profile(spark, sf_dir)
    row = p.agg(*[F.count(F.col(c)).alias(c) for c in p.columns])
    items = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("type"),
                               F.col(c).alias("non_null")) for i, (c, t) in enumerate(p.dtypes)])
    return row.select(F.explode(items).alias("s")).select("s.*")


@query("profile_nunique")
def q_profile_nunique(spark, sf_dir):
    """Distinct non-null values per column via a long (column, value) distinct — no Expand per column."""
    p = profile(spark, sf_dir)
    kv = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in p.columns])
    return (p.select(F.explode(kv).alias("s")).select("s.column", "s.v").filter(F.col("v").isNotNull())
            .distinct().groupBy("column").agg(F.count("*").alias("n_distinct")))


@query("profile_head")
def q_profile_head(spark, sf_dir):
    """First rows by id (the limit is the feature)."""
    return rounded(profile(spark, sf_dir).orderBy("ID").limit(5))


@query("profile_distinct")
def q_profile_distinct(spark, sf_dir):
    """P5: distinct values of the two categorical columns."""
    p = profile(spark, sf_dir)
    return (p.select(F.lit("Education").alias("column"), F.col("Education").alias("value"))
            .unionByName(p.select(F.lit("Marital_Status").alias("column"), F.col("Marital_Status").alias("value")))
            .distinct())


@query("submission_agreement")
def q_submission_agreement(spark, sf_dir):
    """Pairwise agreement of three submissions, joined on ID (not by position)."""
    b = base_table(spark, sf_dir)
    subs = {
        "scorecard": V.label_threshold(scorecard_p(F.lit(0.8) * F.col("Campaign_Response_Count")
                                                   + F.lit(0.15) * F.col("NumWebPurchases")
                                                   - F.lit(0.005) * F.col("Recency") - F.lit(1.0)), 0.5),
        "campaign": (F.col("Campaign_Response_Count") > 0).cast("int"),
        "web": (F.col("NumWebPurchases") >= 3).cast("int"),
    }
    return rounded(V.submission_agreement({k: b.select("ID", e.alias("Target")) for k, e in subs.items()}))


# ---------------------------------------------------------------- correlation filter
from responsekit.operators.selection import correlated_to_drop, correlation_long  # noqa: E402


@query("corr_long")
def q_corr_long(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    rows = correlation_long(t, advanced_inputs(t))
    return rounded(spark.createDataFrame(rows, "col_a string, col_b string, abs_corr double"))


@query("corr_drop")
def q_corr_drop(spark, sf_dir):
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)
    return spark.createDataFrame([(c,) for c in correlated_to_drop(t, cols)], "dropped string")


# ---------------------------------------------------------------- flagship: response by segment
@query("segment_response")
def q_segment_response(spark, sf_dir):
    """Profile -> base features -> response rate, campaign rate and spend by segment."""
    b = base_table(spark, sf_dir)
    return rounded(b.groupBy("Education").agg(
        F.count("*").alias("customers"), F.sum("Target").alias("responders"),
        F.avg("Target").alias("response_rate"), F.avg("Campaign_Response_Rate").alias("avg_campaign_rate"),
        F.avg("Total_Spent").alias("avg_total_spent"), F.avg("Total_Purchases").alias("avg_purchases")))


# ---------------------------------------------------------------- learned operators (rows/schema checks)
import os  # noqa: E402
import uuid  # noqa: E402

from responsekit.models import boosted as B  # noqa: E402
from responsekit.models.ensemble import evaluate_stack, fit_all, leaderboard, train_stacked  # noqa: E402
from responsekit.models.mlp import fit_inputs, train_mlp  # noqa: E402
from responsekit.models.search import cross_validate, search_and_refit  # noqa: E402
from responsekit.operators.selection import importance_table, recursive_elimination  # noqa: E402
from responsekit.session import ensure_checkpoint_dir  # noqa: E402

_FITTED: dict = {}


def once(name, spark, sf_dir, make):
    """``make()``, kept for the session and input folder: queries over one fitted model share the fit."""
    key = (name, spark.sparkContext.applicationId, sf_dir)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def simple_model(spark, sf_dir):
    def make():
        tr, va, cols = train_valid(spark, sf_dir)
        return B.train_boosted(tr, va, cols, "simple", class_weight=None, tune_threshold=False)
    return once("simple", spark, sf_dir, make)


def stack_model(spark, sf_dir):
    def make():
        tr, _, cols = train_valid(spark, sf_dir)
        return train_stacked(tr, cols, cv=3)
    return once("stack", spark, sf_dir, make)


def train_valid(spark, sf_dir):
    """Preprocessed training and validation rows; statistics fitted on the training rows only."""
    return once("rows", spark, sf_dir, lambda: _train_valid(spark, sf_dir))


def _train_valid(spark, sf_dir):
    from responsekit.operators.sampling import split as _split
    prof = profile(spark, sf_dir)
    tr_raw, va_raw = _split(prof, "Target", 0.3, 42)
    fm = fit_features(tr_raw)
    tr = materialize(transform_features(tr_raw, fm))
    va = materialize(transform_features(va_raw, fm))
    cols = [c for c in tr.columns if c not in ("ID", "Target")]
    return tr, va, cols


def _scored_valid(model, va):
    s = B.probability(model, va, keep=("ID", "Target"))
    return rounded(s.select("ID", F.col("Target").alias("y"), "p", V.label_threshold(F.col("p"), 0.5).alias("pred")))


@query("gbt_train")
def q_gbt_train(spark, sf_dir):
    """M1: early-stopped, class-balanced GBT; validation rows scored with the F1-tuned threshold."""
    tr, va, cols = train_valid(spark, sf_dir)
    res = B.train_boosted(tr, va, cols, "catboost", class_weight="Balanced")
    s = B.probability(res.model, va, keep=("ID", "Target"))
    return rounded(s.select("ID", F.col("Target").alias("y"), "p",
                            V.label_threshold(F.col("p"), res.threshold, strict=True).alias("pred")))


@query("xgb_preset")
def q_xgb(spark, sf_dir):
    tr, va, cols = train_valid(spark, sf_dir)
    trw = with_pos_weight(tr, pos_weight(class_counts(tr)), out=B.WEIGHT)
    m = B.train_boosted(trw, va, cols, "xgboost", class_weight=None, tune_threshold=False, watch="auc", weight_col=B.WEIGHT).model
    return _scored_valid(m, va)


@query("simple_mode")
def q_simple(spark, sf_dir):
    _, va, _ = train_valid(spark, sf_dir)
    return _scored_valid(simple_model(spark, sf_dir).model, va)


@query("forest")
def q_forest(spark, sf_dir):
    tr, va, cols = train_valid(spark, sf_dir)
    return _scored_valid(B.train_forest(tr, cols), va)


@query("importance_topk")
def q_importance(spark, sf_dir):
    """Ranked forest importances; top 10."""
    tr, _, cols = train_valid(spark, sf_dir)
    imp = B.importances(B.train_forest(tr, cols))
    rows = importance_table(imp)
    return spark.createDataFrame(rows, "feature string, importance double, rank int").orderBy("rank").limit(10)


@query("rfe")
def q_rfe(spark, sf_dir):
    """C4: recursive elimination, 10 per round, down to 30 features."""
    tr, _, cols = train_valid(spark, sf_dir)
    kept = recursive_elimination(lambda cs: B.importances(B.train_forest(tr, cs)), cols, 30, 10)
    return spark.createDataFrame([(c, i) for i, c in enumerate(kept)], "feature string, position int")


@query("stacking")
def q_stacking(spark, sf_dir):
    """M5: stacked ensemble; validation rows with base and meta probabilities."""
    _, va, _ = train_valid(spark, sf_dir)
    m = stack_model(spark, sf_dir)
    s = m.predict(va, keep=("ID", "Target"))
    return rounded(s.withColumn("pred", V.label_threshold(F.col("p"), 0.5)))


@query("voting")
def q_voting(spark, sf_dir):
    """M6 over learned members: mean probability of a GBT and a forest, joined on ID."""
    tr, va, cols = train_valid(spark, sf_dir)
    g = B.probability(simple_model(spark, sf_dir).model, va).withColumnRenamed("p", "p_gbt")
    f = B.probability(B.train_forest(tr, cols), va).withColumnRenamed("p", "p_forest")
    return rounded(soft_vote(g.join(f, "ID"), ["p_gbt", "p_forest"]))


@query("leaderboard")
def q_leaderboard(spark, sf_dir):
    """M8: validation metrics of the stack and its bases; the best by accuracy is flagged."""
    _, va, _ = train_valid(spark, sf_dir)
    lb = leaderboard(spark, evaluate_stack(stack_model(spark, sf_dir), va))
    best = lb.agg(F.max_by("model", "accuracy").alias("best")).first()["best"]
    return rounded(lb.withColumn("is_best", (F.col("model") == best).cast("int")))


@query("mlp")
def q_mlp(spark, sf_dir):
    """M7: MLP over median-filled, scaled numerics and capped one-hot arrays."""
    from responsekit.operators.sampling import split as _split
    prof = profile(spark, sf_dir)
    tr_raw, va_raw = _split(prof, "Target", 0.2, 42)
    inputs = fit_inputs(tr_raw)
    m = train_mlp(tr_raw, inputs)
    out = m.transform(inputs.transform(va_raw))
    from pyspark.ml.functions import vector_to_array
    return rounded(out.select("ID", F.col("Target").alias("y"), vector_to_array("probability")[1].alias("p"),
                              F.col("prediction").cast("int").alias("pred")))


@query("search_trials")
def q_search(spark, sf_dir):
    """Seeded random search over the whole ranges, the reference's 20 trials; trials table."""
    tr, va, cols = train_valid(spark, sf_dir)
    root = os.path.join(ensure_checkpoint_dir(spark), f"search-{uuid.uuid4().hex}")
    trials, _, _ = search_and_refit(tr, va, cols, root, n_trials=20, space="catboost")
    return rounded(trials)


@query("cv_metrics")
def q_cv(spark, sf_dir):
    """5-fold stratified cross-validation, per-fold metrics."""
    return rounded(cross_validation(spark, sf_dir)[0])


def cross_validation(spark, sf_dir):
    """Fold metrics and out-of-fold table of one cross-validation."""
    tr, _, cols = train_valid(spark, sf_dir)
    return once("cv", spark, sf_dir, lambda: cross_validate(tr, cols, k=5))


@query("learning_curve")
def q_learning_curve(spark, sf_dir):
    """V8: log loss by iteration on training and validation rows until patience or the preset's rounds are used up;
    the best iteration is flagged."""
    curves = simple_model(spark, sf_dir).curves
    best = min(range(len(curves.test)), key=lambda k: (curves.test[k], k))
    rows = [(i, float(a), float(b), int(i == best)) for i, (a, b) in enumerate(zip(curves.learn, curves.test))]
    return rounded(spark.createDataFrame(rows, "iter int, learn_logloss double, test_logloss double, is_best int"))


def scratch(spark, name):
    """A new folder below the shared one."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@query("training_log")
def q_training_log(spark, sf_dir):
    """Learning curves of three folds written as TSV, one folder per fold, read back as one history."""
    from responsekit.models.search import cross_fit
    from responsekit.sources.files import training_history, write_training_log
    tr, _, cols = train_valid(spark, sf_dir)
    root = scratch(spark, "logs")
    for f, (fit, _) in cross_fit(materialize(kfold_assign(tr, k=3)), cols, 3).items():
        for kind, curve in (("learn_error", fit.curve.learn), ("test_error", fit.curve.test)):
            df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(curve)], "iter int, Logloss double")
            write_training_log(df, os.path.join(root, kind, f"fold-{f}"))
    return rounded(training_history(spark, learn=f"{root}/learn_error/*/*.csv", test=f"{root}/test_error/*/*.csv"))


def written_logs(spark, sf_dir):
    """Logs of five runs with headers that differ, their values counted from the customers: the root folder."""
    from responsekit.sources.files import write_training_log
    p = profile(spark, sf_dir).groupBy((F.col("ID") % 5).alias("run"), (F.col("Year_Birth") - 1940).cast("int").alias("iter")).agg(
        F.round(F.avg("Target"), 6).alias("AUC"), F.round(F.avg("Complain"), 6).alias("Accuracy"), F.round(F.avg("Recency") / 100, 6).alias("Logloss"),
        F.sum("NumWebPurchases").alias("Passed"), F.count("*").alias("Remaining"))
    p = materialize(p)
    root = scratch(spark, "logs")
    headers = {0: ["Accuracy", "Logloss"], 1: ["AUC", "Logloss"], 2: ["Logloss", "AUC"], 3: ["Logloss"], 4: ["Accuracy", "Logloss"]}
    jobs = {}
    for k, names in headers.items():
        folder = f"fold-{k}" if k < 3 else f"fold_{k}" if k < 4 else "single_model"
        for kind, cols in (("test_error", names), ("learn_error", ["Logloss"]), ("time_left", ["Passed", "Remaining"])):
            jobs[k, kind] = (lambda k=k, cols=cols, path=f"{root}/{kind}/{folder}":
                             write_training_log(p.where(F.col("run") == k).select("iter", *cols), path))
    fit_all(jobs)
    return root


@query("training_log_union")
def q_training_log_union(spark, sf_dir):
    """Logs of files with different headers, each read by its own."""
    from responsekit.sources.files import read_training_logs
    return rounded(read_training_logs(spark, f"{written_logs(spark, sf_dir)}/test_error/*/*.csv"))


@query("training_log_best")
def q_training_log_best(spark, sf_dir):
    """Learn, test and time logs joined by run and iteration; per run the best iterations, and the time
    passed and the learning loss at the one of least test loss."""
    from responsekit.sources.files import best_iterations, training_history
    root = written_logs(spark, sf_dir)
    h = materialize(training_history(spark, learn=f"{root}/learn_error/*/*.csv", test=f"{root}/test_error/*/*.csv", time=f"{root}/time_left/*/*.csv"))
    best = best_iterations(h, largest=["test_Accuracy", "test_AUC"], smallest=["test_Logloss"])
    at = h.select("run", F.col("iter").alias("best_test_Logloss"), "learn_Logloss", F.col("time_Passed").cast("long").alias("time_Passed"))
    return rounded(best.join(at, ["run", "best_test_Logloss"]))


@query("batch_score")
def q_batch_score(spark, sf_dir):
    """Train, save to the registry, load, score every customer, write and re-read ID,Target."""
    from responsekit.plans.predict import score
    from responsekit.sources.files import read_submission, write_submission
    root = model_folder(spark, sf_dir)

    def make():
        write_submission(score(spark, root, profile(spark, sf_dir).drop("Target")), os.path.join(root, "submission"))
        return os.path.join(root, "submission")
    return read_submission(spark, once("submission", spark, sf_dir, make))


def model_folder(spark, sf_dir):
    """Folder of a model of the end-to-end training, trained once a session."""
    from responsekit.plans.train import run_training

    def make():
        root = scratch(spark, "model")
        run_training(profile(spark, sf_dir), mode="simple", model_path=root)
        return root
    return once("model", spark, sf_dir, make)


@query("save_load")
def q_save_load(spark, sf_dir):
    """Probabilities before saving and after loading must be equal."""
    from responsekit.sources.model_store import load_model, save_model
    _, va, cols = train_valid(spark, sf_dir)
    m = simple_model(spark, sf_dir).model
    root = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    save_model(spark, root, m, 0.5, cols, "{}")
    m2, meta = load_model(spark, root)
    a = B.probability(m, va).withColumnRenamed("p", "p_before")
    b = B.probability(m2, va).withColumnRenamed("p", "p_after")
    return rounded(a.join(b, "ID").withColumn("equal", (F.col("p_before") == F.col("p_after")).cast("int")))


@query("kmeans_restarts")
def q_kmeans_restarts(spark, sf_dir):
    """A2 detail: centres of the lowest-cost fit among 10 restarts, in renumbered order."""
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)[:10]
    cm = fit_kmeans(t, cols, k=2, n_init=10)
    rows = [(i, c, float(v), cm.cost) for i, ctr in enumerate(cm.centres) for c, v in zip(cols, ctr)]
    return rounded(spark.createDataFrame(rows, "centre int, feature string, value double, training_cost double"))


# ---------------------------------------------------------------- submissions from files, sketches, vector form
@query("submission_files")
def q_submission_files(spark, sf_dir):
    """Fifteen submissions written as files, read back by one source, agreement of every pair."""
    from responsekit.sources.files import read_submissions, write_submission
    s, root = materialize(scored(spark, sf_dir).select("ID", "p")), scratch(spark, "submissions")
    fit_all({k: (lambda k=k: write_submission(s.select("ID", V.label_threshold(F.col("p"), (20 + 4 * k) / 100).alias("Target")),
                                              f"{root}/submission_{k:02d}")) for k in range(15)})
    return rounded(V.submission_matrix(read_submissions(spark, f"{root}/*/*.csv")))


def nunique_sketches(spark, sf_dir):
    from responsekit.operators.distinct import column_sketches
    p = profile(spark, sf_dir)
    return materialize(column_sketches(p, p.columns))


@query("profile_nunique_sketch")
def q_profile_nunique_sketch(spark, sf_dir):
    """P4 at scale: estimates from sketches stored per input part and merged."""
    from responsekit.operators.distinct import distinct_estimates
    return distinct_estimates(nunique_sketches(spark, sf_dir))


@query("profile_nunique_sketch_check")
def q_profile_nunique_sketch_check(spark, sf_dir):
    """Is each estimate within 3 % of the exact count?"""
    exact = q_profile_nunique(spark, sf_dir).withColumnRenamed("n_distinct", "exact")
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.03 * F.col("exact")
    return q_profile_nunique_sketch(spark, sf_dir).join(exact, "column").select("column", near.cast("int").alias("within"))


def vector_model(spark, sf_dir):
    """The three category columns in vector form and a logistic model over them, fitted on the training rows."""
    from pyspark.ml.classification import LogisticRegression
    from responsekit.operators.encode import with_known_levels
    from responsekit.operators.sampling import split as _split
    cats = [EDU_COL, MARITAL_COL, "Edu_Marital_Combined"]
    t = with_known_levels(base_table(spark, sf_dir), cats).fillna(0.0, ["Income"])
    tr, va = _split(t, "Target", 0.3, 42)
    model = B.fit_pipeline(LogisticRegression(labelCol=B.LABEL, regParam=0.1, maxIter=20), materialize(tr), ["Income", "Recency"], cats)
    return model, t, va, cats


@query("onehot_vector")
def q_onehot_vector(spark, sf_dir):
    """E1, vector form: the set positions of the sparse vectors, and their levels."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    from responsekit.operators.encode import vector_column
    model, t, _, cats = vector_model(spark, sf_dir)
    v = PipelineModel(model.stages[:2]).transform(t)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("level"), vector_to_array(vector_column(c)).alias("v")) for c in cats]))
    v = v.select("ID", each.alias("e")).select("ID", "e.column", "e.level", F.posexplode("e.v").alias("position", "value"))
    return v.where("value <> 0").select("ID", "column", "level", "position", F.col("value").cast("int").alias("value"))


# ---------------------------------------------------------------- results of learned operators that SQL can state
@query("save_load_check")
def q_save_load_check(spark, sf_dir):
    """Validation rows, and those scored alike before saving and after loading."""
    return q_save_load(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.sum("equal").alias("n_equal"))


@query("batch_score_check")
def q_batch_score_check(spark, sf_dir):
    """Customers, those scored once, and those with a 0/1 label after the CSV round trip."""
    s = q_batch_score(spark, sf_dir).groupBy("ID").agg(F.count("*").alias("n"), F.max("Target").alias("t"))
    once = F.count(F.when(F.col("n") == 1, 1))
    return s.agg(F.count("*").alias("n_ids"), once.alias("n_once"), F.count(F.when(F.col("t").isin(0, 1), 1)).alias("n_labelled"))


@query("kmeans_check")
def q_kmeans_check(spark, sf_dir):
    """A2: rows, and those whose label is that of the nearest centre."""
    k = q_kmeans(spark, sf_dir)
    near = F.when(F.col("Cluster_2_Dist_1") < F.col("Cluster_2_Dist_0"), 1).otherwise(0)
    return k.agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("Cluster_2") == near, 1)).alias("n_nearest"))


@query("pca_check")
def q_pca_check(spark, sf_dir):
    """A4: the components of the fitted rows have mean 0 and no correlation (rounded to 6 decimals)."""
    p = q_pca(spark, sf_dir)
    cells = [F.round(F.abs(F.avg(f"PCA_{i}")), 6).alias(f"mean_{i}") for i in (1, 2, 3)]
    cells += [F.round(F.abs(F.corr(f"PCA_{i}", f"PCA_{j}")), 6).alias(f"corr_{i}{j}") for i, j in ((1, 2), (1, 3), (2, 3))]
    return p.agg(F.count("*").alias("n_rows"), *cells)


@query("resampled_folds")
def q_resampled_folds(spark, sf_dir):
    """B6 and B4 as the stacked training runs them: all training columns, SMOTE to equal classes, then folds over
    real and synthetic rows; rows by (fold, Target, synthetic id) sizes."""
    from responsekit.operators.smote import oversample
    tr, _, cols = train_valid(spark, sf_dir)
    rows = materialize(oversample(tr, cols))
    folded = kfold_assign(rows, k=3)
    return folded.groupBy("fold", "Target").agg(F.count("*").alias("n"), F.count_distinct("ID").alias("n_ids"))


def train_minority_z(spark, sf_dir):
    """Standardised training rows with all training columns (scaler fitted on the training rows)."""
    tr, _, cols = train_valid(spark, sf_dir)
    sc = fit_scaler(tr, cols)
    z = tr.select("ID", "Target", *[e.alias(f"z_{c}") for c, e in sc.columns(cols).items()])
    return z, [f"z_{c}" for c in cols]


@query("smote_train_neighbours")
def q_smote_train_neighbours(spark, sf_dir):
    """The minority's neighbours among the training rows, over all training columns; exact up to 50,000 minority rows,
    above by random projection trees (the synthetic rows have exact ones at any size)."""
    from responsekit.operators.lsh import knn
    z, zc = train_minority_z(spark, sf_dir)
    nb = knn(z.filter("Target = 1"), zc, k=5)
    return rounded(nb.select("ID", F.col("nb_id").alias("neighbour_id"), "nb_rank", F.col("dist").alias("distance")))


@query("smote_train_rows")
def q_smote_train_rows(spark, sf_dir):
    """The synthetic rows of the training rows, over all training columns."""
    z, zc = train_minority_z(spark, sf_dir)
    return rounded(smote(z, zc, label="Target", k=5, seed=42))


@query("accuracy_gain")
def q_accuracy_gain(spark, sf_dir):
    """V6: best threshold of the accuracy sweep and its gain over 0.5."""
    return rounded(V.accuracy_gain(V.accuracy_sweep(scored(spark, sf_dir))))


@query("mlp_scaling")
def q_mlp_scaling(spark, sf_dir):
    """The MLP's inputs, median-filled and scaled by (x - mean) / (std + 1e-6)."""
    prof = profile(spark, sf_dir)
    return rounded(fit_inputs(prof).transform(prof).drop("cat", "Target"))


@query("customers_csv")
def q_customers_csv(spark, sf_dir):
    """The customer table written as CSV with a header and read with the declared schema."""
    from responsekit.sources.files import read_customers_csv
    path = os.path.join(ensure_checkpoint_dir(spark), f"customers-{uuid.uuid4().hex}")
    profile(spark, sf_dir).write.option("header", True).csv(path)
    return rounded(read_customers_csv(spark, path))


@query("feature_summary")
def q_feature_summary(spark, sf_dir):
    """Columns after each step of the feature build."""
    from responsekit.operators.selection import constant_columns
    tr, _, cols = train_valid(spark, sf_dir)
    dropped = set(correlated_to_drop(tr, cols))
    kept = [c for c in cols if c not in dropped]
    steps = [("input", len(profile(spark, sf_dir).columns) - 2), ("features", len(cols)),
             ("constant", len(constant_columns(tr, cols))), ("uncorrelated", len(kept))]
    return spark.createDataFrame([(k, n, c) for k, (n, c) in enumerate(steps)], "position int, step string, n_columns int")


@query("align_report")
def q_align_report(spark, sf_dir):
    """What alignment to the training columns does with each column of a scoring table."""
    from responsekit.operators.align import align_report
    p = profile(spark, sf_dir)
    wanted = [c for c in p.columns if c not in ("ID", "Income", "Target")] + ["Not_There"]
    return spark.createDataFrame(align_report(p, wanted, keep=("ID",)), "column string, action string")


# ---------------------------------------------------------------- more results of learned operators that SQL can state
def model_scores(spark, sf_dir, name):
    """The scores of a registered model query, kept for the session."""
    return once(f"scores-{name}", spark, sf_dir, lambda: materialize(QUERIES[name](spark, sf_dir)))


def _scores_check(name, label="y"):
    """Rows, different ids, rows with the customer's own label, probabilities, and labels that are 0 or 1."""
    @query(f"{name}_check")
    def q(spark, sf_dir):
        s = model_scores(spark, sf_dir, name)
        own = profile(spark, sf_dir).select("ID", F.col("Target").alias("own"))
        has_label, has_pred = label in s.columns, "pred" in s.columns
        s = s.join(own, "ID", "left")
        one = F.lit(1)
        return s.agg(F.count("*").alias("n_rows"), F.count_distinct("ID").alias("n_ids"),
                     F.count(F.when((F.col(label) if has_label else F.col("own")) == F.col("own"), one)).alias("n_own"),
                     F.count(F.when(F.col("p").between(0, 1), one)).alias("n_p"),
                     F.count(F.when(F.col("pred").isin(0, 1) if has_pred else F.lit(True), one)).alias("n_pred"))
    return q


for _name in ("gbt_train", "xgb_preset", "simple_mode", "forest", "voting", "mlp"):
    _scores_check(_name)
_scores_check("stacking", "Target")


@query("stack_folds_check")
def q_stack_folds_check(spark, sf_dir):
    """M5: rows and different ids by fold and class of the out-of-fold table, and those with a probability of every base."""
    m = stack_model(spark, sf_dir)
    all_p = F.lit(True)
    for n in m.names:
        all_p = all_p & F.col(f"p_{n}").between(0, 1)
    return m.out_of_fold.groupBy("fold", "Target").agg(F.count("*").alias("n"), F.count_distinct("ID").alias("n_ids"),
                                                       F.count(F.when(all_p, 1)).alias("n_scored"))


@query("stack_fold_metrics")
def q_stack_fold_metrics(spark, sf_dir):
    """Metrics of every fold and base, from the out-of-fold table of M5."""
    from responsekit.models.ensemble import fold_metrics
    m = stack_model(spark, sf_dir)
    return rounded(fold_metrics(m.out_of_fold, m.names))


@query("cv_metrics_check")
def q_cv_check(spark, sf_dir):
    """Size of each fold, its different ids, and whether its accuracy, AUC and log loss are those that the
    single-table metrics (V1, V2, V7) give for its rows."""
    metrics, table = cross_validation(spark, sf_dir)
    out = []
    for r in metrics.collect():  # a row per fold
        s = table.where(F.col("fold") == r["fold"]).select(F.col("Target").alias("y"), "p_model", "ID").withColumnRenamed("p_model", "p")
        want = B.validation_metrics(s.withColumnRenamed("y", "Target"))
        same = all(abs(want[k] - r[k]) < 1e-9 for k in ("accuracy", "auc", "log_loss"))
        out.append((r["fold"], r["n"], s.select("ID").distinct().count(), int(same)))
    return spark.createDataFrame(out, "fold int, n long, n_ids long, same_metrics int")


@query("leaderboard_check")
def q_leaderboard_check(spark, sf_dir):
    """M8: models, flagged ones, and whether the flagged one has the best accuracy."""
    lb = model_scores(spark, sf_dir, "leaderboard")
    top = F.max("accuracy") == F.max(F.when(F.col("is_best") == 1, F.col("accuracy")))
    return lb.agg(F.count_distinct("model").alias("n_models"), F.sum("is_best").cast("long").alias("n_best"), top.cast("int").alias("best_is_best"))


@query("search_trials_check")
def q_search_check(spark, sf_dir):
    """Trials, those that ran to their end, and those whose parameters lie in the ranges and whose trees in their budget."""
    from responsekit.models.search import SPACES
    t = model_scores(spark, sf_dir, "search_trials")
    kinds = "struct<" + ",".join(f"{k}:{'string' if v[0] == 'choice' else 'double'}" for k, v in SPACES["catboost"].items()) + ">"
    t = t.withColumn("q", F.from_json("params", kinds))
    inside = F.col("trees").between(1, F.col("q.maxIter"))
    for k, v in SPACES["catboost"].items():
        inside = inside & (F.col(f"q.{k}").isin(v[1]) if v[0] == "choice" else F.col(f"q.{k}").between(v[1], v[2]))
    return t.agg(F.count("*").alias("n_trials"), F.count(F.when(F.col("status") == "complete", 1)).alias("n_complete"), F.count(F.when(inside, 1)).alias("n_inside"))


@query("learning_curve_check")
def q_learning_curve_check(spark, sf_dir):
    """V8: rounds are numbered without gaps, one is flagged and has the least loss, and the curve goes on for the
    patience after it or to the end of the budget."""
    c = model_scores(spark, sf_dir, "learning_curve")
    r = c.agg(F.count("*").alias("n"), F.max("iter").alias("last"), F.sum("is_best").alias("flagged"), F.min("test_logloss").alias("least"),
              F.max(F.when(F.col("is_best") == 1, F.col("test_logloss"))).alias("at_best"), F.max(F.when(F.col("is_best") == 1, F.col("iter"))).alias("best"))
    full = (F.col("last") - F.col("best") >= B.PATIENCE) | (F.col("n") == B.PRESETS["simple"]["maxIter"])
    return r.select((F.col("last") + 1 == F.col("n")).cast("int").alias("no_gaps"), F.col("flagged").cast("int").alias("n_best"),
                    (F.col("least") == F.col("at_best")).cast("int").alias("is_least"), full.cast("int").alias("runs_on"))


@query("selection_check")
def q_selection_check(spark, sf_dir):
    """Ranked importances are in order and among the training columns; elimination keeps as many as asked."""
    _, _, cols = train_valid(spark, sf_dir)
    top, kept = q_importance(spark, sf_dir).orderBy("rank").collect(), q_rfe(spark, sf_dir).collect()
    ordered = all(a["importance"] >= b["importance"] for a, b in zip(top, top[1:])) and [r["rank"] for r in top] == list(range(1, len(top) + 1))
    row = (len(top), int(ordered), sum(r["feature"] in cols for r in top), len({r["feature"] for r in kept} & set(cols)))
    return spark.createDataFrame([row], "n_top int, in_order int, n_known int, n_kept int")


@query("selection_propagation")
def q_selection_propagation(spark, sf_dir):
    """The stored list of a trained model is after the correlation filter, at most 50 long, and scoring reads just these."""
    from responsekit.plans.predict import features_for_scoring
    from responsekit.sources.model_store import load_model
    _, meta = load_model(spark, model_folder(spark, sf_dir))
    x = features_for_scoring(profile(spark, sf_dir), meta)
    tr, _, _ = train_valid(spark, sf_dir)
    dropped = set(correlated_to_drop(tr, [c for c in meta["features"] if c in tr.columns]))
    row = (int(x.columns == ["ID", *meta["features"]]), int(0 < len(meta["features"]) <= 50), len(dropped), x.count())
    return spark.createDataFrame([row], "same_columns int, capped int, n_correlated int, n_rows long")


@query("pca_variance_check")
def q_pca_variance_check(spark, sf_dir):
    """A5: the variance ratios are the components' own variances over those of all scaled inputs."""
    t, _ = filled_table(spark, sf_dir)
    cols = advanced_inputs(t)[:15]
    m = fit_pca(t, cols, 3)
    z, pcs = m.scaler.columns(cols), m.columns()
    row = t.agg(sum(F.coalesce(F.variance(e), F.lit(0.0)) for e in z.values()).alias("all"),
                *[F.variance(pcs[f"PCA_{k + 1}"]).alias(f"v{k}") for k in range(3)]).first()
    same = sum(abs(row[f"v{k}"] / row["all"] - r) < 1e-6 for k, r in enumerate(m.variance_ratio))
    return spark.createDataFrame([(len(m.variance_ratio), same)], "n_components int, n_same int")
