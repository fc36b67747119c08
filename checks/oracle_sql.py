"""DuckDB oracle SQL per query name (keys match ``responsekit.plans.registry``)."""

from __future__ import annotations

from checks.profile_sql import FEATURES_CTE, PROFILE_CTE, select_rounded

SQL: dict[str, str] = {}


def with_profile(body: str, more_ctes: str = "") -> str:
    return f"WITH {PROFILE_CTE}{more_ctes} {body}"


def with_features(body: str, more_ctes: str = "") -> str:
    return f"WITH {FEATURES_CTE}{more_ctes} {body}"


PROFILE_DOUBLES = ["Income", "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
                   "MntGoldProds"]
PROFILE_COLS = ["ID", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome", "Dt_Customer",
                "Recency", "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts",
                "MntGoldProds", "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
                "NumWebVisitsMonth", "AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4",
                "AcceptedCmp5", "Complain", "Target"]

SQL["customer_profile"] = with_profile(select_rounded(PROFILE_COLS, "profile", PROFILE_DOUBLES))
SQL["date_parse"] = with_features("SELECT ID, Dt_Customer, dt AS parsed_date FROM parsed")


def feature_sql(cols, doubles):
    return with_features(select_rounded(["ID"] + cols, "feat", doubles))


SQL["date_features"] = feature_sql(["Dates", "Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear",
                                    "Dt_Quarter", "Dt_Is_Weekend", "Dt_Is_Month_Start", "Dt_Is_Month_End"], [])
SQL["tenure_season"] = with_features("""
SELECT ID, 2025 - Dt_Year AS Customer_Since_Years,
  CAST(coalesce(2025 - Dt_Year <= 1, false) AS BIGINT) AS Is_Recent_Customer,
  CAST(coalesce(Dt_Month IN (12, 1, 2), false) AS BIGINT) AS Is_Season_Winter,
  CAST(coalesce(Dt_Month BETWEEN 6 AND 8, false) AS BIGINT) AS Is_Season_Summer
FROM feat""")
SQL["age_features"] = feature_sql(["Age", "Age_Group", "Age_Squared"], [])
SQL["household_features"] = feature_sql(["Total_Children", "Has_Children", "Has_Kid", "Has_Teen", "Child_Ratio"],
                                        ["Child_Ratio"])
_p = ["NumWebPurchases_Ratio", "NumCatalogPurchases_Ratio", "NumStorePurchases_Ratio", "NumDealsPurchases_Ratio",
      "Web_Store_Ratio"]
SQL["purchase_features"] = feature_sql(["Total_Purchases", "Purchase_Channels_Used"] + _p, _p)
_s = ["Total_Spent", "MntWines_Ratio", "MntFruits_Ratio", "MntMeatProducts_Ratio", "MntFishProducts_Ratio",
      "MntSweetProducts_Ratio", "MntGoldProds_Ratio", "Avg_Spent_Per_Purchase", "Total_Spent_Squared"]
SQL["spending_features"] = feature_sql(["Spending_Categories_Used"] + _s, _s)
_l = ["MntWines_Log", "MntFruits_Log", "MntMeatProducts_Log", "MntFishProducts_Log", "MntSweetProducts_Log",
      "MntGoldProds_Log"]
SQL["spending_logs"] = feature_sql(_l, _l)
SQL["campaign_features"] = feature_sql(["Campaign_Response_Rate", "Campaign_Response_Count", "Last_Campaign_Accepted",
                                        "Previous_Response_Rate"], ["Campaign_Response_Rate", "Previous_Response_Rate"])
_i = ["Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age", "Income_Spent_Ratio"]
SQL["income_features"] = feature_sql(_i, _i)
SQL["recency_features"] = feature_sql(["Recency_Squared", "Recency_Log", "Recency_Purchase_Ratio"],
                                      ["Recency_Log", "Recency_Purchase_Ratio"])
SQL["web_features"] = feature_sql(["NumWebVisitsMonth_Log", "Web_Conversion_Rate"],
                                  ["NumWebVisitsMonth_Log", "Web_Conversion_Rate"])
SQL["interactions"] = feature_sql(["Recency_X_Campaign", "Recency_X_WebPurchases", "Campaign_X_WebPurchases"],
                                  ["Recency_X_Campaign", "Campaign_X_WebPurchases"])
SQL["edu_marital"] = feature_sql(["Edu_Marital_Combined"], [])


# ---------------------------------------------------------------- E*: encoding, fill, scaling, alignment
# --- Fixed values: the category levels present in the driver data (TPC-H segments and regions).
EDU_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
MARITAL_LEVELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
AGE_LABELS = ["<30", "30-40", "40-50", "50-60", "60+"]
NUMERICAL = ["Year_Birth", "Income", "Kidhome", "Teenhome", "Dates", "Recency", "MntWines", "MntFruits",
             "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds", "NumWebPurchases",
             "NumCatalogPurchases", "NumStorePurchases", "NumDealsPurchases", "NumWebVisitsMonth", "AcceptedCmp1",
             "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "Complain"]
ENGINEERED = ["Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear", "Dt_Quarter", "Dt_Is_Weekend",
              "Dt_Is_Month_Start", "Dt_Is_Month_End", "Age", "Age_Squared", "Total_Children", "Has_Children",
              "Has_Kid", "Has_Teen", "Child_Ratio", "Total_Purchases", "NumWebPurchases_Ratio",
              "NumCatalogPurchases_Ratio", "NumStorePurchases_Ratio", "NumDealsPurchases_Ratio",
              "Purchase_Channels_Used", "Web_Store_Ratio", "Total_Spent", "MntWines_Ratio", "MntFruits_Ratio",
              "MntMeatProducts_Ratio", "MntFishProducts_Ratio", "MntSweetProducts_Ratio", "MntGoldProds_Ratio",
              "Spending_Categories_Used", "Avg_Spent_Per_Purchase", "MntWines_Log", "MntFruits_Log",
              "MntMeatProducts_Log", "MntFishProducts_Log", "MntSweetProducts_Log", "MntGoldProds_Log",
              "Total_Spent_Squared", "Campaign_Response_Rate", "Campaign_Response_Count", "Last_Campaign_Accepted",
              "Previous_Response_Rate", "Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age",
              "Income_Spent_Ratio", "Recency_Squared", "Recency_Log", "Recency_Purchase_Ratio",
              "NumWebVisitsMonth_Log", "Web_Conversion_Rate", "Recency_X_Campaign", "Recency_X_WebPurchases",
              "Campaign_X_WebPurchases"]
FILLED = ["Income", "Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age", "Income_Spent_Ratio",
          "Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear", "Dt_Quarter"]
# --- end of fixed values

FILLED_CTE = (",\nmed AS (SELECT " + ", ".join(f'median("{c}") AS "{c}"' for c in FILLED) + " FROM feat),\n"
              "filled AS (SELECT f.* REPLACE (" + ", ".join(f'coalesce(f."{c}", med."{c}") AS "{c}"' for c in FILLED)
              + ") FROM feat f CROSS JOIN med)")


def with_filled(body: str, more: str = "") -> str:
    return with_features(body, FILLED_CTE + more)


def q(name):
    return f'"{name}"'


SQL["median_fill"] = with_filled(
    "SELECT ID, " + ", ".join(f'round(CAST("{c}" AS DOUBLE), 6) AS "{c}"' for c in FILLED) + " FROM filled")


def _dummies():
    items = [f"CAST(Education = '{v}' AS BIGINT) AS \"Education_{v}\"" for v in EDU_LEVELS]
    items += [f"CAST(Marital_Status = '{v}' AS BIGINT) AS \"Marital_Status_{v}\"" for v in MARITAL_LEVELS]
    items += [f"CAST(Age_Group = '{v}' AS BIGINT) AS \"Age_Group_{v}\"" for v in AGE_LABELS]
    items += [f"CAST(Edu_Marital_Combined = '{e}_{m}' AS BIGINT) AS \"Edu_Marital_{e}_{m}\""
              for e in EDU_LEVELS for m in MARITAL_LEVELS]
    return items


SQL["onehot_wide"] = with_features("SELECT ID, " + ", ".join(_dummies()) + " FROM feat")
SQL["onehot_capped"] = with_profile(
    "SELECT ID, [" + ", ".join(f"CAST(Education = '{v}' AS INTEGER)" for v in EDU_LEVELS) + "] AS Education_vec, ["
    + ", ".join(f"CAST(Marital_Status = '{v}' AS INTEGER)" for v in MARITAL_LEVELS) + ", 0] AS Marital_Status_vec "
    "FROM profile")
SQL["onehot_map_join"] = with_profile(
    "SELECT ID, Marital_Status, [" + ", ".join(f"CAST(Marital_Status = '{v}' AS INTEGER)" for v in MARITAL_LEVELS)
    + "] AS Marital_Status_onehot FROM profile")
SQL["column_select"] = with_features(
    "SELECT ID, " + ", ".join(f'round("{c}", 6) AS "{c}"' for c in NUMERICAL + ENGINEERED) + " FROM feat")
SQL["align_reference"] = with_filled(
    "SELECT ID, CAST(0 AS BIGINT) AS \"Education_UNSEEN\", "
    + ", ".join(f'round("{c}", 6) AS "{c}"' for c in reversed(NUMERICAL[:8]))
    + ", CAST(Marital_Status = 'AFRICA' AS BIGINT) AS \"Marital_Status_AFRICA\""
    + ", CAST(Age_Group = '60+' AS BIGINT) AS \"Age_Group_60+\""
    + ", CAST(0 AS BIGINT) AS \"Edu_Marital_UNSEEN_UNSEEN\" FROM filled")

CLUSTER_IN = NUMERICAL[:10]
PCA_IN = NUMERICAL[:15]


def zscore_cte(cols, name="z"):
    stats = ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in cols)
    zs = ", ".join(f'("{c}" - st."m_{c}") / st."s_{c}" AS "z_{c}"' for c in cols)
    return (f",\nst AS (SELECT {stats} FROM filled),\n"
            f"{name} AS (SELECT ID, Target, {zs} FROM filled CROSS JOIN st)")


SQL["standardise"] = with_filled(
    "SELECT ID, " + ", ".join(f'round("z_{c}", 6) AS "{c}_z"' for c in CLUSTER_IN) + " FROM z", zscore_cte(CLUSTER_IN))

# ---------------------------------------------------------------- A*: advanced features
POLY_IN = ["Recency", "Income", "MntWines", "NumWebPurchases", "NumCatalogPurchases"]
PAIR_IN = ["Recency", "MntWines", "NumWebPurchases", "Income"]


def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


SQL["poly_interactions"] = with_filled(
    "SELECT ID, " + ", ".join(f'round(CAST("{a}" AS DOUBLE) * "{b}", 6) AS "Poly_{5 + k}"'
                              for k, (a, b) in enumerate(_pairs(POLY_IN))) + " FROM filled")
SQL["centre_distances"] = with_filled(
    "SELECT z.ID, "
    + ", ".join("round(sqrt(" + " + ".join(f'pow(z."z_{c}" - c{k}."z_{c}", 2)' for c in CLUSTER_IN) + f"), 6) AS Dist_{k}"
                for k in (0, 1))
    + " FROM z CROSS JOIN ctr c0 CROSS JOIN ctr c1 WHERE c0.Target = 0 AND c1.Target = 1",
    zscore_cte(CLUSTER_IN) + ",\nctr AS (SELECT Target, " + ", ".join(f'avg("z_{c}") AS "z_{c}"' for c in CLUSTER_IN)
    + " FROM z GROUP BY Target)")
SQL["covariance_long"] = with_filled(
    " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(covar_samp(\"z_{a}\", \"z_{b}\"), 6) AS covariance FROM z"
                       for i, a in enumerate(PCA_IN) for b in PCA_IN[i:]), zscore_cte(PCA_IN))
SQL["pair_ratios"] = with_filled(
    "SELECT ID, " + ", ".join(f'round("{a}" / ("{b}" + 0.001), 6) AS "{a}_div_{b}"' for a, b in _pairs(PAIR_IN))
    + " FROM filled")
SQL["pair_differences"] = with_filled(
    "SELECT ID, " + ", ".join(f'round(CAST("{a}" AS DOUBLE) - "{b}", 6) AS "{a}_minus_{b}"' for a, b in _pairs(PAIR_IN))
    + " FROM filled")

PAIR_COLS = [x for a, b in _pairs(PAIR_IN) for x in (f"{a}_div_{b}", f"{a}_minus_{b}")]
PAIRS_CTE = (",\npx AS (SELECT filled.*, " + ", ".join(
    [f'"{a}" / ("{b}" + 0.001) AS "{a}_div_{b}", CAST("{a}" AS DOUBLE) - "{b}" AS "{a}_minus_{b}"'
     for a, b in _pairs(PAIR_IN)]) + " FROM filled)")


def _row_stats(cols, prefix):
    n = len(cols)
    mean = "(" + " + ".join(f'CAST("{c}" AS DOUBLE)' for c in cols) + f") / {n}"
    var = "(" + " + ".join(f'pow("{c}" - ({mean}), 2)' for c in cols) + f") / {n - 1}"
    return f"round({mean}, 6) AS {prefix}_Mean, round(sqrt({var}), 6) AS {prefix}_Std"


_all = NUMERICAL + ENGINEERED + PAIR_COLS
SQL["purchase_stats"] = with_filled(
    "SELECT ID, " + _row_stats([c for c in _all if "Purchase" in c], "Purchase") + " FROM px", PAIRS_CTE)
SQL["spending_stats"] = with_filled(
    "SELECT ID, " + _row_stats([c for c in _all if "Mnt" in c], "Spending") + " FROM px", PAIRS_CTE)
SQL["extra_logs"] = with_filled(
    "SELECT ID, " + ", ".join(f'round(ln(1 + "{c}"), 6) AS "{c}_Log"'
                              for c in ["Recency", "Income", "NumWebPurchases", "MntWines"]) + " FROM filled")
SQL["exp_decay"] = with_filled("SELECT ID, round(exp(-Recency / 10), 6) AS Recency_Exp_Decay FROM filled")


def tiered_round(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` into the tiered rounding the Spark side uses:
    about 11 significant digits, so values near 1e12 are not compared below
    double precision."""
    out, i = [], 0
    key = "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            break
        depth, k = 0, j + len(key) - 1
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0:
                break
            k += 1
        inner = sql[j + len(key):k]
        if inner.endswith(", 6"):
            x = tiered_round(inner[:-3])
            out.append(sql[i:j])
            out.append(f"(CASE WHEN abs({x}) >= 1e14 THEN round({x}, -3) WHEN abs({x}) >= 1e11 THEN round({x}, 0) "
                       f"WHEN abs({x}) >= 1e8 THEN round({x}, 3) ELSE round({x}, 6) END)")
        else:
            out.append(sql[i:k + 1])
        i = k + 1
    return "".join(out)




# ---------------------------------------------------------------- B*: splits, folds, weights
HASH = "CAST(('0x' || substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 8)) AS BIGINT)"
RANKED = (f",\nhp AS (SELECT ID, Target, {HASH} AS h FROM profile),\n"
          "rk AS (SELECT ID, Target, row_number() OVER (PARTITION BY Target ORDER BY h, ID) AS r, "
          "count(*) OVER (PARTITION BY Target) AS n FROM hp)")
SQL["stratified_split"] = f"WITH {PROFILE_CTE}{RANKED} SELECT ID, Target, CAST(r <= ceil(0.3 * n) AS INTEGER) AS is_valid FROM rk"
SQL["random_split"] = with_profile(f"SELECT ID, CAST({HASH} < {int(0.2 * 2 ** 32)} AS INTEGER) AS is_valid FROM profile")
SQL["kfold_assign"] = (f"WITH {PROFILE_CTE}{RANKED} SELECT ID, Target, CAST("
                       + " + ".join(f"CAST(r > ceil({j} / 5 * n) AS INTEGER)" for j in range(1, 5))
                       + " AS INTEGER) AS fold FROM rk")
SQL["imbalance_ratio"] = with_profile("""
SELECT CAST(sum(CASE WHEN Target = 0 THEN n ELSE 0 END) AS BIGINT) AS n_0,
       CAST(sum(CASE WHEN Target = 1 THEN n ELSE 0 END) AS BIGINT) AS n_1,
       round(min(n) / max(n), 6) AS ratio,
       CAST(min(n) / max(n) < 0.2 AS INTEGER) AS imbalanced
FROM (SELECT Target, count(*) AS n FROM profile GROUP BY Target) c""")
SQL["class_weights"] = with_profile("""
SELECT Target, n, round(max(n) OVER () / n, 6) AS w_balanced, round(sqrt(max(n) OVER () / n), 6) AS w_sqrt
FROM (SELECT Target, count(*) AS n FROM profile GROUP BY Target) c""")
SQL["pos_weight"] = with_profile("""
SELECT ID, Target, round(CASE WHEN Target = 1 THEN
  (SELECT count(*) FILTER (WHERE Target = 0) / count(*) FILTER (WHERE Target = 1) FROM profile) ELSE 1.0 END, 6) AS weight
FROM profile""")

# ---------------------------------------------------------------- V*: metrics on a deterministic scorecard
SCORED = (",\nscored AS (SELECT ID, Target AS y, round(1.0 / (1.0 + exp(-(0.8::DOUBLE * Campaign_Response_Count"
          " + 0.15::DOUBLE * NumWebPurchases - 0.005::DOUBLE * Recency - 1.0::DOUBLE))), 6) AS p FROM feat),\n"
          "sc AS (SELECT ID, y, p, CAST(p >= 0.5 AS INTEGER) AS pred FROM scored)")


def with_scored(body: str, more: str = "") -> str:
    return with_features(body, SCORED + more)


SQL["accuracy"] = with_scored("SELECT round(avg(CAST(y = pred AS DOUBLE)), 6) AS accuracy, count(*) AS n FROM sc")
SQL["auc_exact"] = with_scored("""
SELECT round(CAST(sum(pos * (below + 0.5 * neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM w""", """,
d AS (SELECT p AS s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS neg
      FROM sc GROUP BY p),
w AS (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM d)""")
CONF = """,
cf AS (SELECT CAST(count(*) FILTER (WHERE y = 1 AND pred = 1) AS DOUBLE) AS tp,
              CAST(count(*) FILTER (WHERE y = 0 AND pred = 1) AS DOUBLE) AS fp,
              CAST(count(*) FILTER (WHERE y = 1 AND pred = 0) AS DOUBLE) AS fn,
              CAST(count(*) FILTER (WHERE y = 0 AND pred = 0) AS DOUBLE) AS tn FROM sc),
m AS (SELECT *,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
  tp + fn AS s1, tn + fp AS s0, tp + fn + tn + fp AS n FROM cf),
m2 AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1,
                 CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0 FROM m)"""
SQL["class_report"] = with_scored("""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m2
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM m2
  UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0 END, n FROM m2
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m2
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM m2) t""",
                                  CONF)
SQL["confusion"] = with_scored("SELECT y AS true_label, pred AS predicted, count(*) AS n FROM sc GROUP BY y, pred")
SQL["f1_sweep"] = with_scored("""
SELECT round(k / 100, 6) AS threshold, tp, fp, fn, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END, 6) AS f1 FROM (
  SELECT k, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS pr,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS rc FROM (
    SELECT t.k, count(*) FILTER (WHERE sc.p > t.k / 100 AND sc.y = 1) AS tp,
           count(*) FILTER (WHERE sc.p > t.k / 100 AND sc.y = 0) AS fp,
           count(*) FILTER (WHERE NOT (sc.p > t.k / 100) AND sc.y = 1) AS fn
    FROM (SELECT CAST(range AS INTEGER) AS k FROM range(10, 90, 5)) t CROSS JOIN sc GROUP BY t.k) a) b""")
SQL["accuracy_sweep"] = with_scored("""
SELECT round(t.k / 100, 6) AS threshold,
       count(*) FILTER (WHERE CAST(sc.p >= t.k / 100 AS INTEGER) = sc.y) AS correct,
       round(count(*) FILTER (WHERE CAST(sc.p >= t.k / 100 AS INTEGER) = sc.y) / count(*), 6) AS accuracy
FROM (SELECT CAST(range AS INTEGER) AS k FROM range(10, 90)) t CROSS JOIN sc GROUP BY t.k""")
SQL["log_loss"] = with_scored("""
SELECT round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 6) AS log_loss
FROM (SELECT y, least(greatest(p, 1e-15), 1 - 1e-15) AS q FROM sc) t""")
SQL["label_threshold"] = with_scored("""
SELECT ID, round(p, 6) AS p, CAST(p >= 0.5 AS INTEGER) AS pred_ge, CAST(p > 0.5 AS INTEGER) AS pred_gt,
       CAST(p >= 0.35 AS INTEGER) AS pred_stored FROM sc""")
SQL["soft_vote"] = with_features("""
SELECT ID, round(v, 6) AS p_vote, CAST(v >= 0.5 AS INTEGER) AS pred FROM (
  SELECT ID, (round(1.0 / (1.0 + exp(-(0.8::DOUBLE * Campaign_Response_Count - 1.0::DOUBLE))), 6)
            + round(1.0 / (1.0 + exp(-(0.15::DOUBLE * NumWebPurchases - 0.005::DOUBLE * Recency))), 6)
            + round(1.0 / (1.0 + exp(-(0.5::DOUBLE * Complain + 0.1::DOUBLE * NumWebVisitsMonth - 0.5::DOUBLE))), 6)) / 3 AS v
  FROM feat) t""")
SQL["class_distribution"] = with_profile("""
SELECT Target, n, round(n * 100.0 / sum(n) OVER (), 6) AS percent
FROM (SELECT Target, count(*) AS n FROM profile GROUP BY Target) c""")
SQL["prediction_distribution"] = with_scored("""
SELECT pred, n, round(n * 100.0 / sum(n) OVER (), 6) AS percent FROM (SELECT pred, count(*) AS n FROM sc GROUP BY pred) c""")
SQL["validation_dump"] = with_scored("""
SELECT ID, CAST(y AS INTEGER) AS true_values, round(p, 6) AS predicted_probabilities, pred AS predictions FROM (
  SELECT sc.*, row_number() OVER (PARTITION BY y ORDER BY """ + HASH + """, ID) AS r, count(*) OVER (PARTITION BY y) AS n
  FROM sc) t WHERE r <= ceil(0.3 * n)""")

for _k in list(SQL):
    SQL[_k] = tiered_round(SQL[_k])


# ---------------------------------------------------------------- B6: SMOTE, brute force
def _hash(*parts):
    inner = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts[:-1])
    return f"CAST(('0x' || substr(md5({inner} || ':{parts[-1]}'), 1, 8)) AS BIGINT)"


KNN_CTE = zscore_cte(CLUSTER_IN) + """,
mz AS (SELECT * FROM z WHERE Target = 1),
pairs AS (SELECT a.ID, b.ID AS neighbour_id, sqrt(""" + " + ".join(f'pow(a."z_{c}" - b."z_{c}", 2)' for c in CLUSTER_IN) + """) AS distance
          FROM mz a JOIN mz b ON a.ID <> b.ID),
knn AS (SELECT ID, neighbour_id, CAST(rn AS INTEGER) AS nb_rank, distance FROM (
          SELECT *, row_number() OVER (PARTITION BY ID ORDER BY distance, neighbour_id) AS rn FROM pairs) t WHERE rn <= 5)"""
SQL["smote_neighbours"] = with_filled("SELECT ID, neighbour_id, nb_rank, round(distance, 6) AS distance FROM knn", KNN_CTE)
SQL["smote_rows"] = with_filled(
    "SELECT (SELECT max(ID) FROM z) + (e.ID - (SELECT min(ID) FROM z)) * ((SELECT (n_maj - n_min) // n_min FROM cnt) + 1) + e.j AS ID, "
    "e.ID AS source_id, CAST(e.j AS INTEGER) AS j, k.neighbour_id AS nb_id, "
    + ", ".join(f'round(e."z_{c}" + e.lam * (nb."z_{c}" - e."z_{c}"), 6) AS "z_{c}"' for c in CLUSTER_IN)
    + ", CAST(1 AS BIGINT) AS Target, 1 AS synthetic "
      "FROM ex2 e JOIN knn k ON e.ID = k.ID AND e.nb_rank = k.nb_rank JOIN mz nb ON nb.ID = k.neighbour_id",
    KNN_CTE + f""",
cnt AS (SELECT count(*) FILTER (WHERE Target = 1) AS n_min, count(*) FILTER (WHERE Target = 0) AS n_maj FROM z),
mh AS (SELECT mz.*, row_number() OVER (ORDER BY {_hash('ID', 42)}, ID) AS r FROM mz),
gen AS (SELECT mh.*, (n_maj - n_min) // n_min + CASE WHEN r <= (n_maj - n_min) % n_min THEN 1 ELSE 0 END AS g
        FROM mh CROSS JOIN cnt),
ex AS (SELECT gen.*, unnest(range(1, g + 1)) AS j FROM gen),
ex2 AS (SELECT ex.*, CAST({_hash('ID', 'j', 42)} % least(5, (SELECT n_min - 1 FROM cnt)) + 1 AS INTEGER) AS nb_rank,
               {_hash('ID', 'j', 43)} / 4294967296.0 AS lam FROM ex)""")
SQL["smote_rows"] = tiered_round(SQL["smote_rows"])
SQL["smote_neighbours"] = tiered_round(SQL["smote_neighbours"])


# ---------------------------------------------------------------- P*: profiling
SQL["profile_shape"] = with_profile("SELECT count(*) AS n_rows, 27 AS n_columns FROM profile")
SQL["profile_info"] = with_profile(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", CASE lower(typeof(any_value(\"{c}\"))) WHEN 'varchar' THEN 'string' "
    f"WHEN 'integer' THEN 'int' ELSE lower(typeof(any_value(\"{c}\"))) END AS type, count(\"{c}\") AS non_null FROM profile"
    for i, c in enumerate(PROFILE_COLS)))
SQL["profile_nunique"] = with_profile(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT \"{c}\") AS n_distinct FROM profile" for c in PROFILE_COLS))
SQL["profile_head"] = with_profile(select_rounded(PROFILE_COLS, "profile", PROFILE_DOUBLES) + " ORDER BY ID LIMIT 5")
SQL["profile_distinct"] = with_profile(
    "SELECT DISTINCT 'Education' AS \"column\", Education AS value FROM profile "
    "UNION SELECT DISTINCT 'Marital_Status', Marital_Status FROM profile")
SQL["submission_agreement"] = with_features("""
SELECT sub_a, sub_b, round(avg(CAST(ta = tb AS DOUBLE)), 6) AS agreement, count(*) AS n FROM (
  SELECT 'scorecard' AS sub_a, 'campaign' AS sub_b, s AS ta, c AS tb FROM subs
  UNION ALL SELECT 'scorecard', 'web', s, w FROM subs
  UNION ALL SELECT 'campaign', 'web', c, w FROM subs) t GROUP BY sub_a, sub_b""", """,
subs AS (SELECT ID,
  CAST(round(1.0 / (1.0 + exp(-(0.8::DOUBLE * Campaign_Response_Count + 0.15::DOUBLE * NumWebPurchases
       - 0.005::DOUBLE * Recency - 1.0::DOUBLE))), 6) >= 0.5 AS INTEGER) AS s,
  CAST(Campaign_Response_Count > 0 AS INTEGER) AS c,
  CAST(NumWebPurchases >= 3 AS INTEGER) AS w FROM feat)""")

# ---------------------------------------------------------------- C1, C2: correlation filter
_ALLNUM = NUMERICAL + ENGINEERED
SQL["corr_drop"] = with_filled("""
SELECT DISTINCT nb AS dropped FROM (
  SELECT pb.name AS nb, abs(corr(a.v, b.v)) AS r
  FROM lv a JOIN lv b ON a.ID = b.ID
  JOIN pos pa ON pa.name = a.name JOIN pos pb ON pb.name = b.name
  WHERE pa.i < pb.i GROUP BY pa.name, pb.name) t WHERE r > 0.95""", """,
wide AS (SELECT ID, """ + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _ALLNUM) + """ FROM filled),
lv AS (UNPIVOT wide ON """ + ", ".join(f'"{c}"' for c in _ALLNUM) + """ INTO NAME name VALUE v),
pos AS (SELECT * FROM (VALUES """ + ", ".join(f"('{c}', {i})" for i, c in enumerate(_ALLNUM)) + """) t(name, i))""")
SQL["corr_long"] = with_filled("""
SELECT pa.name AS col_a, pb.name AS col_b, round(abs(corr(a.v, b.v)), 6) AS abs_corr
FROM lv a JOIN lv b ON a.ID = b.ID JOIN pos pa ON pa.name = a.name JOIN pos pb ON pb.name = b.name
WHERE pa.i < pb.i GROUP BY pa.name, pb.name HAVING min(a.v) < max(a.v) AND min(b.v) < max(b.v)""",
                              SQL["corr_drop"][SQL["corr_drop"].index(",\nwide AS"):SQL["corr_drop"].index("SELECT DISTINCT nb")])
for _k in ("profile_head", "submission_agreement", "corr_long"):
    SQL[_k] = tiered_round(SQL[_k])

# ---------------------------------------------------------------- flagship: response by segment
SQL["segment_response"] = tiered_round(with_features("""
SELECT Education, count(*) AS customers, sum(Target) AS responders, round(avg(Target), 6) AS response_rate,
  round(avg(Campaign_Response_Rate), 6) AS avg_campaign_rate, round(avg(Total_Spent), 6) AS avg_total_spent,
  round(avg(Total_Purchases), 6) AS avg_purchases
FROM feat GROUP BY Education"""))

# ---------------------------------------------------------------- results of learned operators that SQL can state
SQL["customers_csv"] = SQL["customer_profile"]
SQL["save_load_check"] = (f"SELECT count(*) AS n_rows, count(*) AS n_equal FROM ({SQL['stratified_split']}) WHERE is_valid = 1")
SQL["batch_score_check"] = with_profile("SELECT count(*) AS n_ids, count(*) AS n_once, count(*) AS n_labelled FROM profile")
SQL["kmeans_check"] = with_profile("SELECT count(*) AS n_rows, count(*) AS n_nearest FROM profile")
SQL["pca_check"] = with_profile("SELECT count(*) AS n_rows, " + ", ".join(
    f"0.0 AS {c}" for c in ("mean_1", "mean_2", "mean_3", "corr_12", "corr_13", "corr_23")) + " FROM profile")
# after SMOTE every class has as many training rows as the larger one; fold j ends at rank ceil((j + 1) n / 3)
SQL["resampled_folds"] = f"""
WITH train AS (SELECT Target, count(*) AS n FROM ({SQL['stratified_split']}) WHERE is_valid = 0 GROUP BY Target),
size AS (SELECT Target, (SELECT max(n) FROM train) AS n FROM train)
SELECT CAST(j AS INTEGER) AS fold, Target, CAST(ceil((j + 1) * n / 3.0) - ceil(j * n / 3.0) AS BIGINT) AS n,
       CAST(ceil((j + 1) * n / 3.0) - ceil(j * n / 3.0) AS BIGINT) AS n_ids
FROM size CROSS JOIN (SELECT unnest(range(3)) AS j)"""
SQL["accuracy_gain"] = f"""
WITH s AS ({SQL['accuracy_sweep']}),
n AS (SELECT count(*) AS n FROM ({SQL['label_threshold']})),
b AS (SELECT threshold, correct FROM s ORDER BY correct DESC, threshold LIMIT 1),
h AS (SELECT correct AS half FROM s WHERE threshold = 0.5)
SELECT threshold, round(correct / n, 6) AS accuracy, round(half / n, 6) AS accuracy_at_half,
       round((correct - half) / n, 6) AS gain FROM b CROSS JOIN h CROSS JOIN n"""

# logs of five runs, counted from the customers; a run's file has only some of the metrics
LOG_CTE = """,
l AS (SELECT ID % 5 AS k, CAST(Year_Birth - 1940 AS INTEGER) AS iter, round(avg(Target), 6) AS a, round(avg(Complain), 6) AS c,
             round(avg(Recency) / 100, 6) AS loss, CAST(sum(NumWebPurchases) AS BIGINT) AS passed FROM profile GROUP BY ALL),
r AS (SELECT CASE k WHEN 3 THEN 'fold_3' WHEN 4 THEN 'single_model' ELSE 'fold-' || k END AS run,
             CAST(CASE WHEN k < 4 THEN k END AS INTEGER) AS fold, iter, CASE WHEN k IN (1, 2) THEN a END AS "AUC",
             CASE WHEN k IN (0, 4) THEN c END AS "Accuracy", loss AS "Logloss", passed FROM l)"""
SQL["training_log_union"] = with_profile('SELECT run, fold, iter, "AUC", "Accuracy", "Logloss" FROM r', LOG_CTE)
SQL["training_log_best"] = with_profile("""
SELECT run, iter AS "best_test_Logloss", "best_test_Accuracy", "best_test_AUC", "Logloss" AS "learn_Logloss", passed AS "time_Passed"
FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY "Logloss", iter) AS n,
             CASE WHEN "Accuracy" IS NOT NULL THEN first(iter) OVER (PARTITION BY run ORDER BY "Accuracy" DESC, iter) END AS "best_test_Accuracy",
             CASE WHEN "AUC" IS NOT NULL THEN first(iter) OVER (PARTITION BY run ORDER BY "AUC" DESC, iter) END AS "best_test_AUC" FROM r) t
WHERE n = 1""", LOG_CTE)
SQL["submission_files"] = tiered_round(with_features("""
SELECT printf('submission_%02d', i) AS sub_a, printf('submission_%02d', j) AS sub_b, count(*) AS n,
       round(avg(CAST((p >= CAST(20 + 4 * i AS DOUBLE) / 100) = (p >= CAST(20 + 4 * j AS DOUBLE) / 100) AS DOUBLE)), 6) AS agreement
FROM scored JOIN (SELECT a.i, b.i AS j FROM range(15) a(i) JOIN range(15) b(i) ON a.i < b.i) t ON true GROUP BY i, j""", SCORED))
SQL["profile_nunique_sketch_check"] = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", 1 AS within" for c in PROFILE_COLS)
SQL["onehot_vector"] = with_features(f"""
SELECT v.ID, v.col AS "column", v.level, CAST(coalesce(f.position, n.n) AS INTEGER) AS position, 1 AS value
FROM v LEFT JOIN f ON f.col = v.col AND f.level = v.level JOIN (SELECT col, count(*) AS n FROM f GROUP BY col) n ON n.col = v.col""", f""",
c AS (SELECT ID, coalesce(Education, 'Unknown') AS "Education", coalesce(Marital_Status, 'Unknown') AS "Marital_Status",
             coalesce(Edu_Marital_Combined, 'Unknown') AS "Edu_Marital_Combined" FROM feat),
v AS (UNPIVOT c ON "Education", "Marital_Status", "Edu_Marital_Combined" INTO NAME col VALUE level),
f AS (SELECT col, level, row_number() OVER (PARTITION BY col ORDER BY level) - 1 AS position
      FROM (SELECT DISTINCT col, level FROM v WHERE ID IN (SELECT ID FROM ({SQL['stratified_split']}) s WHERE is_valid = 0)) d)""")

# learned results: what holds whatever a model has learned
_CHECKED = "SELECT count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_own, count(*) AS n_p, count(*) AS n_pred"
for _name in ("gbt_train", "xgb_preset", "simple_mode", "forest", "voting", "stacking"):
    SQL[f"{_name}_check"] = f"{_CHECKED} FROM ({SQL['stratified_split']}) s WHERE is_valid = 1"
SQL["mlp_check"] = f"{_CHECKED} FROM ({SQL['stratified_split'].replace('ceil(0.3 * n)', 'ceil(0.2 * n)')}) s WHERE is_valid = 1"
_TRAIN = f"train AS (SELECT Target, count(*) AS n FROM ({SQL['stratified_split']}) s WHERE is_valid = 0 GROUP BY Target)"
SQL["stack_folds_check"] = f"""
WITH {_TRAIN}, f AS (SELECT CAST(j AS INTEGER) AS fold, Target, CAST(ceil((j + 1) * n / 3.0) - ceil(j * n / 3.0) AS BIGINT) AS n
                     FROM train CROSS JOIN (SELECT unnest(range(3)) AS j) t)
SELECT fold, Target, n, n AS n_ids, n AS n_scored FROM f"""
SQL["cv_metrics_check"] = f"""
WITH {_TRAIN}
SELECT CAST(j AS INTEGER) AS fold, CAST(sum(ceil((j + 1) * n / 5.0) - ceil(j * n / 5.0)) AS BIGINT) AS n,
       CAST(sum(ceil((j + 1) * n / 5.0) - ceil(j * n / 5.0)) AS BIGINT) AS n_ids, 1 AS same_metrics
FROM train CROSS JOIN (SELECT unnest(range(5)) AS j) t GROUP BY j"""
SQL["leaderboard_check"] = "SELECT 4 AS n_models, 1 AS n_best, 1 AS best_is_best"
SQL["search_trials_check"] = "SELECT 20 AS n_trials, 20 AS n_complete, 20 AS n_inside"
SQL["learning_curve_check"] = "SELECT 1 AS no_gaps, 1 AS n_best, 1 AS is_least, 1 AS runs_on"
SQL["selection_check"] = "SELECT 10 AS n_top, 1 AS in_order, 10 AS n_known, 30 AS n_kept"
SQL["selection_propagation"] = with_profile("SELECT 1 AS same_columns, 1 AS capped, 0 AS n_correlated, count(*) AS n_rows FROM profile")
SQL["pca_variance_check"] = "SELECT 3 AS n_components, 3 AS n_same"
# alignment of the customer table to its own columns but Income, and one more
SQL["align_report"] = "SELECT * FROM (VALUES " + ", ".join(
    [f"('{c}', 'kept')" for c in PROFILE_COLS if c not in ("ID", "Income", "Target")]
    + ["('Not_There', 'added')", "('Income', 'dropped')", "('Target', 'dropped')"]) + ') t("column", action)'

