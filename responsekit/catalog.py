"""Column catalogue: the fixed names the feature tables are built from.

The reference discovers these sets by name pattern and dtype at run time;
here they are declared once so schemas are known before any job runs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: input column names, categorical levels and bins that must
# --- equal the reference's for matching results.
ID_COL = "ID"
TARGET_COL = "Target"
DATE_COL = "Dt_Customer"
EDU_COL = "Education"
MARITAL_COL = "Marital_Status"

NUMERICAL_COLS = [
    "Year_Birth", "Income", "Kidhome", "Teenhome", "Dates", "Recency",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts",
    "MntSweetProducts", "MntGoldProds", "NumWebPurchases", "NumCatalogPurchases",
    "NumStorePurchases", "NumDealsPurchases", "NumWebVisitsMonth", "AcceptedCmp1",
    "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5", "Complain",
]
PURCHASE_COLS = ["NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases", "NumDealsPurchases"]
SPENT_COLS = ["MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds"]
CAMPAIGN_COLS = ["AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5"]
AGE_GROUP_LABELS = ["<30", "30-40", "40-50", "50-60", "60+"]
AGE_GROUP_EDGES = [0, 30, 40, 50, 60, 100]          # right-closed bins
POLY_INPUTS = ["Recency", "Income", "MntWines", "NumWebPurchases", "NumCatalogPurchases"]
PAIR_INPUTS = ["Recency", "MntWines", "NumWebPurchases", "Income"]
EXTRA_LOG_INPUTS = ["Recency", "Income", "NumWebPurchases", "MntWines"]
F1_THRESHOLDS_PCT = list(range(10, 90, 5))           # 0.10 .. 0.85, 16 values
ACC_THRESHOLDS_PCT = list(range(10, 90))             # 0.10 .. 0.89, 80 values
EPS = 0.001
# --- end of fixed values

# Reference as-of year for age and tenure (the wall clock in the reference).
DEFAULT_AS_OF_YEAR = 2025

# Date formats tried in order; the first that parses wins. Ambiguous
# numeric dates read month-first, day-first only when month-first fails.
DATE_FORMATS = ["yyyy-MM-dd", "MM/dd/yyyy", "MM-dd-yyyy", "dd/MM/yyyy", "dd-MM-yyyy"]

# Columns created by the base feature step, in creation order (all numeric).
DATE_PART_COLS = ["Dt_Year", "Dt_Month", "Dt_Day", "Dt_DayOfWeek", "Dt_DayOfYear", "Dt_Quarter",
                  "Dt_Is_Weekend", "Dt_Is_Month_Start", "Dt_Is_Month_End"]
ENGINEERED_COLS = (
    DATE_PART_COLS
    + ["Age", "Age_Squared", "Total_Children", "Has_Children", "Has_Kid", "Has_Teen", "Child_Ratio",
       "Total_Purchases"]
    + [f"{c}_Ratio" for c in PURCHASE_COLS]
    + ["Purchase_Channels_Used", "Web_Store_Ratio", "Total_Spent"]
    + [f"{c}_Ratio" for c in SPENT_COLS]
    + ["Spending_Categories_Used", "Avg_Spent_Per_Purchase"]
    + [f"{c}_Log" for c in SPENT_COLS]
    + ["Total_Spent_Squared", "Campaign_Response_Rate", "Campaign_Response_Count",
       "Last_Campaign_Accepted", "Previous_Response_Rate",
       "Income_Log", "Income_Sqrt", "Income_Per_Child", "Income_Per_Age", "Income_Spent_Ratio",
       "Recency_Squared", "Recency_Log", "Recency_Purchase_Ratio",
       "NumWebVisitsMonth_Log", "Web_Conversion_Rate",
       "Recency_X_Campaign", "Recency_X_WebPurchases", "Campaign_X_WebPurchases"]
)

# Declared schema of the customer input table (CSV has no types).
CUSTOMER_SCHEMA = T.StructType(
    [T.StructField(ID_COL, T.LongType(), False),
     T.StructField("Year_Birth", T.LongType()),
     T.StructField(EDU_COL, T.StringType()),
     T.StructField(MARITAL_COL, T.StringType()),
     T.StructField("Income", T.DoubleType()),
     T.StructField("Kidhome", T.LongType()),
     T.StructField("Teenhome", T.LongType()),
     T.StructField(DATE_COL, T.StringType()),
     T.StructField("Recency", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in SPENT_COLS]
    + [T.StructField(c, T.LongType()) for c in
       ["NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases", "NumDealsPurchases",
        "NumWebVisitsMonth"] + CAMPAIGN_COLS + ["Complain"]]
    + [T.StructField(TARGET_COL, T.LongType())]
)


def pairs(cols):
    """Ordered pairs (i < j) in list order."""
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
