"""Base customer features (F11-F39) as column expressions.

Two projection layers: the first computes the row totals the others divide
by, the second everything else. Catalyst fuses both into one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from responsekit.catalog import (AGE_GROUP_EDGES, AGE_GROUP_LABELS, CAMPAIGN_COLS, DATE_COL, EDU_COL, EPS,
                                 MARITAL_COL, PURCHASE_COLS, SPENT_COLS)
from responsekit.functions.advanced import d
from responsekit.functions.dates import calendar_parts, days_since, parse_mixed_date

PARSED_DATE = "_dt_parsed"


def add_date_features(df: DataFrame, min_date) -> DataFrame:
    """F1-F6 from the raw ``Dt_Customer`` text."""
    d = parse_mixed_date(F.col(DATE_COL))
    df = df.withColumn(PARSED_DATE, d)
    p = F.col(PARSED_DATE)
    cols = {"Dates": days_since(p, min_date)}
    cols.update(calendar_parts(p))
    return df.withColumns(cols).drop(PARSED_DATE)


# Expressions as SQL text: one JVM parse per output column.
def _n(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _row_sum_sql(cols) -> str:
    return "(" + " + ".join(f"coalesce({_n(c)}, 0)" for c in cols) + ")"


def _count_positive_sql(cols) -> str:
    return "(" + " + ".join(f"CAST(coalesce({_n(c)} > 0, false) AS BIGINT)" for c in cols) + ")"


def _flag_sql(pred: str) -> str:
    return f"CAST(coalesce({pred}, false) AS BIGINT)"


def _ratio_sql(num: str, den: str) -> str:
    return f"CAST({num} / ({den} + {d(EPS)}) AS DOUBLE)"


def _log1p_sql(x: str) -> str:
    return f"log1p(CAST({x} AS DOUBLE))"


def _age_group_sql(age: str) -> str:
    e, lab = AGE_GROUP_EDGES, AGE_GROUP_LABELS
    whens = " ".join(f"WHEN {age} > {e[i]} AND {age} <= {e[i + 1]} THEN '{lab[i]}'" for i in range(len(lab)))
    return f"CASE {whens} ELSE '{lab[0]}' END"


def add_base_features(df: DataFrame, min_date, as_of_year: int) -> DataFrame:
    """All base features in the reference's creation order."""
    df = add_date_features(df, min_date)
    n = _n
    first = {
        "Age": f"CAST({int(as_of_year)} - {n('Year_Birth')} AS BIGINT)",
        "Total_Children": f"CAST({n('Kidhome')} + {n('Teenhome')} AS BIGINT)",
        "Total_Purchases": f"CAST({_row_sum_sql(PURCHASE_COLS)} AS BIGINT)",
        "Total_Spent": f"CAST({_row_sum_sql(SPENT_COLS)} AS DOUBLE)",
        "Campaign_Response_Count": f"CAST({_row_sum_sql(CAMPAIGN_COLS)} AS BIGINT)",
    }
    df = df.withColumns({k: F.expr(v) for k, v in first.items()})
    second = {
        "Age_Group": _age_group_sql(n("Age")),
        "Age_Squared": f"{n('Age')} * {n('Age')}",
        "Has_Children": _flag_sql(f"{n('Total_Children')} > 0"),
        "Has_Kid": _flag_sql(f"{n('Kidhome')} > 0"),
        "Has_Teen": _flag_sql(f"{n('Teenhome')} > 0"),
        "Child_Ratio": _ratio_sql(n("Kidhome"), n("Total_Children")),
    }
    for p in PURCHASE_COLS:
        second[f"{p}_Ratio"] = _ratio_sql(n(p), n("Total_Purchases"))
    second["Purchase_Channels_Used"] = _count_positive_sql(PURCHASE_COLS)
    second["Web_Store_Ratio"] = _ratio_sql(n("NumWebPurchases"), n("NumStorePurchases"))
    for c in SPENT_COLS:
        second[f"{c}_Ratio"] = _ratio_sql(n(c), n("Total_Spent"))
    second["Spending_Categories_Used"] = _count_positive_sql(SPENT_COLS)
    second["Avg_Spent_Per_Purchase"] = _ratio_sql(n("Total_Spent"), n("Total_Purchases"))
    for c in SPENT_COLS:
        second[f"{c}_Log"] = _log1p_sql(n(c))
    second["Total_Spent_Squared"] = f"{n('Total_Spent')} * {n('Total_Spent')}"
    rate = f"({n('Campaign_Response_Count')} / {len(CAMPAIGN_COLS)})"
    second["Campaign_Response_Rate"] = rate
    last = max(CAMPAIGN_COLS, key=lambda c: int(c.replace("AcceptedCmp", "")))
    prev = [c for c in CAMPAIGN_COLS if c != last]
    second["Last_Campaign_Accepted"] = f"CAST({n(last)} AS BIGINT)"
    second["Previous_Response_Rate"] = f"CAST({_row_sum_sql(prev)} / {len(prev)} AS DOUBLE)"
    inc = f"CAST({n('Income')} AS DOUBLE)"
    second["Income_Log"] = _log1p_sql(inc)
    second["Income_Sqrt"] = f"CASE WHEN {inc} + {d(EPS)} >= 0 THEN sqrt({inc} + {d(EPS)}) END"
    second["Income_Per_Child"] = f"CAST({inc} / ({n('Total_Children')} + 1) AS DOUBLE)"
    second["Income_Per_Age"] = _ratio_sql(inc, n("Age"))
    second["Income_Spent_Ratio"] = _ratio_sql(n("Total_Spent"), inc)
    second["Recency_Squared"] = f"{n('Recency')} * {n('Recency')}"
    second["Recency_Log"] = _log1p_sql(n("Recency"))
    second["Recency_Purchase_Ratio"] = _ratio_sql(n("Recency"), n("Total_Purchases"))
    second["NumWebVisitsMonth_Log"] = _log1p_sql(n("NumWebVisitsMonth"))
    second["Web_Conversion_Rate"] = _ratio_sql(n("NumWebPurchases"), n("NumWebVisitsMonth"))
    second["Recency_X_Campaign"] = f"CAST({n('Recency')} * {rate} AS DOUBLE)"
    second["Recency_X_WebPurchases"] = f"{n('Recency')} * {n('NumWebPurchases')}"
    second["Campaign_X_WebPurchases"] = f"CAST({rate} * {n('NumWebPurchases')} AS DOUBLE)"
    second["Edu_Marital_Combined"] = (f"concat_ws('_', coalesce({n(EDU_COL)}, 'Unknown'), "
                                      f"coalesce({n(MARITAL_COL)}, 'Unknown'))")
    return df.withColumns({k: F.expr(v) for k, v in second.items()})
