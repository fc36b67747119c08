"""DuckDB SQL for the customer profile and the base feature table.

Written independently of the Spark code: these strings are the oracle the
Spark results are compared with. ``PROFILE_CTE`` defines ``profile``;
``FEATURES_CTE`` adds ``feat`` (all base features, no fill, no encoding).
"""

PROFILE_CTE = """
cut AS (SELECT max(o_orderdate) - INTERVAL 30 DAY AS cutoff FROM orders),
spend AS (
  SELECT l_orderkey,
    sum(CASE WHEN p_type = 'ECONOMY'  THEN amt ELSE 0 END) AS MntWines,
    sum(CASE WHEN p_type = 'LARGE'    THEN amt ELSE 0 END) AS MntFruits,
    sum(CASE WHEN p_type = 'MEDIUM'   THEN amt ELSE 0 END) AS MntMeatProducts,
    sum(CASE WHEN p_type = 'PROMO'    THEN amt ELSE 0 END) AS MntFishProducts,
    sum(CASE WHEN p_type = 'SMALL'    THEN amt ELSE 0 END) AS MntSweetProducts,
    sum(CASE WHEN p_type = 'STANDARD' THEN amt ELSE 0 END) AS MntGoldProds
  FROM (SELECT l_orderkey, l_partkey,
               CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS amt
        FROM lineitem) li
  JOIN part ON li.l_partkey = part.p_partkey
  GROUP BY l_orderkey),
co AS (
  SELECT o.o_custkey,
    count(*) FILTER (WHERE o.o_orderdate < cut.cutoff) AS n_orders,
    min(o.o_orderdate) FILTER (WHERE o.o_orderdate < cut.cutoff) AS first_date,
    max(o.o_orderdate) FILTER (WHERE o.o_orderdate < cut.cutoff) AS last_date,
    sum(coalesce(s.MntWines, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntWines,
    sum(coalesce(s.MntFruits, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntFruits,
    sum(coalesce(s.MntMeatProducts, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntMeatProducts,
    sum(coalesce(s.MntFishProducts, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntFishProducts,
    sum(coalesce(s.MntSweetProducts, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntSweetProducts,
    sum(coalesce(s.MntGoldProds, 0)) FILTER (WHERE o.o_orderdate < cut.cutoff) AS MntGoldProds,
    count(*) FILTER (WHERE o.o_orderdate < cut.cutoff AND o.o_orderpriority = '1-URGENT') AS NumWebPurchases,
    count(*) FILTER (WHERE o.o_orderdate < cut.cutoff AND o.o_orderpriority = '2-HIGH') AS NumCatalogPurchases,
    count(*) FILTER (WHERE o.o_orderdate < cut.cutoff AND o.o_orderpriority = '3-MEDIUM') AS NumStorePurchases,
    count(*) FILTER (WHERE o.o_orderdate < cut.cutoff AND o.o_orderpriority = '5-LOW') AS NumDealsPurchases,
    max(CASE WHEN o.o_orderdate < cut.cutoff AND o.o_orderstatus = 'F' AND year(o.o_orderdate) = 1996 THEN 1 ELSE 0 END) AS AcceptedCmp1,
    max(CASE WHEN o.o_orderdate < cut.cutoff AND o.o_orderstatus = 'F' AND year(o.o_orderdate) = 1997 THEN 1 ELSE 0 END) AS AcceptedCmp2,
    max(CASE WHEN o.o_orderdate < cut.cutoff AND o.o_orderstatus = 'F' AND year(o.o_orderdate) = 1998 THEN 1 ELSE 0 END) AS AcceptedCmp3,
    max(CASE WHEN o.o_orderdate < cut.cutoff AND o.o_orderstatus = 'F' AND year(o.o_orderdate) = 1999 THEN 1 ELSE 0 END) AS AcceptedCmp4,
    max(CASE WHEN o.o_orderdate < cut.cutoff AND o.o_orderstatus = 'F' AND year(o.o_orderdate) = 2000 THEN 1 ELSE 0 END) AS AcceptedCmp5,
    max(CASE WHEN o.o_orderdate >= cut.cutoff THEN 1 ELSE 0 END) AS Target
  FROM orders o CROSS JOIN cut LEFT JOIN spend s ON o.o_orderkey = s.l_orderkey
  GROUP BY o.o_custkey
  HAVING count(*) FILTER (WHERE o.o_orderdate < cut.cutoff) > 0),
ev AS (
  SELECT user_id,
    count(*) FILTER (WHERE event_type = 'view') AS NumWebVisitsMonth,
    max(CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END) AS Complain
  FROM events WHERE event_type IN ('view', 'error') GROUP BY user_id),
profile AS (
  SELECT c.c_custkey AS ID,
    CAST(1940 + (c.c_custkey * 7919) % 60 AS BIGINT) AS Year_Birth,
    c.c_mktsegment AS Education,
    r.r_name AS Marital_Status,
    CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal END AS Income,
    CAST(c.c_custkey % 3 AS BIGINT) AS Kidhome,
    CAST((c.c_custkey % 7) % 3 AS BIGINT) AS Teenhome,
    CASE WHEN c.c_custkey % 10 <= 5 THEN strftime(co.first_date, '%Y-%m-%d')
         WHEN c.c_custkey % 10 <= 7 THEN strftime(co.first_date, '%m/%d/%Y')
         WHEN c.c_custkey % 10 = 8 THEN
           CASE WHEN day(co.first_date) > 12 THEN strftime(co.first_date, '%d-%m-%Y')
                ELSE strftime(co.first_date, '%Y-%m-%d') END
         ELSE 'not a date' END AS Dt_Customer,
    CAST(date_diff('day', CAST(co.last_date AS DATE), CAST(cut.cutoff AS DATE)) AS BIGINT) AS Recency,
    CAST(round(co.MntWines, 2) AS DOUBLE) AS MntWines,
    CAST(round(co.MntFruits, 2) AS DOUBLE) AS MntFruits,
    CAST(round(co.MntMeatProducts, 2) AS DOUBLE) AS MntMeatProducts,
    CAST(round(co.MntFishProducts, 2) AS DOUBLE) AS MntFishProducts,
    CAST(round(co.MntSweetProducts, 2) AS DOUBLE) AS MntSweetProducts,
    CAST(round(co.MntGoldProds, 2) AS DOUBLE) AS MntGoldProds,
    CAST(co.NumDealsPurchases AS BIGINT) AS NumDealsPurchases,
    CAST(co.NumWebPurchases AS BIGINT) AS NumWebPurchases,
    CAST(co.NumCatalogPurchases AS BIGINT) AS NumCatalogPurchases,
    CAST(co.NumStorePurchases AS BIGINT) AS NumStorePurchases,
    CAST(coalesce(ev.NumWebVisitsMonth, 0) AS BIGINT) AS NumWebVisitsMonth,
    CAST(co.AcceptedCmp1 AS BIGINT) AS AcceptedCmp1,
    CAST(co.AcceptedCmp2 AS BIGINT) AS AcceptedCmp2,
    CAST(co.AcceptedCmp3 AS BIGINT) AS AcceptedCmp3,
    CAST(co.AcceptedCmp4 AS BIGINT) AS AcceptedCmp4,
    CAST(co.AcceptedCmp5 AS BIGINT) AS AcceptedCmp5,
    CAST(coalesce(ev.Complain, 0) AS BIGINT) AS Complain,
    CAST(co.Target AS BIGINT) AS Target
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN co ON c.c_custkey = co.o_custkey
  CROSS JOIN cut
  LEFT JOIN ev ON c.c_custkey = ev.user_id)
"""

FEATURES_CTE = PROFILE_CTE + """,
parsed AS (
  SELECT *, CAST(coalesce(try_strptime(Dt_Customer, '%Y-%m-%d'), try_strptime(Dt_Customer, '%m/%d/%Y'),
                          try_strptime(Dt_Customer, '%m-%d-%Y'), try_strptime(Dt_Customer, '%d/%m/%Y'),
                          try_strptime(Dt_Customer, '%d-%m-%Y')) AS DATE) AS dt
  FROM profile),
mind AS (SELECT min(dt) AS min_dt FROM parsed),
f1 AS (
  SELECT p.*,
    CAST(coalesce(date_diff('day', mind.min_dt, p.dt), 0) AS BIGINT) AS Dates,
    CAST(year(p.dt) AS BIGINT) AS Dt_Year,
    CAST(month(p.dt) AS BIGINT) AS Dt_Month,
    CAST(day(p.dt) AS BIGINT) AS Dt_Day,
    CAST(isodow(p.dt) - 1 AS BIGINT) AS Dt_DayOfWeek,
    CAST(dayofyear(p.dt) AS BIGINT) AS Dt_DayOfYear,
    CAST(quarter(p.dt) AS BIGINT) AS Dt_Quarter,
    CAST(coalesce(isodow(p.dt) >= 6, false) AS BIGINT) AS Dt_Is_Weekend,
    CAST(coalesce(day(p.dt) = 1, false) AS BIGINT) AS Dt_Is_Month_Start,
    CAST(coalesce(p.dt = last_day(p.dt), false) AS BIGINT) AS Dt_Is_Month_End,
    2025 - p.Year_Birth AS Age,
    p.Kidhome + p.Teenhome AS Total_Children,
    coalesce(p.NumWebPurchases, 0) + coalesce(p.NumCatalogPurchases, 0) + coalesce(p.NumStorePurchases, 0)
      + coalesce(p.NumDealsPurchases, 0) AS Total_Purchases,
    coalesce(p.MntWines, 0) + coalesce(p.MntFruits, 0) + coalesce(p.MntMeatProducts, 0)
      + coalesce(p.MntFishProducts, 0) + coalesce(p.MntSweetProducts, 0) + coalesce(p.MntGoldProds, 0) AS Total_Spent,
    coalesce(p.AcceptedCmp1, 0) + coalesce(p.AcceptedCmp2, 0) + coalesce(p.AcceptedCmp3, 0)
      + coalesce(p.AcceptedCmp4, 0) + coalesce(p.AcceptedCmp5, 0) AS Campaign_Response_Count
  FROM parsed p CROSS JOIN mind),
feat AS (
  SELECT f1.*,
    CASE WHEN Age > 0 AND Age <= 30 THEN '<30' WHEN Age > 30 AND Age <= 40 THEN '30-40'
         WHEN Age > 40 AND Age <= 50 THEN '40-50' WHEN Age > 50 AND Age <= 60 THEN '50-60'
         WHEN Age > 60 AND Age <= 100 THEN '60+' ELSE '<30' END AS Age_Group,
    Age * Age AS Age_Squared,
    CAST(coalesce(Total_Children > 0, false) AS BIGINT) AS Has_Children,
    CAST(coalesce(Kidhome > 0, false) AS BIGINT) AS Has_Kid,
    CAST(coalesce(Teenhome > 0, false) AS BIGINT) AS Has_Teen,
    Kidhome / (Total_Children + 0.001) AS Child_Ratio,
    NumWebPurchases / (Total_Purchases + 0.001) AS NumWebPurchases_Ratio,
    NumCatalogPurchases / (Total_Purchases + 0.001) AS NumCatalogPurchases_Ratio,
    NumStorePurchases / (Total_Purchases + 0.001) AS NumStorePurchases_Ratio,
    NumDealsPurchases / (Total_Purchases + 0.001) AS NumDealsPurchases_Ratio,
    CAST(coalesce(NumWebPurchases > 0, false) AS BIGINT) + CAST(coalesce(NumCatalogPurchases > 0, false) AS BIGINT)
      + CAST(coalesce(NumStorePurchases > 0, false) AS BIGINT) + CAST(coalesce(NumDealsPurchases > 0, false) AS BIGINT)
      AS Purchase_Channels_Used,
    NumWebPurchases / (NumStorePurchases + 0.001) AS Web_Store_Ratio,
    MntWines / (Total_Spent + 0.001) AS MntWines_Ratio,
    MntFruits / (Total_Spent + 0.001) AS MntFruits_Ratio,
    MntMeatProducts / (Total_Spent + 0.001) AS MntMeatProducts_Ratio,
    MntFishProducts / (Total_Spent + 0.001) AS MntFishProducts_Ratio,
    MntSweetProducts / (Total_Spent + 0.001) AS MntSweetProducts_Ratio,
    MntGoldProds / (Total_Spent + 0.001) AS MntGoldProds_Ratio,
    CAST(coalesce(MntWines > 0, false) AS BIGINT) + CAST(coalesce(MntFruits > 0, false) AS BIGINT)
      + CAST(coalesce(MntMeatProducts > 0, false) AS BIGINT) + CAST(coalesce(MntFishProducts > 0, false) AS BIGINT)
      + CAST(coalesce(MntSweetProducts > 0, false) AS BIGINT) + CAST(coalesce(MntGoldProds > 0, false) AS BIGINT)
      AS Spending_Categories_Used,
    Total_Spent / (Total_Purchases + 0.001) AS Avg_Spent_Per_Purchase,
    ln(1 + MntWines) AS MntWines_Log,
    ln(1 + MntFruits) AS MntFruits_Log,
    ln(1 + MntMeatProducts) AS MntMeatProducts_Log,
    ln(1 + MntFishProducts) AS MntFishProducts_Log,
    ln(1 + MntSweetProducts) AS MntSweetProducts_Log,
    ln(1 + MntGoldProds) AS MntGoldProds_Log,
    Total_Spent * Total_Spent AS Total_Spent_Squared,
    Campaign_Response_Count / 5 AS Campaign_Response_Rate,
    AcceptedCmp5 AS Last_Campaign_Accepted,
    (coalesce(AcceptedCmp1, 0) + coalesce(AcceptedCmp2, 0) + coalesce(AcceptedCmp3, 0) + coalesce(AcceptedCmp4, 0)) / 4
      AS Previous_Response_Rate,
    ln(1 + Income) AS Income_Log,
    sqrt(Income + 0.001) AS Income_Sqrt,
    Income / (Total_Children + 1) AS Income_Per_Child,
    Income / (Age + 0.001) AS Income_Per_Age,
    Total_Spent / (Income + 0.001) AS Income_Spent_Ratio,
    Recency * Recency AS Recency_Squared,
    ln(1 + Recency) AS Recency_Log,
    Recency / (Total_Purchases + 0.001) AS Recency_Purchase_Ratio,
    ln(1 + NumWebVisitsMonth) AS NumWebVisitsMonth_Log,
    NumWebPurchases / (NumWebVisitsMonth + 0.001) AS Web_Conversion_Rate,
    Recency * (Campaign_Response_Count / 5) AS Recency_X_Campaign,
    Recency * NumWebPurchases AS Recency_X_WebPurchases,
    (Campaign_Response_Count / 5) * NumWebPurchases AS Campaign_X_WebPurchases,
    coalesce(Education, 'Unknown') || '_' || coalesce(Marital_Status, 'Unknown') AS Edu_Marital_Combined
  FROM f1)
"""


def select_rounded(cols, source="feat", doubles=(), where="", extra=""):
    """``SELECT`` list with the named double columns rounded to 6 digits."""
    items = [f'round("{c}", 6) AS "{c}"' if c in doubles else f'"{c}"' for c in cols]
    return f"SELECT {', '.join(items)} FROM {source} {where} {extra}".strip()
