"""Customer profile table built from the driver's star schema.

One row per customer with at least one order before the cutoff, in the
27-column shape of the reference's customer CSV (see FIXTURES.md §3).

Plan shape (what to expect from ``explain``):
  lineitem ⋈ part on partkey      -> shuffle join (AQE splits a hot part)
  -> large tables: dealt by orderkey into tasks of LINES_PER_TASK lines -> agg (6 conditional sums of whole units)
  orders ⋈ per-order sums         -> join on orderkey, reuses that dealing
  -> one agg by custkey           (map-side partial agg absorbs a hot customer)
  customer ⋈ nation ⋈ region      -> tiny fixed dimensions, broadcast by size stats
  ⋈ per-customer order agg, ⟕ per-user event agg (both unique on the key)
The cutoff is a single scalar, collected once; it enters the conditional sums
as a literal (orders on both sides of it are needed, so no row group is skipped).
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from responsekit.sources.tables import read_table

# --- Fixed values: mapping of driver columns onto the customer-table columns.
SPEND_BY_TYPE = [
    ("MntWines", "ECONOMY"),
    ("MntFruits", "LARGE"),
    ("MntMeatProducts", "MEDIUM"),
    ("MntFishProducts", "PROMO"),
    ("MntSweetProducts", "SMALL"),
    ("MntGoldProds", "STANDARD"),
]
PURCHASES_BY_PRIORITY = [
    ("NumWebPurchases", "1-URGENT"),
    ("NumCatalogPurchases", "2-HIGH"),
    ("NumStorePurchases", "3-MEDIUM"),
    ("NumDealsPurchases", "5-LOW"),
]
CAMPAIGN_YEARS = [("AcceptedCmp1", 1996), ("AcceptedCmp2", 1997), ("AcceptedCmp3", 1998),
                  ("AcceptedCmp4", 1999), ("AcceptedCmp5", 2000)]
CUTOFF_DAYS = 30
COMPLAIN_VALUE = 60.0
JUNK_DATE = "not a date"
# --- end of fixed values

#: Lines whose orders a task adds up: their number bounds its memory at any size of the input.
LINES_PER_TASK = 500_000

PROFILE_COLUMNS = [
    "ID", "Year_Birth", "Education", "Marital_Status", "Income", "Kidhome", "Teenhome",
    "Dt_Customer", "Recency",
    "MntWines", "MntFruits", "MntMeatProducts", "MntFishProducts", "MntSweetProducts", "MntGoldProds",
    "NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases",
    "NumWebVisitsMonth", "AcceptedCmp1", "AcceptedCmp2", "AcceptedCmp3", "AcceptedCmp4", "AcceptedCmp5",
    "Complain", "Target",
]


def order_cutoff(spark: SparkSession, sf_dir: str) -> str:
    """max(o_orderdate) - 30 days as 'yyyy-MM-dd HH:mm:ss', one scalar."""
    mx = read_table(spark, sf_dir, "orders").agg(
        F.date_format(F.max("o_orderdate") - F.expr(f"INTERVAL {CUTOFF_DAYS} DAYS"),
                      "yyyy-MM-dd HH:mm:ss").alias("m")).first()["m"]
    return mx


def cutoff_literal(cutoff: str):
    return F.lit(cutoff).cast("timestamp_ntz")


def _format_first_date(custkey, d):
    """Print the first-order date in a customer-dependent format, as the CSV would."""
    style = custkey % 10
    iso = F.date_format(d, "yyyy-MM-dd")
    return (F.when(style <= 5, iso)
            .when(style <= 7, F.date_format(d, "MM/dd/yyyy"))
            .when(style == 8, F.when(F.dayofmonth(d) > 12, F.date_format(d, "dd-MM-yyyy")).otherwise(iso))
            .otherwise(F.lit(JUNK_DATE)))


def _amount():
    """Discounted price in whole units of 10^-4: exact, and a sum (up to 9.2e14) holds 8 bytes where a wide decimal holds 32."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return (amount * F.lit(10_000)).cast("long")


def _currency(units):
    return units.cast("decimal(20,0)") * F.lit(Decimal("0.0001"))


def order_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks for ``LINES_PER_TASK`` lines each (row counts come from the files' footers)."""
    return math.ceil(read_table(spark, sf_dir, "lineitem").count() / LINES_PER_TASK)


def dealt(df: DataFrame, tasks: int, key: str) -> DataFrame:
    """``df`` dealt by ``key`` into ``tasks`` tasks; if the cores are enough for them, Spark's own exchange will do."""
    return df.repartition(tasks, key) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def per_order_spend(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Six conditional spend sums per order (units of ``_amount``), pre-aggregated before the orders join.

    Lines of a large table are dealt by order before they are added up: a line is no longer than its share of the sums, and a task holds
    the sums of its own orders only. Lines without an order key belong to no order."""
    li = read_table(spark, sf_dir, "lineitem").filter("l_orderkey IS NOT NULL").select("l_orderkey", "l_partkey", _amount().alias("amt"))
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    typed = dealt(li.join(pt, li.l_partkey == pt.p_partkey, "inner").select("l_orderkey", "p_type", "amt"),
                  order_tasks(spark, sf_dir) if tasks is None else tasks, "l_orderkey")
    return typed.groupBy("l_orderkey").agg(
        *[F.sum(F.when(F.col("p_type") == t, F.col("amt")).otherwise(F.lit(0))).alias(name)
          for name, t in SPEND_BY_TYPE])


def customer_orders(spark: SparkSession, sf_dir: str, cutoff: str) -> DataFrame:
    """All order-derived columns per customer in one aggregation."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    tasks = order_tasks(spark, sf_dir)
    spend = per_order_spend(spark, sf_dir, tasks)
    orders = dealt(orders, tasks, "o_orderkey")
    ox = orders.join(spend, orders.o_orderkey == spend.l_orderkey, "left")
    cut = cutoff_literal(cutoff)
    in_o = F.col("o_orderdate") < cut
    aggs = [
        F.count(F.when(in_o, F.lit(1))).alias("n_orders"),
        F.min(F.when(in_o, F.col("o_orderdate"))).alias("first_date"),
        F.max(F.when(in_o, F.col("o_orderdate"))).alias("last_date"),
    ]
    aggs += [F.sum(F.when(in_o, F.coalesce(F.col(name), F.lit(0)))).alias(name) for name, _ in SPEND_BY_TYPE]
    aggs += [F.count(F.when(in_o & (F.col("o_orderpriority") == p), F.lit(1))).alias(name)
             for name, p in PURCHASES_BY_PRIORITY]
    aggs += [F.max(F.when(in_o & (F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == y), F.lit(1))
                   .otherwise(F.lit(0))).cast("long").alias(name) for name, y in CAMPAIGN_YEARS]
    aggs += [F.max(F.when(F.col("o_orderdate") >= cut, F.lit(1)).otherwise(F.lit(0))).cast("long").alias("Target")]
    return ox.groupBy("o_custkey").agg(*aggs).filter(F.col("n_orders") > 0)


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    ev = ev.filter(F.col("event_type").isin("view", "error"))
    return ev.groupBy("user_id").agg(
        F.count(F.when(F.col("event_type") == "view", F.lit(1))).alias("NumWebVisitsMonth"),
        F.max(F.when((F.col("event_type") == "error") & (F.col("value") > COMPLAIN_VALUE), F.lit(1))
              .otherwise(F.lit(0))).cast("long").alias("Complain"))


def planted_target() -> Column:
    """A learnable 0/1 label over profile columns, for quality checks only.

    The driver's ``Target`` is random, so a model cannot beat AUC 0.5 on it.
    The planted label is 1 when z = -0.01·Recency + 3·campaign rate
    + 0.3·NumWebPurchases - 1 is positive, flipped for the 10% of IDs with the
    lowest md5 prefix (label noise), as FIXTURES.md §3 describes.
    """
    rate = sum((F.col(name) for name, _ in CAMPAIGN_YEARS[1:]), F.col(CAMPAIGN_YEARS[0][0])) / F.lit(len(CAMPAIGN_YEARS))
    z = F.col("Recency") * -0.01 + rate * 3 + F.col("NumWebPurchases") * 0.3 - 1
    h = F.conv(F.substring(F.md5(F.col("ID").cast("string")), 1, 8), 16, 10).cast("long")
    flip = h < F.lit(int(0.1 * 2 ** 32))
    return F.when(flip, (z <= 0).cast("long")).otherwise((z > 0).cast("long"))


def customer_profile(spark: SparkSession, sf_dir: str, cutoff: str | None = None) -> DataFrame:
    """The customer table (27 columns) derived from the driver tables."""
    cutoff = cutoff or order_cutoff(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    c = cust.join(geo, cust.c_nationkey == geo.n_nationkey, "left")
    o = customer_orders(spark, sf_dir, cutoff)
    e = customer_events(spark, sf_dir)
    j = c.join(o, c.c_custkey == o.o_custkey, "inner").join(e, c.c_custkey == e.user_id, "left")
    k = F.col("c_custkey")
    cut_date = F.to_date(cutoff_literal(cutoff))
    cols = [
        k.alias("ID"),
        (F.lit(1940) + (k * 7919) % 60).cast("long").alias("Year_Birth"),
        F.col("c_mktsegment").alias("Education"),
        F.col("r_name").alias("Marital_Status"),
        F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_acctbal")).cast("double").alias("Income"),
        (k % 3).cast("long").alias("Kidhome"),
        ((k % 7) % 3).cast("long").alias("Teenhome"),
        _format_first_date(k, F.to_date("first_date")).alias("Dt_Customer"),
        F.datediff(cut_date, F.to_date("last_date")).cast("long").alias("Recency"),
    ]
    cols += [F.round(_currency(F.col(name)), 2).cast("double").alias(name) for name, _ in SPEND_BY_TYPE]
    cols += [F.col(name).cast("long").alias(name) for name in
             ["NumDealsPurchases", "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases"]]
    cols += [F.coalesce(F.col("NumWebVisitsMonth"), F.lit(0)).cast("long").alias("NumWebVisitsMonth")]
    cols += [F.col(name) for name, _ in CAMPAIGN_YEARS]
    cols += [F.coalesce(F.col("Complain"), F.lit(0)).cast("long").alias("Complain"), F.col("Target")]
    return j.select(*cols)
