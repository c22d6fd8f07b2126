"""Reporting marts rebuilt by full refresh.

The operator is :func:`refresh_mart`: compute the mart, write it as a new
snapshot, then repoint the catalog table - a failed refresh leaves yesterday's
mart readable instead of an emptied one.

The four bodies below are OUR OWN stand-ins over the test tables, written only
to exercise the refresh; the real mart definitions are not available. Money is
summed as decimal so results are exact and engine-independent.

Join plans: facts are aggregated or reduced to the needed columns before any
join; dimension joins are left to Catalyst/AQE, which broadcast a side only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.sinks.snapshot import refresh_table

MONEY = "decimal(15,2)"
TOTAL = "decimal(18,2)"
REVENUE = "decimal(20,4)"


def _money(c: str):
    return F.col(c).cast(MONEY)


def _month(c: str):
    """``yyyy-MM`` of a timestamp_ntz column, rendered without any time zone."""
    return F.substring(F.col(c).cast("string"), 1, 7)


def _line_revenue():
    return _money("l_extendedprice") * (F.lit(1) - _money("l_discount"))


def user_information(t) -> DataFrame:
    """Per customer: nation, order count, total spent, first and last order day."""
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(_money("o_totalprice")).cast(TOTAL).alias("total_spent"),
        F.min(F.to_date("o_orderdate")).alias("first_order_date"),
        F.max(F.to_date("o_orderdate")).alias("last_order_date"),
    )
    cust = t.customer.select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation"))
    return (
        cust.join(per_cust, "c_custkey", "left")
        .join(nation, "c_nationkey", "left")
        .select(
            "c_custkey",
            "c_name",
            "c_mktsegment",
            "nation",
            F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
            F.coalesce("total_spent", F.lit(0).cast(TOTAL)).alias("total_spent"),
            "first_order_date",
            "last_order_date",
        )
    )


def reservation_information(t, today: str) -> DataFrame:
    """Orders placed before ``today``: count and total per month and status."""
    before = t.orders.filter(F.col("o_orderdate") < F.lit(today).cast("timestamp_ntz"))
    return before.groupBy(
        _month("o_orderdate").alias("order_month"), "o_orderstatus"
    ).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(_money("o_totalprice")).cast(TOTAL).alias("total"),
    )


def company_integration(t) -> DataFrame:
    """Per supplier: nation, region, balance, lines supplied and their revenue."""
    per_supp = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(_line_revenue()).cast(REVENUE).alias("revenue"),
    )
    nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    region = t.region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return (
        t.supplier.select("s_suppkey", "s_name", "s_nationkey", _money("s_acctbal").alias("s_acctbal"))
        .join(per_supp, "s_suppkey", "left")
        .join(nation, "s_nationkey", "left")
        .join(region, "n_regionkey", "left")
        .select(
            "s_suppkey",
            "s_name",
            "n_name",
            "r_name",
            "s_acctbal",
            F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"),
            F.coalesce("revenue", F.lit(0).cast(REVENUE)).alias("revenue"),
        )
    )


def domestic_settlement(t) -> DataFrame:
    """Revenue per nation and month from lines whose supplier and customer share a nation."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("orderkey"),
        _month("o_orderdate").alias("order_month"),
        F.col("o_custkey").alias("c_custkey"),
    ).join(t.customer.select("c_custkey", F.col("c_nationkey").alias("nationkey")), "c_custkey")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_suppkey").alias("s_suppkey"), _line_revenue().alias("rev")
    ).join(t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nationkey")), "s_suppkey")
    per = (
        lines.join(orders.drop("c_custkey"), ["orderkey", "nationkey"])
        .groupBy("nationkey", "order_month")
        .agg(
            F.sum("rev").cast(REVENUE).alias("revenue"),
            F.count(F.lit(1)).alias("lines"),
            F.count_distinct("orderkey").alias("orders"),
        )
    )
    nation = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return per.join(nation, "nationkey").select("n_name", "order_month", "revenue", "lines", "orders")


# --- Fixed values: mart names, their table prefix and refresh order. ----------
REFRESH_ORDER = ["company_integration", "user_information", "reservation_information", "domestic_settlement"]
MART_TABLE_PREFIX = "bi_"
# ------------------------------------------------------------------------------

MARTS: dict[str, Callable] = {
    "company_integration": company_integration,
    "user_information": user_information,
    "reservation_information": reservation_information,
    "domestic_settlement": domestic_settlement,
}


def refresh_mart(spark: SparkSession, df: DataFrame, root: str, database: str, name: str) -> DataFrame:
    """Swap in a freshly computed mart; returns the table as now registered."""
    table = refresh_table(spark, df, f"{root}/{name}", database, f"{MART_TABLE_PREFIX}{name}")
    return spark.table(table)
