"""Test inputs derived from the driver's tables, each defined twice: as Spark
DataFrame code and as a DuckDB SQL CTE with the same values.

Every fixture is computed over whole tables; the key arithmetic only decides
*which kind* of dirt or change each row gets (so all kinds occur in fixed
proportions at any scale), never which rows are kept to make a check cheaper.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
RUN_TS = "2024-02-01 00:00:00"
MART_TODAY = "2000-01-01"


class Tables:
    """Lazy access to ``<sf_dir>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


# -- dirty_dates: order dates as MySQL might hold them ---------------------------
def dirty_dates(t: Tables) -> DataFrame:
    d = F.substring(F.col("o_orderdate").cast("string"), 1, 10)  # zone-free text
    m = F.col("o_orderkey") % 6
    raw = (
        F.when(m == 0, F.lit("0000-00-00"))
        .when(m == 1, F.concat(F.substring(d, 1, 5), F.lit("00"), F.substring(d, 8, 3)))
        .when(m == 2, F.concat(F.substring(d, 1, 8), F.lit("00")))
        .when(m == 3, F.concat(F.substring(d, 1, 5), F.lit("02-30")))
        .when(m == 4, F.lit(None).cast("string"))
        .otherwise(d)
    )
    return t.orders.select("o_orderkey", raw.alias("order_date_raw"))


SQL_DIRTY_DATES = """dirty_dates AS (
  SELECT o_orderkey,
         CASE o_orderkey % 6
           WHEN 0 THEN '0000-00-00'
           WHEN 1 THEN substr(d, 1, 5) || '00' || substr(d, 8, 3)
           WHEN 2 THEN substr(d, 1, 8) || '00'
           WHEN 3 THEN substr(d, 1, 5) || '02-30'
           WHEN 4 THEN NULL
           ELSE d END AS order_date_raw
  FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders))"""


# -- dirty_datetimes: event times with zero and malformed values ----------------
def dirty_datetimes(t: Tables) -> DataFrame:
    s = F.substring(F.col("ts").cast("string"), 1, 19)  # zone-free text
    m = F.col("event_id") % 5
    raw = (
        F.when(m == 0, F.lit("0000-00-00 00:00:00"))
        .when(m == 1, F.concat(s, F.lit(".123456")))
        .when(m == 2, F.substring(s, 1, 10))
        .when(m == 3, F.concat(F.substring(s, 1, 5), F.lit("00"), F.substring(s, 8, 12)))
        .otherwise(s)
    )
    return t.events.select("event_id", raw.alias("ts_raw"))


SQL_DIRTY_DATETIMES = """dirty_datetimes AS (
  SELECT event_id,
         CASE event_id % 5
           WHEN 0 THEN '0000-00-00 00:00:00'
           WHEN 1 THEN s || '.123456'
           WHEN 2 THEN substr(s, 1, 10)
           WHEN 3 THEN substr(s, 1, 5) || '00' || substr(s, 8)
           ELSE s END AS ts_raw
  FROM (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s FROM events))"""


# -- tinyint_flags: a tinyint(1) flag as CAST(.. AS DECIMAL) delivers it ---------
def tinyint_flags(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    raw = F.when(k % 7 == 0, F.lit(None)).otherwise(k % 3).cast("decimal(10,0)")
    return t.orders.select("o_orderkey", raw.alias("flag_raw"))


SQL_TINYINT_FLAGS = """tinyint_flags AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS DECIMAL(10,0)) END AS flag_raw
  FROM orders)"""


# -- change-time text ------------------------------------------------------------
def change_time_text(t: Tables) -> DataFrame:
    txt = F.when(F.col("event_id") % 10 == 0, F.lit("n/a")).otherwise(
        F.col("ts").cast("string")  # zone-free text, fraction included
    )
    return t.events.select("event_id", txt.alias("update_ts_dms"))


SQL_CHANGE_TIME_TEXT = """change_time_text AS (
  SELECT event_id,
         CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS update_ts_dms
  FROM events)"""


# -- cdc_one_change: orders target and a feed touching each key at most once -----
def cdc_one_target(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderkey") % 5 != 4).select(*ORDER_COLS)


def cdc_one_feed(t: Tables) -> DataFrame:
    m = F.col("o_orderkey") % 5
    op = F.when(m == 4, "I").when(m == 2, "D").when(m == 0, F.lit(None).cast("string")).otherwise("U")
    price = F.when(m == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return t.orders.select(
        op.alias("Op"),
        F.lit("tpch").alias("schema_name"),
        F.lit("orders").alias("table_name"),
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        price.alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


SQL_CDC_ONE = """cdc_target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 5 <> 4),
cdc_feed AS (
  SELECT CASE o_orderkey % 5 WHEN 4 THEN 'I' WHEN 2 THEN 'D' WHEN 0 THEN NULL ELSE 'U' END AS Op,
         'tpch' AS schema_name, 'orders' AS table_name,
         o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 5 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders)"""


# -- cdc_many_changes: per-user state with many changes per key ------------------
USER_COLS = ["user_id", "event_id", "event_type", "value", "ts"]


UNTOUCHED = 1_000_000_000  # added to a user's id: a row that no change touches


def cdc_many_target(t: Tables) -> DataFrame:
    u = F.col("user_id")
    return (
        t.events.select(F.when(u % 3 == 0, u + UNTOUCHED).otherwise(u).alias("user_id"))
        .distinct()
        .select(
            "user_id",
            F.lit(-1).cast("bigint").alias("event_id"),
            F.lit("seed").alias("event_type"),
            F.lit(0.0).cast("double").alias("value"),
            F.lit("2023-12-31 00:00:00").cast("timestamp_ntz").alias("ts"),
        )
    )


def cdc_many_feed(t: Tables) -> DataFrame:
    kind, e = F.col("event_type"), F.col("event_id")
    op = F.when(e % 97 == 0, F.lit(None).cast("string")).when(e % 89 == 0, "X").when(kind == "signup", "I").when(kind == "error", "D").otherwise("U")
    return t.events.select(
        op.alias("Op"), F.lit("app").alias("schema_name"), F.lit("user_state").alias("table_name"), *USER_COLS
    )


SQL_CDC_MANY = f"""many_target AS (
  SELECT DISTINCT CASE WHEN user_id % 3 = 0 THEN user_id + {UNTOUCHED} ELSE user_id END AS user_id, CAST(-1 AS BIGINT) AS event_id, 'seed' AS event_type, CAST(0 AS DOUBLE) AS value,
         TIMESTAMP '2023-12-31 00:00:00' AS ts
  FROM events),
many_feed AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'X' WHEN event_type = 'signup' THEN 'I'
              WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS Op,
         'app' AS schema_name, 'user_state' AS table_name, user_id, event_id, event_type, value, ts
  FROM events)"""


# -- null_key_changes: the same changes, every eleventh without a key --------------
def null_key_feed(t: Tables) -> DataFrame:
    return cdc_many_feed(t).withColumn("user_id", F.when(F.col("event_id") % 11 != 0, F.col("user_id")))


SQL_NULL_KEY = SQL_CDC_MANY + """,
null_feed AS (
  SELECT Op, CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, event_id, event_type, value, ts FROM many_feed)"""


# -- text_partitions: orders in departments named by digits -------------------------
def text_partition_rows(t: Tables) -> DataFrame:
    return t.orders.select(*ORDER_COLS, F.lpad((F.col("o_custkey") % 7).cast("string"), 3, "0").alias("dept"))


SQL_TEXT_PARTITIONS = """parted AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         lpad(CAST(o_custkey % 7 AS VARCHAR), 3, '0') AS dept FROM orders)"""


# -- hot_key_changes: a change feed where ONE key carries a third of all rows ----
HOT_ORDER = ["changed_at", "partkey", "l_suppkey", "l_linenumber", "quantity", "l_extendedprice", "Op"]


def hot_target(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("k"),
        F.lit(None).cast("bigint").alias("partkey"),
        F.lit(0.0).alias("quantity"),
        F.col("o_orderdate").alias("changed_at"),
    )


def hot_feed(t: Tables) -> DataFrame:
    k = F.when(F.col("l_orderkey") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("l_orderkey"))
    return t.lineitem.select(
        F.when(F.col("l_returnflag") == "R", "D").otherwise("U").alias("Op"),
        k.alias("k"),
        F.col("l_partkey").alias("partkey"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("changed_at"),
        "l_suppkey",
        "l_linenumber",
        "l_extendedprice",
    )


SQL_HOT = """hot_target AS (
  SELECT o_orderkey AS k, CAST(NULL AS BIGINT) AS partkey, CAST(0 AS DOUBLE) AS quantity, o_orderdate AS changed_at
  FROM orders),
hot_feed AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'U' END AS Op,
         CASE WHEN l_orderkey % 3 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey END AS k,
         l_partkey AS partkey, l_quantity AS quantity, l_shipdate AS changed_at,
         l_suppkey, l_linenumber, l_extendedprice
  FROM lineitem)"""


# -- full load as the replication tool lands it ----------------------------------
def full_load_raw(t: Tables) -> DataFrame:
    txt = F.when(F.col("o_orderkey") % 50 == 0, F.lit("n/a")).otherwise(
        F.substring(F.col("o_orderdate").cast("string"), 1, 19)
    )
    return t.orders.select(
        F.lit("I").alias("Op"),
        F.lit("tpch").alias("schema_name"),
        F.lit("orders").alias("table_name"),
        *ORDER_COLS,
        txt.alias("update_ts_dms"),
    )


SQL_FULL_LOAD_RAW = """full_load_raw AS (
  SELECT 'I' AS Op, 'tpch' AS schema_name, 'orders' AS table_name,
         o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS update_ts_dms
  FROM orders)"""


# -- gapped_keys: orders with a key gap wider than one chunk, and rows without a key
GAP_AT = 7500
GAP = 1_000_000


def gapped_keys(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    key = F.when(k % 13 == 0, F.lit(None).cast("bigint")).when(k > GAP_AT, k + GAP).otherwise(k)
    return t.orders.withColumn("o_orderkey", key)


SQL_GAPPED_KEYS = f"""gapped_keys AS (
  SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey > {GAP_AT} THEN o_orderkey + {GAP} ELSE o_orderkey END AS o_orderkey,
         o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders)"""


# -- hot_text: order lines under a text key; one value holds a third of them, some have none
def hot_text(t: Tables) -> DataFrame:
    p = F.col("l_partkey")
    name = F.when(p % 3 == 0, F.lit("Part 'O' \\ hot")).when(p % 31 != 0, F.concat(F.lit("part "), (p % 1000).cast("string")))
    return t.lineitem.select(name.alias("part_name"), "l_orderkey", "l_linenumber", "l_quantity")


SQL_HOT_TEXT = """hot_text AS (
  SELECT CASE WHEN l_partkey % 3 = 0 THEN 'Part ''O'' \\ hot' WHEN l_partkey % 31 <> 0 THEN 'part ' || CAST(l_partkey % 1000 AS VARCHAR) END AS part_name,
         l_orderkey, l_linenumber, l_quantity FROM lineitem)"""


# -- duplicate_rows: orders with every 100th order landed twice ------------------
def duplicate_rows(t: Tables) -> DataFrame:
    o = t.orders
    return o.unionByName(o.filter(F.col("o_orderkey") % 100 == 0))


SQL_DUPLICATE_ROWS = """duplicate_rows AS (
  SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0)"""


# -- hot_copies: orders plus, for every line of every third order, a copy of one row
#    (one group of identical copies holding more than a third of the rows)
HOT_ROW = {"o_orderkey": -1, "o_custkey": 7, "o_orderstatus": "O", "o_totalprice": 12.5, "o_orderdate": "1995-01-01 00:00:00", "o_orderpriority": "1-URGENT"}


def hot_copies(t: Tables) -> DataFrame:
    types = dict(t.orders.dtypes)
    copies = t.lineitem.filter(F.col("l_orderkey") % 3 == 0).select(*(F.lit(v).cast(types[c]).alias(c) for c, v in HOT_ROW.items()))
    return t.orders.select(*ORDER_COLS).unionByName(copies)


SQL_HOT_COPIES = """hot_row AS (
  SELECT CAST(-1 AS BIGINT) AS o_orderkey, CAST(7 AS BIGINT) AS o_custkey, 'O' AS o_orderstatus, CAST(12.5 AS DOUBLE) AS o_totalprice,
         TIMESTAMP '1995-01-01 00:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
