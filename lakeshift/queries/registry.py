"""Registered checks: one Spark query per implemented operator, and the DuckDB
SQL that must give the same rows.

Each Spark callable takes ``(spark, sf_dir)`` and reads the driver's tables
(whole tables; derived fixtures in :mod:`lakeshift.queries.fixtures`). Queries
for writers perform the write into a fresh folder under the session's shared
work folder and return what a reader of the result would see.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions import repair as R
from lakeshift.functions.proof import observe_proof, observed_proof
from lakeshift.operators import basic as B
from lakeshift.operators import cdc
from lakeshift.operators.projection import filter_equal, select_columns, typed_projection
from lakeshift.plans import marts
from lakeshift.plans.restart import RangesFailed, migrate_ranges
from lakeshift.plans.migrate import migrate_tables, unproven_columns
from lakeshift.queries import fixtures as fx
from lakeshift.queries.fixtures import Tables
from lakeshift.session import hadoop_fs, list_files, new_work_dir
from lakeshift.sinks import snapshot as K
from lakeshift.sinks.buckets import BUCKET, BucketedTable
from lakeshift.sinks.evolve import read_versions
from lakeshift.sinks.layout import files_within, write_clustered
from lakeshift.sinks.keyindex import upsert_touched, write_key_index
from lakeshift.sinks.merge import latest_sources
from lakeshift.sources.catalog import classes_from_schema, column_classes
from lakeshift.sources.files import read_recursive
from lakeshift.sources.jdbc import bounds_query, key_bounds, plan_balanced, range_predicates, read_key_ranges, union_all
from lakeshift.sources.splits import range_number, split_points, split_predicates
from lakeshift.streaming.ingest import apply_available, ingest_available
from lakeshift.streaming.ledger import BATCH, FILE, current, set_file_time, take_in

CHECK_DB = "lakeshift_checks"
DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SOURCE_DB = "tpch"
#: Bytes of a file at most, where a query plans its files.
MOST_FILE_BYTES = 64 << 20

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- F1-F7 -------
@register(
    "zero_date_repair",
    fx.with_ctes(fx.SQL_DIRTY_DATES)
    + """SELECT o_orderkey, order_date_raw,
       CAST(TRY_CAST(replace(replace(order_date_raw, '0000-00-00', '1900-01-01'), '-00', '-01') AS DATE)
            AS TIMESTAMP) AS order_date
FROM dirty_dates""",
)
def q_zero_date_repair(spark, sf_dir):
    d = fx.dirty_dates(Tables(spark, sf_dir))
    return _portable(d.withColumn("order_date", R.repair_zero_date("order_date_raw")))


@register(
    "zero_datetime_repair",
    fx.with_ctes(fx.SQL_DIRTY_DATETIMES)
    + """SELECT event_id, ts_raw,
       try_strptime(replace(ts_raw, '0000-00-00 00:00:00', '1970-01-01 00:00:00'), '%Y-%m-%d %H:%M:%S') AS ts
FROM dirty_datetimes""",
)
def q_zero_datetime_repair(spark, sf_dir):
    d = fx.dirty_datetimes(Tables(spark, sf_dir))
    return d.withColumn("ts", R.repair_zero_datetime("ts_raw"))


@register(
    "tinyint_to_int",
    fx.with_ctes(fx.SQL_TINYINT_FLAGS)
    + "SELECT o_orderkey, CAST(flag_raw AS INTEGER) AS flag FROM tinyint_flags",
)
def q_tinyint_to_int(spark, sf_dir):
    d = fx.tinyint_flags(Tables(spark, sf_dir))
    return d.select("o_orderkey", R.tinyint_to_int("flag_raw").alias("flag"))


@register("time_as_string", "SELECT event_id, split_part(CAST(ts AS VARCHAR), ' ', 2) AS event_time FROM events")
def q_time_as_string(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", R.time_text("ts", dict(ev.dtypes)["ts"]).alias("event_time"))


@register(
    "cdc_timestamps",
    fx.with_ctes(fx.SQL_CHANGE_TIME_TEXT)
    + f"""SELECT event_id, TRY_CAST(update_ts_dms AS TIMESTAMP) AS update_ts_dms,
       TIMESTAMP '{fx.RUN_TS}' AS last_applied_date
FROM change_time_text""",
)
def q_cdc_timestamps(spark, sf_dir):
    return cdc.stamp_changes(fx.change_time_text(Tables(spark, sf_dir)), fx.RUN_TS)


# ---------------------------------------------------------------- P1-P3 -------
def _classes_for(spark, df: DataFrame, table: str):
    return classes_from_schema(SOURCE_DB, table, df.schema)


@register(
    "typed_projection",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem""",
)
def q_typed_projection(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return typed_projection(li, _classes_for(spark, li, "lineitem"))


@register("select_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def q_select_columns(spark, sf_dir):
    return select_columns(Tables(spark, sf_dir).orders, ["o_orderkey", "o_custkey", "o_orderdate"])


@register("equality_filter_pushdown", "SELECT * FROM lineitem WHERE l_returnflag = 'R'")
def q_equality_filter_pushdown(spark, sf_dir):
    return filter_equal(Tables(spark, sf_dir).lineitem, l_returnflag="R")


@register(
    "drop_metadata_columns",
    fx.with_ctes(fx.SQL_CDC_ONE)
    + "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM cdc_feed",
)
def q_drop_metadata_columns(spark, sf_dir):
    return cdc.drop_metadata(fx.cdc_one_feed(Tables(spark, sf_dir)))


# ---------------------------------------------------------------- P6, A2 ------
@register(
    "cdc_split",
    fx.with_ctes(fx.SQL_CDC_MANY)
    + """SELECT user_id, event_id, Op, CASE WHEN Op = 'D' THEN 'delete' ELSE 'upsert' END AS branch
FROM many_feed WHERE Op IS NOT NULL""",
)
def q_cdc_split(spark, sf_dir):
    feed = fx.cdc_many_feed(Tables(spark, sf_dir))
    ups, dels = cdc.split_changes(feed)
    cols = ["user_id", "event_id", "Op"]
    return ups.select(*cols, F.lit("upsert").alias("branch")).unionByName(
        dels.select(*cols, F.lit("delete").alias("branch"))
    )


@register(
    "cdc_op_counts",
    fx.with_ctes(fx.SQL_CDC_MANY) + "SELECT Op, count(*) AS n FROM many_feed GROUP BY Op",
)
def q_cdc_op_counts(spark, sf_dir):
    return cdc.op_counts(fx.cdc_many_feed(Tables(spark, sf_dir)))


# ---------------------------------------------------------------- J1-J4 -------
_ORDER_SELECT = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_SQL_UPSERTED = f"""upserted AS (
  SELECT {_ORDER_SELECT} FROM cdc_target t
  WHERE NOT EXISTS (SELECT 1 FROM cdc_feed f WHERE f.Op <> 'D' AND f.o_orderkey = t.o_orderkey)
  UNION ALL
  SELECT {_ORDER_SELECT} FROM cdc_feed WHERE Op <> 'D')"""


@register("cdc_upsert", fx.with_ctes(fx.SQL_CDC_ONE, _SQL_UPSERTED) + "SELECT * FROM upserted")
def q_cdc_upsert(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ups, _ = cdc.split_changes(fx.cdc_one_feed(t))
    return cdc.upsert(fx.cdc_one_target(t), cdc.drop_metadata(ups), "o_orderkey")


@register(
    "cdc_delete",
    fx.with_ctes(fx.SQL_CDC_ONE)
    + """SELECT * FROM cdc_target t
WHERE NOT EXISTS (SELECT 1 FROM cdc_feed f WHERE f.Op = 'D' AND f.o_orderkey = t.o_orderkey)""",
)
def q_cdc_delete(spark, sf_dir):
    t = Tables(spark, sf_dir)
    _, dels = cdc.split_changes(fx.cdc_one_feed(t))
    return cdc.delete(fx.cdc_one_target(t), dels, "o_orderkey")


_SQL_CDC_APPLY = fx.with_ctes(fx.SQL_CDC_ONE, _SQL_UPSERTED) + """SELECT * FROM upserted u
WHERE NOT EXISTS (SELECT 1 FROM cdc_feed f WHERE f.Op = 'D' AND f.o_orderkey = u.o_orderkey)"""


@register("cdc_apply", _SQL_CDC_APPLY)
def q_cdc_apply(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cdc.apply_changes(fx.cdc_one_target(t), fx.cdc_one_feed(t), "o_orderkey")


_SQL_LATEST = fx.with_ctes(
    fx.SQL_CDC_MANY,
    """latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM many_feed WHERE Op IS NOT NULL) WHERE rn = 1)""",
) + """SELECT user_id, event_id, event_type, value, ts FROM many_target t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.user_id = t.user_id)
UNION ALL
SELECT user_id, event_id, event_type, value, ts FROM latest WHERE Op <> 'D'"""


@register("cdc_apply_latest", _SQL_LATEST)
def q_cdc_apply_latest(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return cdc.apply_latest(fx.cdc_many_target(t), fx.cdc_many_feed(t), "user_id", ["ts", "event_id"])


_SQL_NULL_KEYS = fx.with_ctes(
    fx.SQL_NULL_KEY,
    """latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM null_feed WHERE Op IS NOT NULL AND user_id IS NOT NULL) WHERE rn = 1)""",
) + """SELECT user_id, event_id, event_type, value, ts FROM many_target t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.user_id = t.user_id)
UNION ALL
SELECT user_id, event_id, event_type, value, ts FROM latest WHERE Op <> 'D'
UNION ALL
SELECT DISTINCT user_id, event_id, event_type, value, ts FROM null_feed WHERE user_id IS NULL AND Op <> 'D'"""


@register("cdc_apply_null_keys", _SQL_NULL_KEYS)
def q_cdc_apply_null_keys(spark, sf_dir):
    """J4 with changes that have no key, applied twice: nothing is lost or doubled."""
    t = Tables(spark, sf_dir)
    feed = fx.null_key_feed(t)
    once = cdc.apply_latest(fx.cdc_many_target(t), feed, "user_id", ["ts", "event_id"])
    return cdc.apply_latest(once, feed, "user_id", ["ts", "event_id"])


@register(
    "cdc_apply_text_partition",
    fx.with_ctes(fx.SQL_TEXT_PARTITIONS)
    + f"SELECT {_ORDER_SELECT}, dept FROM parted WHERE o_orderkey % 5 <> 2",
)
def q_cdc_apply_text_partition(spark, sf_dir):
    """M5 and J4 on a table partitioned by text such as "001": the values stay text."""
    rows = fx.text_partition_rows(Tables(spark, sf_dir))
    base = new_work_dir(spark, "parted")
    table = K.VersionedTable(spark, base, CHECK_DB, "parted_" + base.rsplit("-", 1)[-1], partition_by=["dept"])
    table.commit(rows.filter("o_orderkey % 5 <> 4").withColumn("o_totalprice", F.col("o_totalprice") - 1), 0)
    feed = rows.withColumn("Op", F.when(F.col("o_orderkey") % 5 == 2, "D").otherwise("U"))
    table.commit(cdc.apply_latest(table.read(), feed, "o_orderkey", ["o_orderkey"]), 1)
    return table.read()


#: The last change is the greatest struct of the order columns: one aggregate, no sort of the hot key's rows.
_HOT_STRUCT = ", ".join(f'"{c}" := "{c}"' for c in fx.HOT_ORDER)
_SQL_HOT_LATEST = fx.with_ctes(
    fx.SQL_HOT,
    f"""latest AS (
  SELECT k, last.partkey AS partkey, last.quantity AS quantity, last.changed_at AS changed_at, last."Op" AS Op
  FROM (SELECT k, max(struct_pack({_HOT_STRUCT})) AS last FROM hot_feed GROUP BY k))""",
) + """SELECT k, partkey, quantity, changed_at FROM hot_target t
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.k = t.k)
UNION ALL
SELECT k, partkey, quantity, changed_at FROM latest WHERE Op <> 'D'"""


@register("cdc_apply_latest_hot_key", _SQL_HOT_LATEST)
def q_cdc_apply_latest_hot_key(spark, sf_dir):
    """J4 over all of lineitem as a change feed in which key 0 holds a third of
    the rows: the per-key reduction is partially aggregated before the shuffle."""
    t = Tables(spark, sf_dir)
    return cdc.apply_latest(
        fx.hot_target(t), fx.hot_feed(t), "k", fx.HOT_ORDER,
        drop_cols=["l_suppkey", "l_linenumber", "l_extendedprice"],
    )


@register(
    "merge_source_null_keys",
    fx.with_ctes(
        fx.SQL_NULL_KEY,
        """latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM null_feed WHERE Op IS NOT NULL AND user_id IS NOT NULL) WHERE rn = 1)""",
    )
    + """SELECT user_id, event_id, event_type, value, ts, CASE WHEN Op = 'D' THEN 'delete' ELSE 'upsert' END AS statement FROM latest
UNION ALL
SELECT DISTINCT user_id, event_id, event_type, value, ts, 'insert_new' FROM null_feed WHERE user_id IS NULL AND Op <> 'D'""",
)
def q_merge_source_null_keys(spark, sf_dir):
    """J4 over MERGE: the rows its statements read, and which of them. Changes without a
    key are kept one by one; the statement for them inserts only what the table lacks."""
    t = Tables(spark, sf_dir)
    cols = fx.cdc_many_target(t).columns
    rows = latest_sources(fx.null_key_feed(t), ["user_id"], ["ts", "event_id"], cols)
    statement = F.when(~F.col("__keyed"), "insert_new").when(F.col("Op") == "D", "delete").otherwise("upsert")
    return rows.select(*cols, statement.alias("statement"))


@register("cdc_apply_out_of_order", _SQL_LATEST)
def q_cdc_apply_out_of_order(spark, sf_dir):
    """J4 across batches: the latest third of the changes arrives first, the earliest last,
    one batch twice. Late older changes lose, and deleted keys do not come back."""
    t = Tables(spark, sf_dir)
    feed, order_by = fx.cdc_many_feed(t), ["ts", "event_id"]
    base = new_work_dir(spark, "ordered")
    table = K.VersionedTable(spark, base, CHECK_DB, "ordered_" + base.rsplit("-", 1)[-1])
    table.commit(cdc.with_order(fx.cdc_many_target(t), order_by, dict(feed.dtypes)), 0)
    day = F.dayofmonth("ts")
    late, middle, early = feed.filter(day > 20), feed.filter((day > 10) & (day <= 20)), feed.filter(day <= 10)
    for version, batch in enumerate([late, middle, late, early], 1):
        table.commit(cdc.apply_ordered(table.read(), batch, "user_id", order_by, stage_dir=f"{base}/_staging/{version}"), version)
    return cdc.visible(table.read())


_TOUCHED_KEYS = "o_orderkey > (SELECT max(o_orderkey) * 6 // 10 FROM orders) AND o_orderkey <= (SELECT max(o_orderkey) * 7 // 10 FROM orders)"


@register(
    "cdc_apply_touched_files",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN {_TOUCHED_KEYS} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority
FROM orders WHERE NOT (o_orderkey % 7 = 3 AND {_TOUCHED_KEYS})""",
)
def q_cdc_apply_touched_files(spark, sf_dir):
    """J1, J2 by file: a batch of one key range reads only the files an index of key bounds
    and Bloom filters leaves; the others stay as they are."""
    orders = Tables(spark, sf_dir).orders
    base = new_work_dir(spark, "indexed")
    data, index = f"{base}/data", f"{base}/index"
    orders.repartitionByRange(20, "o_orderkey").write.parquet(data)
    write_key_index(spark, data, index, "o_orderkey")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    batch = orders.filter((F.col("o_orderkey") > top * 6 // 10) & (F.col("o_orderkey") <= top * 7 // 10))
    changed = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    upserted, read = upsert_touched(spark, index, changed, "o_orderkey", orders.schema)
    new = cdc.delete(upserted, batch.filter("o_orderkey % 7 = 3"), "o_orderkey")
    every = spark.read.parquet(f"{index}/files").select("file")
    in_range = spark.read.parquet(f"{index}/files").filter((F.col("hi") > top * 6 // 10) & (F.col("lo") <= top * 7 // 10))
    if not read or not set(read) <= {r["file"] for r in in_range.collect()} or 4 * len(read) > every.count():
        raise AssertionError(f"read {len(read)} files: {read}")
    untouched = [r["file"] for r in every.collect() if r["file"] not in set(read)]
    return spark.read.schema(orders.schema).parquet(*untouched).unionByName(new)


@register(
    "replayed_commit_text_partition",
    fx.with_ctes(fx.SQL_TEXT_PARTITIONS) + f"SELECT {_ORDER_SELECT}, dept FROM parted",
)
def q_replayed_commit_text_partition(spark, sf_dir):
    """K13, ST2: a run that ends between the data of a version and the catalog is replayed:
    nothing is written twice, partition text such as "001" stays text, the catalog catches up."""
    rows = fx.text_partition_rows(Tables(spark, sf_dir))
    base = new_work_dir(spark, "replayed")
    table = K.VersionedTable(spark, base, CHECK_DB, "replayed_" + base.rsplit("-", 1)[-1], partition_by=["dept"])
    table.commit(rows.filter("o_orderkey % 5 <> 4"), 0)
    table._save_schema(rows.schema, 1)
    table._write(rows, 1)  # here the first run ends
    if table.commit(rows, 1) or table.read().schema["dept"].dataType.simpleString() != "string":
        raise AssertionError("a complete version was written again or lost its schema")
    return spark.table(table.name()).select(*rows.columns)


# ---------------------------------------------------------------- A1-A7, L1 ---
@register(
    "table_row_count",
    "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in DRIVER_TABLES),
)
def q_table_row_count(spark, sf_dir):
    t = Tables(spark, sf_dir)
    counts = [B.row_count(getattr(t, n)).select(F.lit(n).alias("table_name"), "row_count") for n in DRIVER_TABLES]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("max_key", "SELECT max(o_orderkey) AS max_key FROM orders")
def q_max_key(spark, sf_dir):
    return B.max_key(Tables(spark, sf_dir).orders, "o_orderkey")


_SQL_BOUNDS = "SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders"


@register("key_bounds", _SQL_BOUNDS)
def q_key_bounds(spark, sf_dir):
    orders = Tables(spark, sf_dir).orders
    return spark.createDataFrame([key_bounds(orders, "o_orderkey")], "min_key bigint, max_key bigint")


@register("key_bounds_at_source", _SQL_BOUNDS)
def q_key_bounds_at_source(spark, sf_dir):
    """The statement a source would run (A3), with Spark SQL in its place."""
    Tables(spark, sf_dir).orders.createOrReplaceTempView("bounds_source")
    return spark.sql(bounds_query("bounds_source", "o_orderkey")).select(F.col("lo").alias("min_key"), F.col("hi").alias("max_key"))


@register("emptiness", "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, count(*) = 0 AS is_empty FROM {n}" for n in DRIVER_TABLES))
def q_emptiness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return spark.createDataFrame([(n, B.is_empty(getattr(t, n))) for n in DRIVER_TABLES], "table_name string, is_empty boolean")


@register(
    "tinyint_transfer",
    "SELECT o_orderkey, CAST(CAST(o_orderkey % 3 AS DECIMAL(10,0)) AS DOUBLE) AS flag FROM orders",
)
def q_tinyint_transfer(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    flags = o.select("o_orderkey", (F.col("o_orderkey") % 3).cast("tinyint").alias("flag"))
    return _portable(flags.withColumn("flag", R.tinyint_transfer("flag")))


@register("table_report_rows", "SELECT 'lineitem' AS table_name, count(*) AS n, 5 AS shown FROM lineitem")
def q_table_report_rows(spark, sf_dir):
    """The report's row count and the number of rows it shows."""
    path = new_work_dir(spark, "reported")
    K.write_snapshot(Tables(spark, sf_dir).lineitem, path)
    report = K.table_report(spark, K.register_table(spark, CHECK_DB, "lineitem_" + path.rsplit("-", 1)[-1], path))
    return spark.createDataFrame([("lineitem", report["rows"], len(report["preview"]))], "table_name string, n bigint, shown int")


@register("repartitioned_snapshot", "SELECT * FROM lineitem")
def q_repartitioned_snapshot(spark, sf_dir):
    """M3: a snapshot written into an exact number of files: 6, or as many as keep each
    within a size, as one task writes a file."""
    li = Tables(spark, sf_dir).lineitem
    path = new_work_dir(spark, "files")
    n = files_within(li, MOST_FILE_BYTES, least=6)
    K.write_snapshot(li, path, num_files=n)
    files = [f for f in list_files(spark, path) if f.rsplit("/", 1)[-1].startswith("part-")]
    if len(files) != n:
        raise AssertionError(f"expected {n} files, found {len(files)}")
    return spark.read.parquet(path)


@register(
    "dedup_by_key",
    fx.with_ctes(fx.SQL_DUPLICATE_ROWS)
    + "SELECT * FROM duplicate_rows QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderkey) = 1",
)
def q_dedup_by_key(spark, sf_dir):
    return B.dedup_by_key(fx.duplicate_rows(Tables(spark, sf_dir)), "o_orderkey")


@register(
    "dedup_hot_copies",
    fx.with_ctes(fx.SQL_HOT_COPIES) + f"SELECT {_ORDER_SELECT} FROM orders UNION ALL SELECT {_ORDER_SELECT} FROM hot_row",
)
def q_dedup_hot_copies(spark, sf_dir):
    """A7 where one group of identical copies holds about a third of all rows:
    the first-per-key aggregate is partially applied in every map task, so the
    hot group reaches the shuffle as one row per task."""
    return B.dedup_by_key(fx.hot_copies(Tables(spark, sf_dir)), "o_orderkey")


@register(
    "table_preview",
    """SELECT * FROM lineitem
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, l_shipdate
LIMIT 5""",
)
def q_table_preview(spark, sf_dir):
    return B.preview(Tables(spark, sf_dir).lineitem, 5)


# ---------------------------------------------------------------- S7/U1 -------
@register("union_all_chunks", fx.with_ctes(fx.SQL_GAPPED_KEYS) + "SELECT * FROM gapped_keys")
def q_union_all_chunks(spark, sf_dir):
    src = fx.gapped_keys(Tables(spark, sf_dir))
    without = F.col("o_orderkey").isNull()
    return union_all([src.filter(without), read_key_ranges(src.filter(~without), "o_orderkey", 8)])


@register("range_predicate_reads", fx.with_ctes(fx.SQL_GAPPED_KEYS) + "SELECT * FROM gapped_keys")
def q_range_predicate_reads(spark, sf_dir):
    """The WHERE clauses of a balanced range plan, with Spark SQL in the
    source's place; rows without a key belong to the first."""
    src = fx.gapped_keys(Tables(spark, sf_dir))
    lo, hi = key_bounds(src, "o_orderkey")
    ranges = plan_balanced(src, "o_orderkey", int(lo), int(hi), num_partitions=4)
    return union_all([src.filter(p) for p in range_predicates("o_orderkey", ranges)])


@register("split_hot_text_key", fx.with_ctes(fx.SQL_HOT_TEXT) + "SELECT * FROM hot_text")
def q_split_hot_text_key(spark, sf_dir):
    """S7 over a text key of which one value holds a third of the rows and some rows have
    none: ranges over (key, order, line) from a merged sketch, one WHERE clause each."""
    src = fx.hot_text(Tables(spark, sf_dir))
    keys, n = ["part_name", "l_orderkey", "l_linenumber"], 8
    cuts = split_points(src, keys, n)
    sizes = src.groupBy(range_number(keys, cuts).alias("r")).count().collect()
    if len(sizes) != n or max(r["count"] for r in sizes) * n > 2 * sum(r["count"] for r in sizes):
        raise AssertionError(f"uneven ranges: {sizes}")
    return union_all([src.filter(p) for p in split_predicates(keys, cuts)])


# ---------------------------------------------------------------- S9 ----------
@register("parquet_recursive_scan", "SELECT * FROM events")
def q_parquet_recursive_scan(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    landing = new_work_dir(spark, "landing")
    # land the events in nested day folders, as a replication tool would
    (
        ev.withColumns({"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")})
        .write.partitionBy("y", "m", "d")  # three folder levels: y=/m=/d=
        .parquet(landing)
    )
    return read_recursive(spark, landing, schema=ev.schema)


# ---------------------------------------------------------------- K1-K11 ------
@register("snapshot_overwrite", "SELECT * FROM orders")
def q_snapshot_overwrite(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = new_work_dir(spark, "snapshot")
    K.write_snapshot(o.filter(F.col("o_orderstatus") == "F"), path)  # stale first version
    K.write_snapshot(o, path)
    return spark.read.parquet(path)


@register(
    "overwrite_merge_schema",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders""",
)
def q_overwrite_merge_schema(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = new_work_dir(spark, "evolving")
    K.write_snapshot(o, path)
    v2 = o.drop("o_orderpriority").withColumn("o_year", F.year("o_orderdate"))
    K.overwrite_merge_schema(spark, v2, path)
    return spark.read.parquet(path)


@register("single_file_export", None)
def q_single_file_export(spark, sf_dir):
    df = marts.domestic_settlement(Tables(spark, sf_dir))
    path = new_work_dir(spark, "export")
    K.export_single_file(df, path)
    files = [f for f in list_files(spark, path) if f.rsplit("/", 1)[-1].startswith("part-")]
    if len(files) != 1:
        raise AssertionError(f"expected one data file, found {len(files)}")
    return _portable(spark.read.parquet(path))


@register(
    "partitioned_full_load",
    fx.with_ctes(fx.SQL_FULL_LOAD_RAW)
    + f"""SELECT {_ORDER_SELECT}, TRY_CAST(update_ts_dms AS TIMESTAMP) AS update_ts_dms,
       TIMESTAMP '{fx.RUN_TS}' AS last_applied_date
FROM full_load_raw""",
)
def q_partitioned_full_load(spark, sf_dir):
    from lakeshift.plans.migrate import full_load

    raw = fx.full_load_raw(Tables(spark, sf_dir))
    loc = new_work_dir(spark, "full_load")
    table = "orders_" + loc.rsplit("-", 1)[-1]
    created = full_load(spark, raw, CHECK_DB, table, ["o_orderstatus"], fx.RUN_TS, location=loc)
    again = full_load(spark, raw, CHECK_DB, table, ["o_orderstatus"], fx.RUN_TS, location=loc)
    if not created or again:
        raise AssertionError("full load must create once and then leave the table alone")
    return spark.table(f"{CHECK_DB}.{table}")


@register(
    "full_load_job",
    fx.with_ctes(fx.SQL_FULL_LOAD_RAW)
    + f"""SELECT {_ORDER_SELECT}, TRY_CAST(update_ts_dms AS TIMESTAMP) AS update_ts_dms,
       TIMESTAMP '{fx.RUN_TS}' AS last_applied_date
FROM full_load_raw""",
)
def q_full_load_job(spark, sf_dir):
    """M5 as the job runs it: landed files to a partitioned table of versions, once."""
    from lakeshift.plans.jobs import full_load_job

    base = new_work_dir(spark, "full_load_job")
    fx.full_load_raw(Tables(spark, sf_dir)).write.parquet(f"{base}/raw")
    args = dict(raw_path=f"{base}/raw", warehouse=f"{base}/warehouse", database=CHECK_DB, table_name="orders_" + base.rsplit("-", 1)[-1], partition_key="o_orderstatus", run_ts=fx.RUN_TS)
    made, again = full_load_job(spark, **args), full_load_job(spark, **args)
    if (made["status"], again["status"]) != ("created", "exists"):
        raise AssertionError(f"{made['status']}, then {again['status']}")
    return spark.table(made["table"])


@register("manifest_export", "SELECT * FROM lineitem")
def q_manifest_export(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    path = new_work_dir(spark, "manifested")
    K.write_snapshot(li, path)
    K.write_manifest(spark, path, f"{path}_manifest")
    li.limit(1).write.mode("append").parquet(path)  # a later file is not in the manifest
    return K.read_manifest(spark, f"{path}_manifest")


@register("register_external_table", "SELECT * FROM orders")
def q_register_external_table(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    path = new_work_dir(spark, "external")
    K.write_snapshot(o, path)
    name = K.register_table(spark, CHECK_DB, "orders_ext", path, schema=o.schema)
    return spark.table(name)


@register(
    "evolving_versions",
    """SELECT o_orderkey AS id, CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(20,4)) AS DOUBLE) AS price, o_orderkey % 3 AS version,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS status,
  CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END AS customer, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS old_customer
FROM orders""",
)
def q_evolving_versions(spark, sf_dir):
    """K2 over three versions: a key and a price widen, a struct gains fields, a column goes. No version is rewritten."""
    o = Tables(spark, sf_dir).orders
    base, price = new_work_dir(spark, "evolving"), F.col("o_totalprice").cast("decimal(12,2)")
    part = [o.filter(F.col("o_orderkey") % 3 == k) for k in range(3)]
    status, customer = F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer")
    versions = [
        part[0].select(F.col("o_orderkey").cast("int").alias("id"), price.alias("price"), F.lit(0).alias("version"), F.col("o_custkey").alias("old_customer")),
        part[1].select(F.col("o_orderkey").cast("int").alias("id"), price.alias("price"), F.lit(1).cast("short").alias("version"), F.struct(status, customer).alias("about")),
        part[2].select(
            "o_orderkey", price.cast("decimal(20,4)").alias("price"), F.lit(2).cast("byte").alias("version"),
            F.struct(F.col("o_orderpriority").alias("priority"), customer, status).alias("about"),
        ).withColumnRenamed("o_orderkey", "id"),
    ]
    for k, v in enumerate(versions):
        v.write.parquet(f"{base}/v{k}")
    rows = read_versions(spark, [f"{base}/v{k}" for k in range(3)])
    if rows.select("id", "price", "version").dtypes != [("id", "bigint"), ("price", "decimal(20,4)"), ("version", "int")]:
        raise AssertionError(rows.schema)
    return _portable(rows.select("id", "price", F.col("version").cast("bigint").alias("version"), "about.status", "about.priority", "about.customer", "old_customer"))


@register("clustered_files", "SELECT * FROM lineitem")
def q_clustered_files(spark, sf_dir):
    """K4, M3: files within twice their target size; a range of either clustering column leaves files out."""
    li = Tables(spark, sf_dir).lineitem
    path, plain = new_work_dir(spark, "clustered"), new_work_dir(spark, "plain")
    li.write.parquet(plain)
    whole = sum(r["bytes"] for r in K.manifest_entries(spark, plain).select("bytes").collect())
    target = min(whole // 20, MOST_FILE_BYTES)  # a file is written by one task
    write_clustered(li, path, ["l_partkey", "l_shipdate"], target)
    sizes = [r["bytes"] for r in K.manifest_entries(spark, path).select("bytes").collect()]
    mean = sum(sizes) / len(sizes)
    if not target / 2 <= mean <= 2 * target or max(sizes) > 2 * target:
        raise AssertionError(f"target {target}, sizes {sorted(sizes)}")
    rows = spark.read.parquet(path)
    for c in ("l_partkey", "l_shipdate"):
        bounds = rows.groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
        cut = li.agg(F.expr(f"percentile_approx({'unix_date(CAST(l_shipdate AS DATE))' if c == 'l_shipdate' else c}, 0.1)")).first()[0]
        low = F.unix_date(F.col("lo").cast("date")) if c == "l_shipdate" else F.col("lo")
        met = bounds.filter(low <= cut).count()
        if 2 * met > len(sizes):
            raise AssertionError(f"a tenth of {c} meets {met} of {len(sizes)} files")
    return rows


# ---------------------------------------------------------------- ST1/ST2 -----
@register(
    "incremental_ingest",
    """SELECT *, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS intake_batch
FROM events""",
)
def q_incremental_ingest(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    base = new_work_dir(spark, "intake")
    landing, sink, ckpt = f"{base}/landing", f"{base}/sink", f"{base}/checkpoint"
    day = F.dayofmonth("ts")
    drops = [ev.filter(day <= 10), ev.filter((day > 10) & (day <= 20)), ev.filter(day > 20)]
    for i, drop in enumerate(drops):
        drop.write.parquet(f"{landing}/drop_{i}")
        ingest_available(spark, f"{landing}/*", ev.schema, sink, ckpt)
        if i == 1:  # a run with nothing new must add nothing
            ingest_available(spark, f"{landing}/*", ev.schema, sink, ckpt)
    return spark.read.parquet(sink)


@register("intake_rewritten_and_late", "SELECT * FROM events")
def q_intake_rewritten_and_late(spark, sf_dir):
    """ST1 by ledger: a file that is rewritten replaces its rows, one that lands with an old time is not missed."""
    ev = Tables(spark, sf_dir).events
    base, day = new_work_dir(spark, "ledger"), F.dayofmonth("ts")
    landing, sink = f"{base}/landing", f"{base}/sink"
    drops = [ev.filter(day <= 10), ev.filter((day > 10) & (day <= 20)), ev.filter(day > 20)]

    def land(i, df):
        df.coalesce(1).write.mode("overwrite").parquet(f"{landing}/drop_{i}")
        return next(f for f in list_files(spark, f"{landing}/drop_{i}") if f.endswith(".parquet"))

    land(1, drops[1])
    wrong = land(0, drops[0].withColumn("value", F.col("value") + 1))
    batches = [take_in(spark, f"{landing}/*/*.parquet", ev.schema, sink)]
    right = land(2, drops[0])  # the first file again, in place
    fs, p = hadoop_fs(spark, right)
    fs.delete(hadoop_fs(spark, wrong)[1], True)
    fs.rename(p, hadoop_fs(spark, wrong)[1])
    late = land(2, drops[2])
    set_file_time(spark, late, dt.datetime(2020, 1, 1))
    batches += [take_in(spark, f"{landing}/*/*.parquet", ev.schema, sink), take_in(spark, f"{landing}/*/*.parquet", ev.schema, sink)]
    if batches != [0, 1, None]:
        raise AssertionError(f"batches {batches}")
    return current(spark, sink, ev.schema).drop(FILE, BATCH)


@register("incremental_cdc_apply", _SQL_LATEST)
def q_incremental_cdc_apply(spark, sf_dir):
    t = Tables(spark, sf_dir)
    feed = fx.cdc_many_feed(t)
    base = new_work_dir(spark, "cdc_stream")
    table = K.VersionedTable(
        spark, f"{base}/table", CHECK_DB, "user_state_" + base.rsplit("-", 1)[-1], bucket_by=["user_id"], buckets=8
    )
    table.commit(fx.cdc_many_target(t), 0)
    day = F.dayofmonth("ts")
    for i, drop in enumerate([feed.filter(day <= 15), feed.filter(day > 15)]):
        drop.write.parquet(f"{base}/landing/drop_{i}")
        apply_available(spark, f"{base}/landing/*", feed.schema, table, "user_id", ["ts", "event_id"], f"{base}/ckpt")
    return table.read()


def _bucketed(spark, name: str, rows: DataFrame, buckets: int = 16) -> BucketedTable:
    base = new_work_dir(spark, name)
    table = BucketedTable(spark, f"{base}/table", CHECK_DB, f"{name}_" + base.rsplit("-", 1)[-1], "user_id", buckets)
    table.create(rows)
    return table


@register("bucketed_cdc_apply", _SQL_LATEST)
def q_bucketed_cdc_apply(spark, sf_dir):
    """ST2 with J4 on a bucketed table, read back through the catalog."""
    t = Tables(spark, sf_dir)
    feed = fx.cdc_many_feed(t)
    table = _bucketed(spark, "bucketed", fx.cdc_many_target(t))
    base = table.root.rsplit("/", 1)[0]
    day = F.dayofmonth("ts")
    for i, drop in enumerate([feed.filter(day <= 15), feed.filter(day > 15)]):
        drop.write.parquet(f"{base}/landing/drop_{i}")
        apply_available(spark, f"{base}/landing/*", feed.schema, table, "user_id", ["ts", "event_id"], f"{base}/ckpt")
    return spark.table(table.name()).drop(BUCKET)


@register(
    "bucketed_apply_touched",
    fx.with_ctes(fx.SQL_CDC_MANY)
    + f"""SELECT 16 AS buckets, 1 AS rewritten, 15 AS carried, count(*) + 1 AS n_rows, CAST(sum(user_id) + (SELECT max(user_id) FROM events) AS BIGINT) AS key_sum
FROM many_target WHERE user_id <> (SELECT max(user_id) FROM events)""",
)
def q_bucketed_apply_touched(spark, sf_dir):
    """ST2: a batch that changes one key rewrites one bucket; the others are carried by reference."""
    t = Tables(spark, sf_dir)
    table = _bucketed(spark, "touched", fx.cdc_many_target(t))
    before = table._state(0)[1]
    feed = fx.cdc_many_feed(t).filter("Op <> 'D'")
    top = t.events.agg(F.max("user_id")).first()[0]
    # all changes, as if they were one user's
    done = table.apply(feed.withColumn("user_id", F.lit(top)), ["ts", "event_id"])
    after = table._state(done["version"])[1]
    if sum(after[b] != before.get(b) for b in after) != 1:
        raise AssertionError(f"buckets {before} became {after}")
    rows = table.read()
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("user_id").alias("key_sum")).select(
        F.lit(table.buckets).alias("buckets"), F.lit(done["rewritten"]).alias("rewritten"), F.lit(done["carried"]).alias("carried"), "n_rows", "key_sum"
    )


# ---------------------------------------------------------------- M1/M2/M4 ----
def _parquet_reader(spark, sf_dir):
    t = Tables(spark, sf_dir)

    def read(database, table, classes):
        return typed_projection(getattr(t, table), classes)

    return read


def _migrate_driver_tables(spark, sf_dir, tables):
    t = Tables(spark, sf_dir)
    classes = {(SOURCE_DB, n): classes_from_schema(SOURCE_DB, n, getattr(t, n).schema) for n in tables}
    root = new_work_dir(spark, "migrated")
    status = migrate_tables(
        spark, [(SOURCE_DB, n) for n in tables], classes, _parquet_reader(spark, sf_dir), root,
        target_database=CHECK_DB + "_" + root.rsplit("-", 1)[-1], parallel_tables=8,
    )
    return status, CHECK_DB + "_" + root.rsplit("-", 1)[-1]


@register(
    "migrate_tables",
    "\nUNION ALL\n".join(
        f"SELECT '{SOURCE_DB}' AS database, '{n}' AS table_name, 'ok' AS status, count(*) AS rows_written, "
        f"CAST(0 AS BIGINT) AS values_nulled, CAST(NULL AS VARCHAR) AS error FROM {n}"
        for n in DRIVER_TABLES
    ),
)
def q_migrate_tables(spark, sf_dir):
    status, _ = _migrate_driver_tables(spark, sf_dir, DRIVER_TABLES)
    return status


def _migrated_values(name: str) -> Query:
    def run(spark, sf_dir):
        status, db = _migrate_driver_tables(spark, sf_dir, [name])
        row = status.first()
        if row["status"] != "ok" or row["values_nulled"]:
            raise RuntimeError(str(row))
        out = spark.table(f"{db}.{name}")
        if name == "embeddings":  # arrays are shown value by value
            out = out.select("vec_id", F.posexplode("embedding").alias("at", "value"), "label").withColumn("value", F.col("value").cast("double"))
        return out

    return run


for _name in DRIVER_TABLES:
    if _name == "embeddings":
        _sql = "SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS at, CAST(unnest(embedding) AS DOUBLE) AS value, label FROM embeddings"
    else:
        _sql = f"SELECT * FROM {_name}"
    register("migrated_table_values" if _name == "lineitem" else f"migrated_{_name}_values", _sql)(_migrated_values(_name))


@register("migration_restart", "SELECT * FROM lineitem")
def q_migration_restart(spark, sf_dir):
    """M1, M2: a run that loses its source in the middle, and a rerun that reads only the ranges still missing."""
    src = Tables(spark, sf_dir).lineitem
    keys, root = ["l_orderkey", "l_linenumber"], new_work_dir(spark, "restart")
    read: list[str] = []

    def plan():
        return split_predicates(keys, split_points(src, keys, 6))

    def reader(predicate, fail=()):
        read.append(predicate)
        if len(read) in fail:
            raise IOError("source went away")
        return src.filter(predicate)

    try:
        migrate_ranges(spark, lambda p: reader(p, fail=(3, 5)), plan, root, parallel_ranges=1)
        raise AssertionError("the first run should have failed")
    except RangesFailed as e:
        lost = sorted(e.failed)
    first, read[:] = list(read), []
    ledger, again = migrate_ranges(spark, reader, plan, root, parallel_ranges=1)
    if again != lost or sorted(read) != sorted(first[i] for i in lost):
        raise AssertionError(f"lost {lost}, read again {again}: {read}")
    return ledger.read()


_PROVED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "migration_value_proof",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {'false' if c == 'o_totalprice' else 'true'} AS proven, count(*) AS n_rows FROM orders" for c in _PROVED
    ),
)
def q_migration_value_proof(spark, sf_dir):
    """M1, M2: hashes gathered by the write, against the table after one value of one
    column was raised by a cent: that column, and no other, is named."""
    orders = Tables(spark, sf_dir).orders
    path, damaged = new_work_dir(spark, "proof"), new_work_dir(spark, "proof")
    observed = Observation("proof_" + path.rsplit("-", 1)[-1])
    observe_proof(orders, observed).write.parquet(path)
    proof = observed_proof(observed, orders.columns)
    written = spark.read.parquet(path)
    if unproven_columns(written, proof):
        raise AssertionError("an intact copy is reported as damaged")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    cent = F.when(F.col("o_orderkey") == top, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))
    written.withColumn("o_totalprice", cent).write.parquet(damaged)
    wrong = unproven_columns(spark.read.parquet(damaged), proof)
    names = F.explode(F.array(*map(F.lit, orders.columns))).alias("column_name")
    return spark.read.parquet(damaged).agg(F.count(F.lit(1)).alias("n_rows")).select(names, "n_rows").withColumn("proven", ~F.col("column_name").isin(wrong))


_SQL_MIGRATION_STATUS = (
    fx.with_ctes(fx.SQL_DIRTY_DATES, fx.SQL_DIRTY_DATETIMES, fx.SQL_TINYINT_FLAGS)
    + """SELECT 'legacy' AS database, 'dirty_dates' AS table_name, 'ok' AS status, count(*) AS rows_written,
       CAST(sum(CASE WHEN order_date_raw IS NOT NULL AND TRY_CAST(replace(replace(order_date_raw,
            '0000-00-00', '1900-01-01'), '-00', '-01') AS DATE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS values_nulled,
       CAST(NULL AS VARCHAR) AS error
FROM dirty_dates
UNION ALL
SELECT 'legacy', 'dirty_datetimes', 'ok', count(*),
       CAST(sum(CASE WHEN ts_raw IS NOT NULL AND try_strptime(regexp_replace(replace(ts_raw, '0000-00-00 00:00:00',
            '1970-01-01 00:00:00'), '[.][0-9]+$', ''), '%Y-%m-%d %H:%M:%S') IS NULL THEN 1 ELSE 0 END) AS BIGINT), NULL
FROM dirty_datetimes
UNION ALL
SELECT 'legacy', 'tinyint_flags', 'ok', count(*), CAST(0 AS BIGINT), NULL FROM tinyint_flags
UNION ALL
SELECT 'legacy', 'missing_table', 'failed', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
       'no catalogue entry for legacy.missing_table'"""
)


@register("migration_status", _SQL_MIGRATION_STATUS)
def q_migration_status(spark, sf_dir):
    from lakeshift.sources.catalog import CATALOG_SCHEMA

    t = Tables(spark, sf_dir)
    sources = {
        "dirty_dates": (fx.dirty_dates(t), {"order_date_raw": "date"}),
        "dirty_datetimes": (fx.dirty_datetimes(t), {"ts_raw": "datetime"}),
        "tinyint_flags": (fx.tinyint_flags(t), {"flag_raw": "tinyint"}),
    }
    rows = []
    for name, (df, special) in sources.items():
        for i, c in enumerate(df.columns, start=1):
            dt = special.get(c, "bigint")
            rows.append(("legacy", name, c, i, "YES", dt, dt, "", ""))
    classes = column_classes(spark.createDataFrame(rows, CATALOG_SCHEMA))
    root = new_work_dir(spark, "legacy")
    status = migrate_tables(
        spark,
        [("legacy", n) for n in [*sources, "missing_table"]],
        classes,
        lambda db, tb, cls: sources[tb][0],
        root,
        target_database=CHECK_DB,
    )
    report = f"{root}/_status"
    K.export_single_file(status, report)
    return spark.read.parquet(report)


# ---------------------------------------------------------------- K13 ---------
_SQL_DOMESTIC = """SELECT n.n_name, strftime(o.o_orderdate, '%Y-%m') AS order_month,
       CAST(CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(15,2)))) AS DECIMAL(20,4)) AS DOUBLE) AS revenue,
       count(*) AS lines, count(DISTINCT o.o_orderkey) AS orders
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN supplier s ON s.s_suppkey = l.l_suppkey AND s.s_nationkey = c.c_nationkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name, strftime(o.o_orderdate, '%Y-%m')"""
ORACLE_SQL["single_file_export"] = _SQL_DOMESTIC

_SQL_MARTS = {
    "company_integration": """WITH per AS (
  SELECT l_suppkey, count(*) AS lines,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DECIMAL(20,4)) AS revenue
  FROM lineitem GROUP BY l_suppkey)
SELECT s.s_suppkey, s.s_name, n.n_name, r.r_name, CAST(CAST(s.s_acctbal AS DECIMAL(15,2)) AS DOUBLE) AS s_acctbal,
       CAST(coalesce(p.lines, 0) AS BIGINT) AS lines, CAST(coalesce(p.revenue, CAST(0 AS DECIMAL(20,4))) AS DOUBLE) AS revenue
FROM supplier s
LEFT JOIN per p ON p.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "user_information": """WITH per AS (
  SELECT o_custkey, count(*) AS order_count,
         CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total_spent,
         CAST(min(CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS first_order_date,
         CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS last_order_date
  FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name AS nation,
       CAST(coalesce(p.order_count, 0) AS BIGINT) AS order_count,
       CAST(coalesce(p.total_spent, CAST(0 AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
       p.first_order_date, p.last_order_date
FROM customer c
LEFT JOIN per p ON p.o_custkey = c.c_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "reservation_information": f"""SELECT strftime(o_orderdate, '%Y-%m') AS order_month, o_orderstatus,
       count(*) AS n_orders, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS DOUBLE) AS total
FROM orders WHERE o_orderdate < TIMESTAMP '{fx.MART_TODAY} 00:00:00'
GROUP BY strftime(o_orderdate, '%Y-%m'), o_orderstatus""",
    "domestic_settlement": _SQL_DOMESTIC,
}


def _portable(df: DataFrame) -> DataFrame:
    """Presentation for the cross-engine check only: exact decimals as double
    (a correctly rounded conversion in both engines) and dates as midnight
    timestamps, the types every client renders the same way."""

    def show(c: str, t: str):
        if t.startswith("decimal"):
            return F.col(c).cast("double").alias(c)
        if t == "date":
            return F.col(c).cast("timestamp_ntz").alias(c)
        return F.col(c)

    return df.select([show(c, t) for c, t in df.dtypes])


def _mart_query(name: str) -> Query:
    def run(spark, sf_dir):
        t = Tables(spark, sf_dir)
        fn = marts.MARTS[name]
        df = fn(t, fx.MART_TODAY) if name == "reservation_information" else fn(t)
        root = new_work_dir(spark, "marts")
        marts.refresh_mart(spark, df.limit(0), root, CHECK_DB, name)  # an older version, which the refresh replaces
        return _portable(marts.refresh_mart(spark, df, root, CHECK_DB, name))

    return run


for _name in marts.REFRESH_ORDER:
    register(f"mart_{_name}", _SQL_MARTS[_name])(_mart_query(_name))
