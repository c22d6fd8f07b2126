import pytest
from pyspark.sql import functions as F

from lakeshift.plans import jobs
from lakeshift.queries import fixtures as fx
from lakeshift.sources.catalog import CATALOG_SCHEMA
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def cdc_rows_expected(t):
    from lakeshift.operators import cdc

    return cdc.apply_changes(fx.cdc_one_target(t), fx.cdc_one_feed(t), "o_orderkey").count()


def test_full_load_then_cdc_batches(spark, workdir):
    t = fx.Tables(spark, SF_SMALL)
    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("update_ts_dms")
    full = fx.cdc_one_target(t).select(F.lit("I").alias("Op"), F.lit("tpch").alias("schema_name"),
                                       F.lit("orders").alias("table_name"), *fx.ORDER_COLS, ts)
    full.write.parquet(f"{raw}/full/2024/01/01")
    assert jobs.full_load_job(spark, raw_path=f"{raw}/nothing", warehouse=wh, database="lakeshift_jobs",
                              table_name="orders")["status"] == "no data"
    with pytest.raises(jobs.TableMissing):
        jobs.cdc_job(spark, raw_path=f"{raw}/cdc", warehouse=wh, database="lakeshift_jobs", table_name="orders",
                     primary_key="o_orderkey")
    r = jobs.full_load_job(spark, raw_path=f"{raw}/full", warehouse=wh, database="lakeshift_jobs",
                           table_name="orders", partition_key="o_orderstatus", run_ts="2024-02-01 00:00:00",
                           primary_key="o_orderkey", buckets=4)
    assert r["status"] == "created"
    assert r["rows"] == fx.cdc_one_target(t).count() and len(r["preview"]) == 5
    assert "o_orderkey" in r["preview"][0] and "o_orderkey" in r["ddl"]
    assert jobs.full_load_job(spark, raw_path=f"{raw}/full", warehouse=wh, database="lakeshift_jobs",
                              table_name="orders", partition_key="o_orderstatus")["status"] == "exists"
    loaded = spark.table("lakeshift_jobs.orders")
    assert loaded.count() == fx.cdc_one_target(t).count()
    assert "last_applied_date" in loaded.columns and "Op" not in loaded.columns

    feed = fx.cdc_one_feed(t).withColumn("update_ts_dms", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    feed.write.parquet(f"{raw}/cdc/2024/01/02")
    kw = dict(raw_path=f"{raw}/cdc", warehouse=wh, database="lakeshift_jobs", table_name="orders",
              primary_key="o_orderkey", partition_key="o_orderstatus", run_ts="2024-02-02 00:00:00", buckets=4)
    reports = jobs.cdc_job(spark, **kw)
    assert len(reports) == 1 and set(reports[0]["ops"]) == {"I", "U", "D", None}
    assert reports[0]["rows_after"] == cdc_rows_expected(t)
    # a run before any change file has landed is a no-op
    assert jobs.cdc_job(spark, **{**kw, "raw_path": f"{raw}/not_yet"}) == []
    assert jobs.cdc_job(spark, **kw) == []  # nothing new landed

    from lakeshift.operators import cdc

    expected = cdc.apply_changes(fx.cdc_one_target(t), fx.cdc_one_feed(t), "o_orderkey")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    got = spark.table("lakeshift_jobs.orders")
    assert _rows(got, cols) == _rows(expected, cols)
    price = {r.o_orderkey: r.o_totalprice for r in got.select("o_orderkey", "o_totalprice").collect()}
    want = {r.o_orderkey: r.o_totalprice for r in expected.select("o_orderkey", "o_totalprice").collect()}
    assert price == want
    stamped = got.filter(F.col("o_orderkey") % 5 == 1).select(F.min("last_applied_date")).first()[0]
    assert str(stamped) == "2024-02-02 00:00:00"


def test_migrate_job_with_file_reader(spark, workdir):
    spark.createDataFrame([("legacy", "dates", "o_orderkey"), ("legacy", "ghost", None)],
                          "database string, table string, key string").coalesce(1).write.option(
        "header", "true").csv(f"{workdir}/tables")
    spark.createDataFrame([
        ("legacy", "dates", "o_orderkey", 1, "NO", "bigint", "bigint", "PRI", ""),
        ("legacy", "dates", "order_date_raw", 2, "YES", "date", "date", "", ""),
    ], CATALOG_SCHEMA).coalesce(1).write.option("header", "true").csv(f"{workdir}/catalog")
    src = fx.dirty_dates(fx.Tables(spark, SF_SMALL))
    status = jobs.migrate_job(spark, table_list=f"{workdir}/tables", column_catalog=f"{workdir}/catalog",
                              warehouse=f"{workdir}/wh", status_path=f"{workdir}/status",
                              reader=lambda db, tb, cls: src)
    got = {r.table_name: (r.status, r.rows_written) for r in status.collect()}
    assert got == {"dates": ("ok", src.count()), "ghost": ("failed", None)}
    assert spark.table("legacy.dates").schema["order_date_raw"].dataType.typeName() == "date"


def test_marts_job_from_catalog_tables(spark, workdir):
    t = fx.Tables(spark, SF_SMALL)
    for n in ["orders", "customer", "nation", "region", "supplier", "lineitem"]:
        getattr(t, n).createOrReplaceTempView(n)
    out = jobs.marts_job(spark, tables=t, warehouse=workdir, database="lakeshift_jobs", today="2000-01-01",
                         only=["user_information"])
    assert out == {"user_information": "lakeshift_jobs.bi_user_information"}
    assert spark.table(out["user_information"]).count() == t.customer.count()


def test_business_midnight_is_seoul_day():
    import datetime as dt

    utc = dt.timezone.utc
    assert jobs.business_midnight(dt.datetime(2024, 1, 1, 16, 0, tzinfo=utc)) == "2024-01-02 00:00:00"
    assert jobs.business_midnight(dt.datetime(2024, 1, 1, 14, 59, tzinfo=utc)) == "2024-01-01 00:00:00"


def test_command_line_full_load_and_cdc(spark, workdir, capsys):
    import json

    rows = [("I", "s", "t", 1, "a", "2024-01-01 00:00:00"), ("I", "s", "t", 2, "b", "2024-01-01 00:00:00")]
    schema = "Op string, schema_name string, table_name string, id bigint, v string, update_ts_dms string"
    spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/raw/full/x")
    base = ["--warehouse", f"{workdir}/wh", "--database", "lakeshift_cli", "--table-name", "items",
            "--run-ts", "2024-02-01 00:00:00"]
    jobs.main(["full-load", "--raw-path", f"{workdir}/raw/full", "--primary-key", "id", "--buckets", "2", *base])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "created"
    spark.createDataFrame([("D", "s", "t", 1, None, "2024-01-02 00:00:00"), ("U", "s", "t", 2, "B", "2024-01-02 00:00:00")],
                          schema).write.parquet(f"{workdir}/raw/cdc/y")
    jobs.main(["cdc", "--raw-path", f"{workdir}/raw/cdc", "--primary-key", "id", "--buckets", "2", *base])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report[0]["ops"] == {"D": 1, "U": 1}
    assert [tuple(r) for r in spark.table("lakeshift_cli.items").select("id", "v").collect()] == [(2, "B")]


def test_daily_flow_migrates_then_builds_marts(spark, workdir):
    from lakeshift.plans import marts as M
    from lakeshift.sources.catalog import catalog_from_schema

    t = fx.Tables(spark, SF_SMALL)
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
    spark.createDataFrame([("daily_src", n, None) for n in names], "database string, table string, key string") \
        .coalesce(1).write.option("header", "true").csv(f"{workdir}/tables")
    cat = None
    for n in names:
        c = catalog_from_schema(spark, "daily_src", n, getattr(t, n).schema)
        cat = c if cat is None else cat.unionByName(c)
    cat.coalesce(1).write.option("header", "true").csv(f"{workdir}/catalog")
    from lakeshift.operators.projection import typed_projection

    out = jobs.daily_flow(spark, table_list=f"{workdir}/tables", column_catalog=f"{workdir}/catalog",
                          warehouse=f"{workdir}/wh", mart_database="daily_marts", today="2000-01-01",
                          reader=lambda db, tb, cls: typed_projection(getattr(t, tb), cls))
    assert out["migration"] == {"tables": 6, "failed": 0}
    got = spark.table(out["marts"]["domestic_settlement"])
    want = M.domestic_settlement(t)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())
    assert spark.table("daily_src.orders").schema["o_orderdate"].dataType.typeName() == "timestamp_ntz"


def test_migrate_job_through_the_jdbc_reader(spark, workdir, monkeypatch):
    """migrate_job's JDBC path (typed source SQL -> range read -> repair -> write),
    with Spark SQL standing in for the database: CONVERT(c, CHAR) is rendered as
    the text MySQL would return."""
    import re

    from lakeshift.sources import jdbc as J
    from lakeshift.sources.catalog import catalog_from_schema

    o = fx.Tables(spark, SF_SMALL).orders.withColumn("flag", (F.col("o_orderkey") % 2 == 0))
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    o.write.mode("overwrite").option("path", f"{workdir}/src").saveAsTable("shop.orders")

    def to_spark(sql):
        sql = re.sub(r"CONVERT\((`[^`]+`), CHAR\)", r"date_format(\1, 'yyyy-MM-dd HH:mm:ss')", sql)
        return sql.replace("`shop`.`orders`", "shop.orders")

    monkeypatch.setattr(J, "read_query", lambda s, src, q: s.sql(to_spark(q)))
    monkeypatch.setattr(J, "read_by_ranges", lambda s, src, q, key, ranges: J.union_all(
        [s.sql(f"SELECT * FROM ({to_spark(q)}) q WHERE {p}") for p in J.range_predicates(key, ranges)]))
    spark.createDataFrame([("shop", "orders", "o_orderkey")], "database string, table string, key string") \
        .coalesce(1).write.option("header", "true").csv(f"{workdir}/tables")
    catalog_from_schema(spark, "shop", "orders", o.schema).coalesce(1).write.option("header", "true") \
        .csv(f"{workdir}/catalog")
    status = jobs.migrate_job(spark, table_list=f"{workdir}/tables", column_catalog=f"{workdir}/catalog",
                              warehouse=f"{workdir}/wh", status_path=f"{workdir}/status",
                              jdbc=J.JdbcSource(url="jdbc:none"), num_partitions=4)
    r = status.first()
    assert (r.status, r.rows_written, r.values_nulled) == ("ok", o.count(), 0), r.error
    got = spark.table("shop.orders")  # now the migrated snapshot
    assert got.schema["o_orderdate"].dataType.typeName() == "timestamp_ntz"
    assert got.schema["flag"].dataType.typeName() == "integer"
    want = o.select("o_orderkey", "o_orderdate", F.col("flag").cast("int").alias("flag"))
    assert sorted(tuple(x) for x in got.select("o_orderkey", "o_orderdate", "flag").collect()) == \
        sorted(tuple(x) for x in want.collect())


def test_catalog_extract_job_with_spark_standing_in(spark, workdir, monkeypatch):
    from lakeshift.sources import catalog as C
    from lakeshift.sources import jdbc as J

    rows = [
        ("shop", "orders", "id", 1, "NO", "int", "int(11)", "PRI", "auto_increment"),
        ("shop", "orders", "created", 2, "YES", "datetime", "datetime", "", ""),
        ("other", "x", "y", 1, "YES", "int", "int(11)", "", ""),
    ]
    spark.sql("CREATE DATABASE IF NOT EXISTS information_schema")
    spark.createDataFrame(rows, C.CATALOG_SCHEMA).write.mode("overwrite") \
        .option("path", f"{workdir}/is").saveAsTable("information_schema.COLUMNS")
    monkeypatch.setattr(J, "read_query", lambda s, src, q: s.sql(q))
    n = jobs.catalog_extract_job(spark, jdbc=J.JdbcSource(url="jdbc:none"), schema_name="shop",
                                 out_path=f"{workdir}/catalog")
    assert n == 2
    cls = C.column_classes(C.read_column_catalog(spark, f"{workdir}/catalog", "parquet"))
    assert list(cls) == [("shop", "orders")]
    assert cls[("shop", "orders")].all == ["id", "created"] and cls[("shop", "orders")].datetime == ["created"]


def test_jobs_on_a_table_of_touched_buckets(spark, workdir):
    t = fx.Tables(spark, SF_SMALL)
    raw, wh = f"{workdir}/raw", f"{workdir}/wh"
    full = fx.cdc_one_target(t).select(F.lit("I").alias("Op"), F.lit("tpch").alias("schema_name"), F.lit("orders").alias("table_name"), *fx.ORDER_COLS)
    full.write.parquet(f"{raw}/full")
    kw = dict(warehouse=wh, database="lakeshift_touched", table_name="orders", primary_key="o_orderkey", touched_buckets=8)
    assert jobs.full_load_job(spark, raw_path=f"{raw}/full", run_ts="2024-02-01 00:00:00", **kw)["rows"] == full.count()
    assert jobs.full_load_job(spark, raw_path=f"{raw}/full", **kw)["status"] == "exists"
    fx.cdc_one_feed(t).write.parquet(f"{raw}/cdc")
    (report,) = jobs.cdc_job(spark, raw_path=f"{raw}/cdc", run_ts="2024-02-02 00:00:00", **kw)
    assert report["rewritten"] == 8 and report["rows_after"] == cdc_rows_expected(t)
    some = fx.cdc_one_feed(t).filter("o_orderkey = 1")
    some.write.mode("append").parquet(f"{raw}/cdc")
    (report,) = jobs.cdc_job(spark, raw_path=f"{raw}/cdc", run_ts="2024-02-03 00:00:00", **kw)
    assert report["rewritten"] == 1 and report["carried"] == 7
    assert spark.table("lakeshift_touched.orders").count() == cdc_rows_expected(t)
    with pytest.raises(ValueError, match="primary key"):
        jobs.keyed_table(spark, wh, "d", "t", "part", "k", None, 4)
