import pytest
from pyspark.sql import functions as F

from lakeshift.session import list_files, path_exists
from lakeshift.sinks import snapshot as K
from lakeshift.streaming.ingest import apply_available, cdc_batch_applier, ingest_available


def test_register_and_reregister_changed_schema(spark, workdir):
    a = spark.range(5).selectExpr("id", "'x' AS s")
    K.write_snapshot(a, f"{workdir}/v1")
    name = K.register_table(spark, "lakeshift_t", "t1", f"{workdir}/v1", schema=a.schema)
    assert spark.table(name).count() == 5
    b = a.withColumn("extra", F.lit(1))
    K.write_snapshot(b, f"{workdir}/v2")
    K.register_table(spark, "lakeshift_t", "t1", f"{workdir}/v2", schema=b.schema)
    assert spark.table(name).columns == ["id", "s", "extra"]
    assert K.table_exists(spark, "lakeshift_t", "t1")


def test_merge_schema_keeps_old_columns(spark, workdir):
    K.write_snapshot(spark.range(3).selectExpr("id", "'old' AS gone"), workdir)
    K.overwrite_merge_schema(spark, spark.range(2).selectExpr("id", "1 AS added"), workdir)
    out = spark.read.parquet(workdir)
    assert out.columns == ["id", "gone", "added"]
    assert sorted(tuple(r) for r in out.collect()) == [(0, None, 1), (1, None, 1)]


def test_single_file_export(spark, workdir):
    assert K.export_single_file(spark.range(10).repartition(4), workdir) == 10
    assert len([f for f in list_files(spark, workdir) if "part-" in f]) == 1
    assert K.export_single_file(spark.range(100), workdir, files=3) == 100
    assert len([f for f in list_files(spark, workdir) if "part-" in f]) == 3
    with pytest.raises(Exception):
        K.export_single_file(spark.range(3).selectExpr("raise_error('x') AS c"), workdir + "_b")
    assert not path_exists(spark, workdir + "_b__staging")


def test_partition_values_keep_their_type(spark, workdir):
    t = K.VersionedTable(spark, workdir, "lakeshift_t", "dept_text", partition_by=["dept"])
    for version in (0, 1):
        t.commit(spark.createDataFrame([("001", 1), ("1", 2), ("x", 3)], "dept string, k int") if not version else t.read(), version)
        assert sorted(tuple(r) for r in t.read().select("dept", "k").collect()) == [("001", 1), ("1", 2), ("x", 3)]
        assert sorted(r[0] for r in spark.table(t.name()).select("dept").collect()) == ["001", "1", "x"]


def test_bucketed_version_has_a_file_per_bucket(spark, workdir):
    t = K.VersionedTable(spark, workdir, "lakeshift_t", "few_files", bucket_by=["k"], buckets=4)
    t.commit(spark.range(0, 1000, numPartitions=8).selectExpr("id AS k"), 0)
    assert len([f for f in list_files(spark, t.path(0)) if "part-" in f]) == 4


def test_versioned_table_skips_replayed_version(spark, workdir):
    t = K.VersionedTable(spark, workdir, "lakeshift_t", "vt")
    assert t.commit(spark.range(3), 0)
    assert t.commit(spark.range(5), 1)
    assert not t.commit(spark.range(100), 1)
    assert t.read().count() == 5 and spark.table(t.name()).count() == 5
    with pytest.raises(ValueError):
        t.commit(spark.range(1), -1)  # older than the current version
    t.commit(spark.range(7), 2)
    assert t.vacuum(keep=2) == [0]
    assert t.versions() == [1, 2] and t.read().count() == 7


def test_manifest_lists_data_files(spark, workdir):
    df = spark.range(100).repartition(3)
    K.write_snapshot(df, f"{workdir}/data")
    n = K.write_manifest(spark, f"{workdir}/data", f"{workdir}/manifest")
    assert n == 3
    assert K.read_manifest(spark, f"{workdir}/manifest").count() == 100


def test_partitioned_create_once(spark, workdir):
    df = spark.range(10).selectExpr("id", "CAST(id % 3 AS STRING) AS p")
    assert K.create_partitioned_table(spark, df, "lakeshift_t", "pt", ["p"], location=workdir)
    assert not K.create_partitioned_table(spark, df.limit(1), "lakeshift_t", "pt", ["p"], location=workdir)
    assert spark.table("lakeshift_t.pt").count() == 10


def test_ingest_takes_only_new_files(spark, workdir):
    schema = "id bigint"
    land, sink, ck = f"{workdir}/land", f"{workdir}/sink", f"{workdir}/ck"
    spark.range(0, 10).write.parquet(f"{land}/a")
    ingest_available(spark, f"{land}/*", schema, sink, ck)
    ingest_available(spark, f"{land}/*", schema, sink, ck)  # nothing new
    spark.range(10, 15).write.parquet(f"{land}/b")
    ingest_available(spark, f"{land}/*", schema, sink, ck)
    out = spark.read.parquet(sink)
    assert out.count() == 15
    assert {r.intake_batch: r["count"] for r in out.groupBy("intake_batch").count().collect()} == {0: 10, 1: 5}


def test_cdc_stream_replay_is_harmless(spark, workdir):
    t = K.VersionedTable(spark, f"{workdir}/tbl", "lakeshift_t", "cdc_replay")
    t.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), 0)
    feed_schema = "Op string, k bigint, v string, seq bigint"
    batch = spark.createDataFrame([("U", 1, "A", 1), ("D", 2, None, 2)], feed_schema)
    apply = cdc_batch_applier(t, "k", ["seq"], stream_id="manual", drop_cols=["Op", "seq"])
    apply(batch, 0)
    apply(batch.limit(0), 0)  # replay of batch 0 after a crash: skipped
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "A")]
    # and through a real stream
    spark.createDataFrame([("I", 3, "c", 3)], feed_schema).write.parquet(f"{workdir}/land/x")
    apply_available(spark, f"{workdir}/land/*", feed_schema, t, "k", ["seq"], f"{workdir}/ck", drop_cols=["Op", "seq"])
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "A"), (3, "c")]
    assert t.versions() == [0, 1, 2]


def test_merge_sql_text_and_parquet_refusal(spark, workdir):
    from lakeshift.sinks import merge as M

    sql = M.latest_merge_sql("db.t", "src", ["k"], ["k", "v"])
    assert sql == (
        "MERGE INTO db.t t USING src s ON t.`k` = s.`k` WHEN MATCHED AND s.`Op` = 'D' THEN DELETE "
        "WHEN MATCHED THEN UPDATE SET `v` = s.`v` "
        "WHEN NOT MATCHED AND s.`Op` <> 'D' THEN INSERT (`k`, `v`) VALUES (s.`k`, s.`v`)"
    )
    assert M.delete_merge_sql("db.t", "d", ["a", "b"]).endswith("ON t.`a` = s.`a` AND t.`b` = s.`b` WHEN MATCHED THEN DELETE")
    K.write_snapshot(spark.range(2).selectExpr("id AS k", "'x' AS v"), workdir)
    name = K.register_table(spark, "lakeshift_t", "merge_target", workdir)
    assert M.table_provider(spark, name) == "parquet"
    feed = spark.createDataFrame([("U", 1, "y")], "Op string, k bigint, v string")
    with pytest.raises(ValueError):
        M.merge_latest(spark, name, feed, "k", ["k"])


def test_num_files_sets_output_file_count(spark, workdir):
    K.write_snapshot(spark.range(1000), workdir, num_files=5)
    assert len([f for f in list_files(spark, workdir) if "/part-" in f]) == 5


def test_backlog_is_applied_in_bounded_batches_in_landing_order(spark, workdir):
    import time

    t = K.VersionedTable(spark, f"{workdir}/tbl", "lakeshift_t", "backlog")
    t.commit(spark.createDataFrame([(1, "a")], "k bigint, v string"), 0)
    schema = "Op string, k bigint, v string, seq bigint"
    for i, rows in enumerate([[("U", 1, "b", 1)], [("D", 1, None, 2)], [("I", 1, "c", 3), ("I", 2, "d", 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{workdir}/land/f{i}")
        time.sleep(1.1)  # distinct modification times: landing order is file order
    apply_available(spark, f"{workdir}/land/*", schema, t, "k", ["seq"], f"{workdir}/ck",
                    max_files_per_trigger=1, drop_cols=["Op", "seq"])
    assert t.versions() == [0, 1, 2, 3]
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "c"), (2, "d")]


def test_bucketed_versions_avoid_target_shuffle(spark, workdir):
    from lakeshift.operators import cdc as C

    t = K.VersionedTable(spark, workdir, "lakeshift_t", "bucketed", bucket_by=["k"], buckets=8)
    t.commit(spark.range(0, 5000).selectExpr("id AS k", "CAST(id AS STRING) AS v"), 0)
    feed = spark.range(0, 5000, 7).selectExpr("IF(id % 2 = 0, 'D', 'U') AS Op", "id AS k", "'new' AS v", "id AS seq")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = C.apply_latest(t.read(), feed, "k", ["seq"], drop_cols=["Op", "seq"])
        out.write.format("noop").mode("overwrite").save()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        t.commit(out, 1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    got = t.read()
    assert got.count() == 5000 - len(range(0, 5000, 14))
    assert got.filter("v = 'new'").count() == len([i for i in range(0, 5000, 7) if i % 2])
    # the catalog pointer is repaired if it lags behind the newest version
    K.register_table(spark, "lakeshift_t", "bucketed", t.path(0), bucket_by=["k"], buckets=8)
    assert t.read().count() == got.count()


def test_ingest_with_exactly_once_file_sink(spark, workdir):
    land, sink, ck = f"{workdir}/land", f"{workdir}/sink", f"{workdir}/ck"
    spark.range(0, 7).write.parquet(f"{land}/a")
    ingest_available(spark, f"{land}/*", "id bigint", sink, ck, batch_column=None)
    spark.range(7, 9).write.parquet(f"{land}/b")
    ingest_available(spark, f"{land}/*", "id bigint", sink, ck, batch_column=None)
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(9))


def test_tables_with_row_level_writes_get_merges(spark, workdir, monkeypatch):
    from lakeshift.streaming import ingest

    seen = []
    monkeypatch.setattr(ingest, "merge_changes", lambda sp, table, feed, key, **kw: seen.append(("J3", table, key, feed.count())))
    monkeypatch.setattr(ingest, "merge_latest", lambda sp, table, feed, key, order, **kw: seen.append(("J4", table, key, feed.count())))
    feed = spark.createDataFrame([("U", 1, 1), ("D", 2, 2)], "Op string, k bigint, seq bigint")
    feed.write.parquet(f"{workdir}/landing")
    for order in (None, ["seq"]):
        reports = []
        apply_available(spark, f"{workdir}/landing", feed.schema, "db.t", "k", order, f"{workdir}/ckpt{order}", on_batch=lambda i, r: reports.append(r))
        assert reports == [{"ops": {"U": 1, "D": 1}}]
    assert seen == [("J3", "db.t", "k", 2), ("J4", "db.t", "k", 2)]
