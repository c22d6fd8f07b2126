"""Bucketed tables, the key index, ordered applies, MERGE sources and commit order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import cdc
from lakeshift.session import path_exists
from lakeshift.sinks import keyindex, merge
from lakeshift.sinks.buckets import BUCKET, BucketedTable
from lakeshift.sinks.snapshot import VersionedTable

FEED = "Op string, k bigint, j string, v string, seq bigint"
ROWS = "k bigint, j string, v string"


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def _table(spark, workdir, rows, buckets=8, key=("k",)):
    t = BucketedTable(spark, workdir, "bucket_tests", "t_" + workdir.rsplit("-", 1)[-1], list(key), buckets)
    t.create(spark.createDataFrame(rows, ROWS))
    return t


def test_bucketed_apply_equals_a_whole_rewrite(spark, workdir):
    r = random.Random(3)
    rows = [(i, "a", f"v{i}") for i in range(60)] + [(None, "a", "x"), (None, "b", "y")]
    t, plain = _table(spark, workdir, rows), spark.createDataFrame(rows, ROWS)
    for batch in range(3):
        changes = [(r.choice("IUDX") if r.random() < 0.9 else None, r.choice([None, *range(70)]), "a", f"b{batch}", s) for s in range(12)]
        feed = spark.createDataFrame(changes, FEED)
        t.apply(feed, ["seq"])
        plain = cdc.apply_latest(plain, feed, "k", ["seq"])
        assert _sorted(t.read()) == _sorted(plain) == _sorted(spark.table(t.name()).drop(BUCKET))
    assert t.apply(feed, ["seq"])["rewritten"] >= 1  # replayed: nothing changes
    assert _sorted(t.read()) == _sorted(plain)


def test_untouched_buckets_are_carried_and_emptied_ones_go(spark, workdir):
    t = _table(spark, workdir, [(i, "a", "v") for i in range(40)])
    before = t._state(0)[1]
    done = t.apply(spark.createDataFrame([("U", 7, "a", "new", 1)], FEED), ["seq"])
    after = t._state(1)[1]
    assert done["rewritten"] == 1 and done["carried"] == len(before) - 1
    assert sum(after[b] != before[b] for b in after) == 1
    narrow = spark.createDataFrame([("U", 7, "a", "newer", 2)], "Op string, k int, j string, v string, seq bigint")
    assert t.apply(narrow, ["seq"])["rewritten"] == 1  # a narrower type of the key is the same key
    gone = t.read().select(F.lit("D").alias("Op"), "k", "j", "v", F.lit(3).alias("seq"))
    t.apply(gone, ["seq"])
    assert t.read().count() == 0 and t._state(3)[1] == {} and spark.table(t.name()).count() == 0
    assert t.read(0).count() == 40


def test_bucketed_j3_composite_keys_and_vacuum(spark, workdir):
    t = _table(spark, workdir, [(1, "a", "x"), (1, "b", "y"), (None, "a", "z")], key=("k", "j"))
    feed = spark.createDataFrame([("U", 1, "a", "X"), ("D", 1, "b", None), ("I", None, "a", "z"), ("I", 2, None, "w")], "Op string, k bigint, j string, v string")
    t.apply(feed)
    want = [(1, "a", "X"), (2, None, "w"), (None, "a", "z")]
    assert _sorted(t.read()) == want
    with pytest.raises(cdc.DuplicateKeyError):
        t.apply(feed.unionByName(feed))
    assert t.current_version() == 1 and _sorted(t.read()) == want
    assert t.vacuum(keep=1) and _sorted(t.read()) == want and t.versions() == [1]
    assert t.apply(feed.limit(0))["rewritten"] == 0 and _sorted(t.read()) == want


def test_a_version_without_state_does_not_count(spark, workdir):
    t = _table(spark, workdir, [(1, "a", "x")])
    t._write(spark.createDataFrame([(1, "a", "half")], ROWS), 1)  # ends here
    assert t.current_version() == 0 and _sorted(t.read()) == [(1, "a", "x")]
    t.apply(spark.createDataFrame([("U", 1, "a", "y", 1)], FEED), ["seq"])
    assert _sorted(t.read()) == [(1, "a", "y")]


# -- files by key ---------------------------------------------------------------


def test_touched_files_hold_all_keys_and_few_others(spark, workdir):
    rows = spark.range(0, 4000).selectExpr("CASE WHEN id % 500 = 3 THEN NULL ELSE id * 10 END AS k", "CAST(id AS STRING) AS v")
    rows.repartitionByRange(10, "k").write.parquet(f"{workdir}/d")
    keyindex.write_key_index(spark, f"{workdir}/d", f"{workdir}/i", "k")
    where = spark.read.parquet(f"{workdir}/d").select("k", F.col("_metadata.file_path").alias("file"))
    for wanted in ([0], [50, 39990], [15, 25], [None], [], list(range(0, 4000, 10)), [-5, 10**9]):
        keys = spark.createDataFrame([(k,) for k in wanted], "k bigint")
        got = {r["file"] for r in keyindex.touched_files(spark, f"{workdir}/i", keys, "k").collect()}
        holding = {r["file"] for r in where.join(keys, where["k"].eqNullSafe(keys["k"]), "left_semi").select("file").distinct().collect()}
        assert holding <= got
        if wanted in ([], [-5, 10**9]):
            assert not got
        assert len(got) <= len(holding) + (1 if wanted in ([15, 25], [50, 39990]) else 0)


def test_filter_leaves_out_files_whose_range_holds_a_key_they_lack(spark, workdir):
    # every file spans all keys: only the filters can tell
    spark.range(0, 8000).selectExpr("id AS k").repartition(8, F.col("k") % 8).write.parquet(f"{workdir}/d")
    keyindex.write_key_index(spark, f"{workdir}/d", f"{workdir}/i", "k")
    files = spark.read.parquet(f"{workdir}/i/files").count()
    got = keyindex.touched_files(spark, f"{workdir}/i", spark.createDataFrame([(4001,)], "k bigint"), "k").count()
    assert files >= 3 and got < files


def test_filters_are_made_without_a_sort(spark, workdir):
    spark.range(0, 8000).selectExpr("id AS k").repartition(4, F.col("k") % 4).write.parquet(f"{workdir}/d")
    keyindex.write_key_index(spark, f"{workdir}/d", f"{workdir}/i", "k")
    index = spark.read.parquet(f"{workdir}/i/files")
    rows = spark.read.parquet(f"{workdir}/d").select(F.col("_metadata.file_path").alias("file"), "k")
    made = keyindex._filters(rows, index, "k")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan
    # no more rows than the filters have words, and the bits of every key
    words = made.agg(F.count(F.lit(1)), F.sum(F.bit_count("set"))).first()
    assert words[0] <= index.agg(F.sum("bits") / keyindex.WORD).first()[0] and words[1] <= 8000 * keyindex.HASHES
    got = keyindex.touched_files(spark, f"{workdir}/i", spark.range(0, 8000, 100).withColumnRenamed("id", "k"), "k")
    assert got.count() == rows.where("k % 100 = 0").select("file").distinct().count()


def test_text_keys(spark, workdir):
    spark.range(0, 500).selectExpr("concat('key', lpad(id, 5, '0')) AS k", "id").repartitionByRange(5, "k").write.parquet(f"{workdir}/d")
    keyindex.write_key_index(spark, f"{workdir}/d", f"{workdir}/i", "k")
    changed = spark.createDataFrame([("key00007", -1), ("key00499", -2), ("other", -3)], "k string, id bigint")
    schema = spark.read.parquet(f"{workdir}/d").schema
    new, files = keyindex.upsert_touched(spark, f"{workdir}/i", changed, "k", schema)
    assert len(files) == 2 and {tuple(r) for r in new.collect()} >= {("key00007", -1), ("key00499", -2), ("other", -3)}
    left, files = keyindex.delete_touched(spark, f"{workdir}/i", changed.limit(1), "k", schema)
    assert len(files) == 1 and left.filter("k = 'key00007'").isEmpty()


def test_a_version_keeps_its_index(spark, workdir):
    t = VersionedTable(spark, workdir, "bucket_tests", "i_" + workdir.rsplit("-", 1)[-1])
    t.commit(spark.range(0, 400).selectExpr("id AS k", "id % 3 AS v").repartitionByRange(8, "k"), 0)
    keys = spark.createDataFrame([(5,), (399,)], "k bigint")
    assert keyindex.touched_files(spark, t.key_index("k"), keys, "k").count() == 2
    made = t.key_index("k")
    t.commit(t.read().filter("k < 100"), 1)
    t.commit(t.read(), 2)
    assert t.key_index("k") != made and keyindex.touched_files(spark, t.key_index("k"), keys, "k").count() == 1
    t.vacuum(keep=1)
    assert not path_exists(spark, made)


# -- order across batches ---------------------------------------------------------


def test_any_order_of_batches_ends_alike(spark):
    r = random.Random(7)
    rows = spark.createDataFrame([(i, "a", "seed") for i in range(8)] + [(None, "n", "keyless")], ROWS)
    changes = [(r.choice("IUD"), r.choice([None, *range(12)]), "c", f"v{s}", s) for s in range(40)]
    whole = spark.createDataFrame(changes, FEED)
    want = _sorted(cdc.apply_latest(rows, whole, "k", ["seq"]))
    start = cdc.with_order(rows, ["seq"], dict(whole.dtypes))
    batches = [changes[0:14], changes[14:28], changes[28:40]]
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 2, 0, 1]):
        state = start
        for b in order:
            state = spark.createDataFrame(cdc.apply_ordered(state, spark.createDataFrame(batches[b], FEED), "k", ["seq"]).collect(), start.schema)
        assert _sorted(cdc.visible(state)) == want, order
    assert state.filter(cdc.DELETED_COLUMN).count() > 0
    kept = cdc.drop_tombstones(state, F.col(f"{cdc.ORDER_COLUMN}.seq") < 100)
    assert kept.filter(cdc.DELETED_COLUMN).isEmpty() and _sorted(cdc.visible(kept)) == want


# -- MERGE sources -----------------------------------------------------------------


def test_merge_sources_keep_rows_without_a_key(spark):
    feed = spark.createDataFrame([("U", None, "a", "x", 1), ("U", None, "a", "x", 2), ("I", None, "a", "y", 3), ("D", None, "a", "y", 4), ("U", 1, "a", "p", 5), ("D", 1, "a", "p", 6)], FEED)
    got = merge.latest_sources(feed, ["k"], ["seq"], ["k", "j", "v"])
    assert _sorted(got.select("k", "v", "Op", "__keyed")) == [(1, "p", "D", True), (None, "x", "U", False), (None, "y", "I", False)]
    j3 = merge.change_sources(feed.drop("seq"), ["k"], ["k", "j", "v"])
    assert _sorted(j3.select("k", "v", "__ups", "__dels", "__keyed")) == [(1, "p", 1, 1, True), (None, "x", 2, 0, False), (None, "y", 1, 0, False)]


def test_insert_new_statement_compares_whole_rows():
    sql = merge.insert_new_sql("db.t", "s1", ["k", "j"], ["k", "j", "v"])
    assert "(t.`k` IS NULL OR t.`j` IS NULL) AND t.`k` <=> s.`k` AND t.`j` <=> s.`j` AND t.`v` <=> s.`v`" in sql
    assert sql.endswith("WHEN NOT MATCHED THEN INSERT (`k`, `j`, `v`) VALUES (s.`k`, s.`j`, s.`v`)")


# -- commit order --------------------------------------------------------------------


def test_a_replay_completes_what_a_crash_left(spark, workdir):
    rows = spark.createDataFrame([(1, "001"), (2, "002")], "k int, dept string")
    t = VersionedTable(spark, workdir, "bucket_tests", "p_" + workdir.rsplit("-", 1)[-1], partition_by=["dept"])
    t._save_schema(rows.schema, 0)  # ends before the data
    assert t.current_version() is None
    t._save_schema(rows.schema, 0)
    t._write(rows, 0)  # ends before the catalog
    assert not t.commit(rows, 0)
    assert _sorted(t.read()) == _sorted(spark.table(t.name())) == [(1, "001"), (2, "002")]
    t.commit(rows.limit(1), 1)
    t.commit(rows.limit(1), 2)
    assert t.vacuum(keep=1) == [0, 1] and t.read().schema["dept"].dataType.simpleString() == "string"


def test_changes_do_not_run_jobs_before_they_are_read(spark):
    target = spark.createDataFrame([(1, "a", "x")], ROWS)
    feed = spark.createDataFrame([("U", 1, "a", "y", 1)], FEED)
    tag = f"apply-{dt.datetime.now().timestamp()}"
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        out = cdc.apply_latest(target, feed, "k", ["seq"])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
        assert _sorted(out) == [(1, "a", "y")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_the_feed_is_shuffled_once(spark, workdir):
    spark.range(0, 100).selectExpr("'U' AS Op", "id % 9 AS k", "id AS seq", "CAST(id AS STRING) AS v").write.parquet(workdir)
    target = spark.range(0, 50).selectExpr("id AS k", "'x' AS v")
    out = cdc.apply_latest(target, spark.read.parquet(workdir), "k", ["seq"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan")[0]
    assert "ReusedExchange" in plan
