import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import cdc

T0 = dt.datetime(2024, 1, 1)
SCHEMA_T = "k bigint, v string"
SCHEMA_F = "Op string, schema_name string, table_name string, k bigint, v string, ts timestamp_ntz, seq bigint"


def _feed(spark, rows):
    return spark.createDataFrame([(op, "s", "t", k, v, T0 + dt.timedelta(minutes=m), seq) for op, k, v, m, seq in rows], SCHEMA_F)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_and_counts_ignore_null_op(spark):
    f = _feed(spark, [("I", 1, "a", 0, 0), ("D", 2, None, 0, 1), (None, 3, "x", 0, 2), ("U", 4, "b", 0, 3)])
    ups, dels = cdc.split_changes(f)
    assert sorted(r.k for r in ups.collect()) == [1, 4]
    assert [r.k for r in dels.collect()] == [2]
    counts = {r.Op: r.n for r in cdc.op_counts(f).collect()}
    assert counts == {"I": 1, "D": 1, None: 1, "U": 1}


def test_apply_changes_upsert_then_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], SCHEMA_T)
    f = _feed(spark, [("U", 1, "A", 0, 0), ("D", 2, "b", 0, 1), ("I", 4, "d", 0, 2)])
    assert _rows(cdc.apply_changes(target.select("k", "v"), f.drop("ts", "seq"), "k")) == [(1, "A"), (3, "c"), (4, "d")]


def test_apply_changes_rejects_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA_T)
    f = _feed(spark, [("U", 1, "x", 0, 0), ("U", 1, "y", 1, 1)]).drop("ts", "seq")
    with pytest.raises(cdc.DuplicateKeyError):
        cdc.apply_changes(target, f, "k")


def test_delete_then_reinsert_differs_between_j3_and_j4(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA_T)
    f = _feed(spark, [("D", 1, "a", 0, 0), ("I", 1, "again", 1, 1)])
    j3 = cdc.apply_changes(target, f.drop("ts", "seq"), "k")
    j4 = cdc.apply_latest(target, f, "k", ["ts", "seq"], drop_cols=[*cdc.METADATA_COLUMNS, "ts", "seq"])
    assert _rows(j3) == []  # all deletes run after all upserts
    assert _rows(j4) == [(1, "again")]


def test_latest_tie_break_on_sequence(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA_T)
    # same timestamp; the sequence decides, whatever the input order
    f = _feed(spark, [("U", 1, "late", 5, 9), ("D", 1, None, 5, 3), ("U", 1, "mid", 5, 4)])
    out = cdc.apply_latest(target, f, "k", ["ts", "seq"], drop_cols=[*cdc.METADATA_COLUMNS, "ts", "seq"])
    assert _rows(out) == [(1, "late")]
    f2 = _feed(spark, [("U", 1, "x", 5, 1), ("D", 1, None, 5, 2)])
    out2 = cdc.apply_latest(target, f2, "k", ["ts", "seq"], drop_cols=[*cdc.METADATA_COLUMNS, "ts", "seq"])
    assert _rows(out2) == []


def test_j3_equals_j4_when_each_key_once_and_apply_is_idempotent(spark):
    from tests.conftest import SF_CHECK
    from lakeshift.queries import fixtures as fx

    t = fx.Tables(spark, SF_CHECK)
    target, feed = fx.cdc_one_target(t), fx.cdc_one_feed(t)
    j3 = cdc.apply_changes(target, feed, "o_orderkey")
    j4 = cdc.apply_latest(target, feed, "o_orderkey", ["o_orderkey"])
    assert _rows(j3) == _rows(j4)
    twice = cdc.apply_changes(j3, feed, "o_orderkey")
    assert _rows(twice) == _rows(j3)


def test_broadcast_and_shuffle_paths_agree(spark):
    target = spark.range(0, 500).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    f = spark.range(0, 500, 7).selectExpr(
        "CASE WHEN id % 2 = 0 THEN 'D' ELSE 'U' END AS Op", "'s' AS schema_name", "'t' AS table_name",
        "id AS k", "'new' AS v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = {}
    try:
        for threshold in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            rows[threshold] = _rows(cdc.apply_changes(target, f, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows["-1"] == rows["10m"]


def test_rows_without_a_key_are_neither_lost_nor_doubled(spark):
    target = spark.createDataFrame([(1, "a", "t"), (None, "b", "old"), (2, None, "u")], "k int, j string, v string")
    f = spark.createDataFrame(
        [("U", None, "b", "new"), ("I", None, "b", "old"), ("D", None, "b", None), ("U", 2, None, "w"), ("U", 1, "a", "x"), ("D", 2, None, None)],
        "Op string, k int, j string, v string").withColumn("seq", F.monotonically_increasing_id())
    want = [(1, "a", "x"), (2, None, "u"), (2, None, "w"), (None, "b", "new"), (None, "b", "old")]
    key = lambda r: tuple((x is None, x) for x in r)
    for apply in (lambda t: cdc.apply_changes(t, f.drop("seq"), ["k", "j"]), lambda t: cdc.apply_latest(t, f, ["k", "j"], ["seq"], drop_cols=["Op", "seq"])):
        once = apply(target)
        assert sorted((tuple(r) for r in once.collect()), key=key) == want
        assert sorted((tuple(r) for r in apply(once).collect()), key=key) == want


def test_latest_is_partially_aggregated(spark):
    f = spark.range(0, 1000).selectExpr("'U' AS Op", "0L AS k", "id AS seq", "CAST(id AS STRING) AS v")
    plan = cdc.latest_changes(f, "k", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert cdc.latest_changes(f, "k", ["seq"]).first().v == "999"


def test_stamp_changes(spark):
    f = spark.createDataFrame([("2024-01-01 00:00:01", 1)], "update_ts_dms string, k int")
    r = cdc.stamp_changes(f, "2024-02-01 00:00:00").first()
    assert r.update_ts_dms == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert r.last_applied_date == dt.datetime(2024, 2, 1)


def test_staged_reduction_gives_the_same_result(spark, workdir):
    target = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA_T)
    f = _feed(spark, [("U", 1, "x", 1, 1), ("U", 1, "y", 2, 2), ("D", 2, None, 1, 3), ("I", 3, "c", 1, 4)])
    drop = [*cdc.METADATA_COLUMNS, "ts", "seq"]
    plain = cdc.apply_latest(target, f, "k", ["ts", "seq"], drop_cols=drop)
    staged = cdc.apply_latest(target, f, "k", ["ts", "seq"], drop_cols=drop, stage_dir=f"{workdir}/stage")
    assert _rows(staged) == _rows(plain) == [(1, "y"), (3, "c")]
    assert "stage" in staged._jdf.queryExecution().executedPlan().toString()
