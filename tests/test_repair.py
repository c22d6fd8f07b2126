import datetime as dt
import decimal

from pyspark.sql import functions as F

from lakeshift.functions import repair as R
from lakeshift.functions.ddl import schema_ddl


def test_zero_date_repair_literals(spark):
    rows = [
        ("0000-00-00", dt.date(1900, 1, 1)),
        ("2001-00-15", dt.date(2001, 1, 15)),
        ("2001-03-00", dt.date(2001, 3, 1)),
        ("2001-00-00", dt.date(2001, 1, 1)),
        ("2001-02-30", None),
        ("2001-05-06", dt.date(2001, 5, 6)),
        ("garbage", None),
        (None, None),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "d string")
    got = [r[0] for r in df.select(R.repair_zero_date("d")).collect()]
    assert got == [r[1] for r in rows]


def test_zero_datetime_repair_literals(spark):
    rows = [
        ("0000-00-00 00:00:00", dt.datetime(1970, 1, 1)),
        ("2024-01-05 10:11:12", dt.datetime(2024, 1, 5, 10, 11, 12)),
        ("2024-01-05 10:11:12.123456", None),
        ("0000-00-00 00:00:00.000000", None),
        ("2024-01-05", None),
        ("2024-00-05 10:11:12", None),
        (None, None),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "t string")
    out = df.select(R.repair_zero_datetime("t").alias("x"))
    assert out.schema["x"].dataType.typeName() == "timestamp_ntz"
    assert [r.x for r in out.collect()] == [r[1] for r in rows]


def test_datetime_repair_keeps_wall_clock_in_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string")
        assert df.select(R.repair_zero_datetime("t")).first()[0] == dt.datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_tinyint_and_transfer(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "b int")
    t = df.select(R.tinyint_transfer("b").alias("d"))
    assert t.schema["d"].dataType.simpleString() == "decimal(10,0)"
    assert [r.d for r in t.collect()] == [decimal.Decimal(1), decimal.Decimal(0), None]
    back = t.select(R.tinyint_to_int("d").alias("i"))
    assert [r.i for r in back.collect()] == [1, 0, None]


def test_time_text_and_change_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02 03:04:05.000007", )], "ts timestamp_ntz, s string")
    r = df.select(R.time_text("ts").alias("t"), R.change_timestamp("s").alias("c"), R.run_timestamp("2024-02-01 00:00:00").alias("run")).first()
    assert r.t == "03:04:05"
    assert r.c == dt.datetime(2024, 1, 2, 3, 4, 5, 7)
    assert r.run == dt.datetime(2024, 2, 1)
    bad = spark.createDataFrame([("n/a",)], "s string").select(R.change_timestamp("s")).first()[0]
    assert bad is None


def test_repair_observed_counts_nulled(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("2001-02-30", "2024-01-01 00:00:00"), ("0000-00-00", "bad"), (None, None)], "d string, t string")
    obs = Observation("t_obs")
    out = R.repair_observed(df, obs, date_cols=["d"], datetime_cols=["t"])
    assert out.columns == ["d", "t"]
    rows = out.collect()
    assert rows[1].d == dt.date(1900, 1, 1)
    assert obs.get == {"rows": 3, "nulled": 2}


def test_schema_ddl_nested_and_quoted(spark):
    df = spark.createDataFrame([], "`a b` bigint, arr array<float>, m map<string,int>, s struct<x:int,y:string>, d decimal(12,2)")
    ddl = schema_ddl(df)
    assert "`a b` BIGINT" in ddl
    again = spark.createDataFrame([], ddl)
    assert again.schema == df.schema


def test_datetime_repair_equals_strict_pattern_parse(spark):
    vals = ["2024-01-05 10:11:12", "2024-01-05 10:11:12.5", "2024-01-05", "2024-00-05 10:11:12",
            "2024-02-30 10:00:00", "2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-01-05 24:00:00",
            "2024-01-05 23:60:00", "2024-01-05 23:59:60", "12345-01-01 00:00:00", "0000-00-00 00:00:00",
            " 2024-01-05 10:11:12", "2024-01-05T10:11:12", "2024-1-05 10:11:12", "2024-01-05 1:11:12",
            "0001-01-01 00:00:00", "9999-12-31 23:59:59", "2024-13-01 00:00:00", "2024-01-05 10:11:12 ",
            "abc", None, "1900-01-01 00:00:00", "-024-01-01 00:00:00"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    strict = F.try_to_timestamp(
        F.replace("t", F.lit(R.ZERO_DATETIME), F.lit(R.ZERO_DATETIME_REPLACEMENT)), F.lit("yyyy-MM-dd HH:mm:ss")
    ).cast("timestamp_ntz")  # session zone is UTC here, so the cast is exact
    rows = df.select(R.repair_zero_datetime("t").alias("a"), strict.alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def _model_zero_date(text):
    """Plain-Python statement of F1 for well-formed YYYY-MM-DD text."""
    if text is None:
        return None
    t = text.replace("0000-00-00", "1900-01-01").replace("-00", "-01")
    y, m, d = (int(x) for x in t.split("-"))
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


def test_zero_date_repair_matches_model(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    texts = st.one_of(
        st.just("0000-00-00"),
        st.tuples(st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32)).map(
            lambda p: f"{p[0]:04d}-{p[1]:02d}-{p[2]:02d}"
        ),
    )

    @settings(max_examples=5, deadline=None)
    @given(values=st.lists(texts, min_size=200, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "d string")
        got = [r[0] for r in df.select(R.repair_zero_date("d")).collect()]
        assert got == [_model_zero_date(v) for v in values]

    check()


def _model_zero_datetime(text):
    import re

    if text is None:
        return None
    t = text.replace("0000-00-00 00:00:00", "1970-01-01 00:00:00")
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}", t):
        return None
    y, mo, d, h, mi, s = (int(x) for x in re.split(r"[- :]", t))
    try:
        return dt.datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None


def test_zero_datetime_repair_matches_model(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    parts = st.tuples(st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32),
                      st.integers(0, 25), st.integers(0, 61), st.integers(0, 61))
    full = parts.map(lambda p: f"{p[0]:04d}-{p[1]:02d}-{p[2]:02d} {p[3]:02d}:{p[4]:02d}:{p[5]:02d}")
    texts = st.one_of(
        st.just("0000-00-00 00:00:00"), full, full.map(lambda s: s + ".5"), full.map(lambda s: s[:10]),
    )

    @settings(max_examples=5, deadline=None)
    @given(values=st.lists(texts, min_size=200, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "t string")
        got = [r[0] for r in df.select(R.repair_zero_datetime("t")).collect()]
        assert got == [_model_zero_datetime(v) for v in values]

    check()


def test_text_transfer_then_repair_round_trips(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    stamps = st.datetimes(min_value=dt.datetime(1, 1, 1), max_value=dt.datetime(9999, 12, 31, 23, 59, 59)).map(
        lambda x: x.replace(microsecond=0)
    )

    @settings(max_examples=5, deadline=None)
    @given(values=st.lists(stamps, min_size=100, max_size=100))
    def check(values):
        df = spark.createDataFrame([(v, v.date()) for v in values], "ts timestamp_ntz, d date")
        out = df.select(
            R.repair_zero_datetime(R.datetime_text("ts")).alias("ts"), R.repair_zero_date(R.date_text("d")).alias("d")
        ).collect()
        assert [(r.ts, r.d) for r in out] == [(v, v.date()) for v in values]

    check()


def test_text_transfer_is_zone_free_for_ntz_and_dates(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0, 5), dt.date(999, 12, 31))],
                                   "ts timestamp_ntz, d date")
        r = df.select(R.datetime_text("ts").alias("a"), R.time_text("ts").alias("b"), R.date_text("d").alias("c"),
                      R.repair_zero_datetime(R.datetime_text("ts"), keep_fraction=True).alias("back")).first()
        assert (r.a, r.b, r.c) == ("2024-03-10 02:30:00.000005", "02:30:00.000005", "0999-12-31")
        assert r.back == dt.datetime(2024, 3, 10, 2, 30, 0, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
