import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeshift.operators.projection import typed_projection, typed_select_sql
from lakeshift.sources import catalog as C
from lakeshift.sources import jdbc as J


@settings(max_examples=200, deadline=None)
@given(lo=st.integers(-10**6, 10**6), span=st.integers(0, 10**6), n=st.integers(1, 64))
def test_ranges_cover_exactly_once(lo, span, n):
    hi = lo + span
    ranges = J.plan_key_ranges(lo, hi, num_partitions=n)
    assert ranges[0][0] == lo and ranges[-1][1] == hi + 1
    assert all(a < b for a, b in ranges)
    assert all(ranges[i][1] == ranges[i + 1][0] for i in range(len(ranges) - 1))
    assert len(ranges) <= n


def test_ranges_by_stride_and_empty():
    assert J.plan_key_ranges(0, 250000, stride=J.SOURCE_CHUNK_STRIDE) == [(0, 100000), (100000, 200000), (200000, 250001)]
    assert J.plan_key_ranges(5, 4, num_partitions=3) == []
    with pytest.raises(TypeError):
        J.plan_key_ranges("a", "z", num_partitions=2)
    assert J.range_predicates("k", [(0, 10)]) == ["1 = 1"]
    assert J.range_predicates("order", [(0, 5), (5, 9), (9, 12)]) == [
        "(`order` < 5 OR `order` IS NULL)", "`order` >= 5 AND `order` < 9", "`order` >= 9"]
    wide = J.plan_key_ranges(0, 10**12, stride=1000)  # several strides to a range, none left out
    assert len(wide) <= J.MAX_RANGES and wide[0][0] == 0 and wide[-1][1] == 10**12 + 1
    assert all(a[1] == b[0] and (a[1] - a[0]) % 1000 == 0 for a, b in zip(wide, wide[1:], strict=False))
    import decimal

    assert J.integer_bounds("k", decimal.Decimal(3), 9) == (3, 9)
    with pytest.raises(TypeError):
        J.integer_bounds("name", "a", "z")
    with pytest.raises(TypeError):
        J.integer_bounds("k", decimal.Decimal("1.5"), 2)


def test_chunked_read_equals_plain_read_under_gaps(spark):
    df = spark.range(0, 300).selectExpr("CASE WHEN id > 100 THEN id + 1000000 ELSE id END AS k")
    lo, hi = J.key_bounds(df, "k")
    for n in (1, 3, 8):
        got = J.read_key_ranges(df, "k", n)
        assert sorted(r.k for r in got.collect()) == sorted(r.k for r in df.collect())
    assert J.key_bounds(df.limit(0), "k") is None


def test_jdbc_options_never_hold_defaults_for_credentials():
    src = J.JdbcSource(url="jdbc:mysql://example.invalid/db", user="u", password="p")
    o = J.partitioned_options(src, "SELECT 1 AS k", "k", 0, 99, 4)
    assert o["dbtable"] == "(SELECT 1 AS k) q" and o["upperBound"] == "100" and o["numPartitions"] == "4"
    assert "query" not in o
    q = J.query_options(src, "SELECT 1")
    assert q["fetchsize"] == str(J.DEFAULT_FETCH_SIZE) and q["query"] == "SELECT 1"
    assert "password" not in J.query_options(J.JdbcSource(url="jdbc:x"), "q")


def _catalog(spark):
    rows = [
        ("shop", "orders", "created", 2, "YES", "datetime", "datetime", "", ""),
        ("shop", "orders", "id", 1, "NO", "int", "int(11)", "PRI", ""),
        ("shop", "orders", "day", 3, "YES", "date", "date", "", ""),
        ("shop", "orders", "at", 4, "YES", "time", "time", "", ""),
        ("shop", "orders", "flag", 5, "YES", "tinyint", "tinyint(1)", "", ""),
        ("other", "orders", "x", 1, "YES", "int", "int(11)", "", ""),
    ]
    return spark.createDataFrame(rows, C.CATALOG_SCHEMA)


def test_column_classes_match_schema_and_order(spark):
    cls = C.column_classes(_catalog(spark))
    o = cls[("shop", "orders")]
    assert o.all == ["id", "created", "day", "at", "flag"]
    assert (o.datetime, o.date, o.time, o.tinyint) == (["created"], ["day"], ["at"], ["flag"])
    assert cls[("other", "orders")].all == ["x"]


def test_typed_select_sql(spark):
    o = C.column_classes(_catalog(spark))[("shop", "orders")]
    sql = typed_select_sql("shop", "orders", o)
    assert sql == (
        "SELECT `id`, CONVERT(`created`, CHAR) AS `created`, CONVERT(`day`, CHAR) AS `day`, "
        "CONVERT(`at`, CHAR) AS `at`, CAST(`flag` AS DECIMAL) AS `flag` FROM `shop`.`orders`"
    )


def test_typed_projection_and_catalog_from_schema(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 2, 3, 4, 5), True)], "id int, created timestamp_ntz, flag boolean")
    cat = C.catalog_from_schema(spark, "s", "t", df.schema, key="id")
    assert [(r.COLUMN_NAME, r.DATA_TYPE, r.COLUMN_KEY) for r in cat.collect()] == [
        ("id", "int", "PRI"), ("created", "datetime", ""), ("flag", "tinyint", "")]
    cls = C.column_classes(cat)[("s", "t")]
    assert C.classes_from_schema("s", "t", df.schema, key="id") == cls
    r = typed_projection(df, cls).first()
    assert r.created == "2020-01-02 03:04:05" and int(r.flag) == 1


def test_read_control_csvs(spark, workdir):
    spark.createDataFrame([("shop", "orders", "id")], "database string, table string, key string").coalesce(1).write.option(
        "header", "true").csv(f"{workdir}/tables")
    t = C.read_table_list(spark, f"{workdir}/tables")
    assert [tuple(r) for r in t.collect()] == [("shop", "orders", "id")]
    # a catalogue file without ORDINAL_POSITION gets it from file order, not from the alphabet
    _catalog(spark).drop("ORDINAL_POSITION").coalesce(1).write.option("header", "true").csv(f"{workdir}/cat")
    cat = C.read_column_catalog(spark, f"{workdir}/cat")
    assert cat.columns == C.CATALOG_COLUMNS
    assert C.column_classes(cat)["shop", "orders"].all[:2] == ["created", "id"]
    assert "table_schema = 'x''y'" in C.catalog_query_sql("x'y")


def test_schema_probe_empty_and_emptiness(spark):
    from lakeshift.operators import basic as B
    from lakeshift.operators.projection import empty_like

    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s")
    e = empty_like(df)
    assert e.schema == df.schema and e.count() == 0
    assert B.is_empty(e) and not B.is_empty(df)
    assert B.preview(df, 3).collect() == B.preview(df.orderBy(df.id.desc()), 3).collect()


@settings(max_examples=200, deadline=None)
@given(counts=st.dictionaries(st.integers(0, 99), st.integers(0, 1000), max_size=60), parts=st.integers(1, 16))
def test_balanced_ranges_cover_and_balance(counts, parts):
    lo, width = 1000, 10
    hi = lo + 100 * width - 1
    ranges = J.balanced_ranges(lo, hi, width, counts, parts)
    assert ranges[0][0] == lo and ranges[-1][1] == hi + 1
    assert all(ranges[i][1] == ranges[i + 1][0] for i in range(len(ranges) - 1))
    assert all(a < b for a, b in ranges) and len(ranges) <= parts
    total = sum(counts.values())
    biggest = max(counts.values(), default=0)
    for a, b in ranges:
        rows = sum(n for k, n in counts.items() if a <= lo + k * width < b)
        assert rows <= total / parts + biggest + 1e-9


def test_balanced_plan_splits_dense_keys(spark):
    # 1000 dense keys, then a sparse tail far away: equal width would put
    # almost everything in the first range
    df = spark.range(0, 1000).unionByName(spark.range(10**6, 10**6 + 10**5, 10**4))
    lo, hi = J.key_bounds(df, "id")
    ranges = J.plan_balanced(df, "id", lo, hi, num_partitions=4)
    sizes = [df.filter((df.id >= a) & (df.id < b)).count() for a, b in ranges]
    assert sum(sizes) == df.count() and max(sizes) <= 260
    assert "GROUP BY FLOOR((`k` - 5) / 7)" in J.histogram_sql("t", "k", 5, 7)
    assert "WHERE `k` >= 5 AND `k` < 40" in J.histogram_sql("t", "k", 5, 7, 40)


def test_histogram_is_exact_for_large_keys(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big,), (big + 1,), (big + 2,)], "k bigint")
    got = {r.bucket: r.n for r in J.key_histogram(df, "k", big, 1).collect()}
    assert got == {0: 1, 1: 1, 2: 1}


def test_jdbc_read_paths_with_spark_standing_in_for_the_database(spark, workdir, monkeypatch):
    """The JDBC reader's SQL (bounds, histograms, range predicates) runs as
    generated - against Spark SQL instead of a database, none may be started here."""
    from lakeshift.sources.catalog import ColumnClasses

    spark.sql("CREATE DATABASE IF NOT EXISTS jdbc_src")
    rows = spark.range(0, 2000).selectExpr("id AS id", "CAST(id * 2 AS STRING) AS v") \
        .unionByName(spark.range(10**7, 10**7 + 50).selectExpr("id AS id", "'far' AS v"))
    rows.write.mode("overwrite").option("path", f"{workdir}/src").saveAsTable("jdbc_src.items")
    seen = []

    def fake_query(spark_, src, query):
        seen.append(query)
        return spark_.sql(query.replace("`jdbc_src`.`items`", "jdbc_src.items"))

    def fake_ranges(spark_, src, query, key, ranges):
        seen.append(("ranges", ranges))
        preds = J.range_predicates(key, ranges)
        parts = [spark_.sql(f"SELECT * FROM ({query.replace('`jdbc_src`.`items`', 'jdbc_src.items')}) q WHERE {p}")
                 for p in preds]
        return J.union_all(parts)

    monkeypatch.setattr(J, "read_query", fake_query)
    monkeypatch.setattr(J, "read_by_ranges", fake_ranges)
    src = J.JdbcSource(url="jdbc:none")
    cls = ColumnClasses("jdbc_src", "items", ["id", "v"])
    balanced = J.read_table_typed(spark, src, "jdbc_src", "items", cls, key="id", num_partitions=4)
    assert balanced.count() == 2050
    ranges = [x for x in seen if isinstance(x, tuple)][-1][1]
    assert len(ranges) == 4 and ranges[0][0] == 0 and ranges[-1][1] == 10**7 + 50
    assert any("GROUP BY FLOOR" in q for q in seen if isinstance(q, str))
    strided = J.read_table_typed(spark, src, "jdbc_src", "items", cls, key="id", stride=J.SOURCE_CHUNK_STRIDE)
    assert strided.count() == 2050
    assert sorted(r.id for r in strided.collect()) == sorted(r.id for r in rows.collect())


def test_table_list_without_key_column(spark, workdir):
    spark.createDataFrame([("shop", "users")], "database string, table string").coalesce(1).write \
        .option("header", "true").csv(f"{workdir}/small_list")
    rows = C.read_table_list(spark, f"{workdir}/small_list").collect()
    assert [(r.database, r.table, r.key) for r in rows] == [("shop", "users", None)]
