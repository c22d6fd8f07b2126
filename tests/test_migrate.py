from lakeshift.plans.migrate import migrate_tables, status_summary
from lakeshift.sources.catalog import CATALOG_SCHEMA, ColumnClasses, column_classes


def test_failures_are_isolated_and_counted(spark, workdir):
    rows = [
        ("src", "good", "id", 1, "NO", "bigint", "bigint", "PRI", ""),
        ("src", "good", "d", 2, "YES", "date", "date", "", ""),
        ("src", "bad", "id", 1, "NO", "bigint", "bigint", "PRI", ""),
    ]
    classes = column_classes(spark.createDataFrame(rows, CATALOG_SCHEMA))
    good = spark.createDataFrame([(1, "2001-02-30"), (2, "0000-00-00"), (3, None)], "id bigint, d string")

    def reader(db, tb, cls):
        if tb == "bad":
            raise IOError("source unreachable")
        return good

    status = migrate_tables(spark, [("src", "good"), ("src", "bad"), ("src", "absent")], classes, reader, workdir,
                            target_database="lakeshift_m")
    got = {r.table_name: (r.status, r.rows_written, r.values_nulled) for r in status.collect()}
    assert got == {"good": ("ok", 3, 1), "bad": ("failed", None, None), "absent": ("failed", None, None)}
    assert status_summary(status).first().failed == 2
    out = spark.table("lakeshift_m.good")
    assert out.schema["d"].dataType.typeName() == "date"
    assert out.count() == 3


def test_remigration_keeps_dropped_source_columns_as_null(spark, workdir):
    from lakeshift.plans.migrate import migrate_table
    from lakeshift.sources.catalog import classes_from_schema

    v1 = spark.createDataFrame([(1, "a", "x")], "id bigint, keep string, gone string")
    v2 = spark.createDataFrame([(2, "b", 7)], "id bigint, keep string, added int")
    for df in (v1, v2):
        st = migrate_table(spark, "src", "evolving", classes_from_schema("src", "evolving", df.schema),
                           lambda db, tb, cls, df=df: df, workdir, target_database="lakeshift_m")
        assert st.status == "ok", st.error
    out = spark.table("lakeshift_m.evolving")
    assert out.columns == ["id", "keep", "gone", "added"]
    assert [tuple(r) for r in out.collect()] == [(2, "b", None, 7)]


def test_empty_tables_written_by_default_or_skipped(spark, workdir):
    from lakeshift.plans.migrate import migrate_tables
    from lakeshift.sources.catalog import classes_from_schema

    empty = spark.createDataFrame([], "id bigint, d string")
    classes = {("src", "none"): classes_from_schema("src", "none", empty.schema)}
    a = migrate_tables(spark, [("src", "none")], classes, lambda *a: empty, f"{workdir}/a", target_database="lakeshift_e1")
    assert [(r.status, r.rows_written) for r in a.collect()] == [("ok", 0)]
    assert spark.table("lakeshift_e1.none").columns == ["id", "d"]
    b = migrate_tables(spark, [("src", "none")], classes, lambda *a: empty, f"{workdir}/b",
                       target_database="lakeshift_e2", skip_empty=True)
    assert [(r.status, r.rows_written) for r in b.collect()] == [("empty", 0)]
    assert not spark.catalog.tableExists("lakeshift_e2.none")
    assert status_summary(b).first().failed == 0


def test_two_databases_never_become_one_table(spark, workdir):
    classes = {(d, "t"): ColumnClasses(d, "t", ["k"]) for d in ("d1", "d2")}
    status = migrate_tables(spark, [("d1", "t"), ("d2", "t")], classes, lambda d, t, c: spark.range(3).selectExpr("id AS k"), workdir, target_database="lakeshift_t")
    assert {r["status"] for r in status.collect()} == {"failed"}
    status = migrate_tables(spark, [("d1", "t"), ("d2", "t")], classes, lambda d, t, c: spark.range(3).selectExpr("id AS k"), workdir)
    assert {r["status"] for r in status.collect()} == {"ok"}
