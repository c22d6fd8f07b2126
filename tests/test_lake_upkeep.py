"""Schema reconciliation, restarts, file layout, manifests, and intake by ledger."""

import datetime as dt

import pytest
from pyspark import AccumulatorParam, TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.plans.restart import RangeLedger, RangesFailed, migrate_ranges
from lakeshift.session import hadoop_fs, list_files
from lakeshift.sinks import evolve, layout
from lakeshift.sinks import snapshot as K
from lakeshift.streaming import ledger


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("tinyint", "bigint", "bigint"), ("int", "decimal(12,2)", "decimal(12,2)"), ("bigint", "decimal(12,2)", "decimal(21,2)"),
        ("decimal(10,4)", "decimal(12,2)", "decimal(14,4)"), ("float", "double", "double"), ("int", "double", "double"), ("smallint", "float", "float"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"),
        ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"), ("void", "int", "int"), ("string", "varchar(5)", "string"),
    ],
)
def test_widest_is_the_same_both_ways(spark, a, b, both):
    x, y = (_schema(f"c {t}")["c"].dataType for t in (a, b))
    assert evolve.widest(x, y).simpleString() == both
    if "struct" not in a:
        assert evolve.widest(y, x).simpleString() == both
    assert evolve.widest(x, evolve.widest(x, y)) == evolve.widest(x, y)


@pytest.mark.parametrize(("a", "b"), [("bigint", "double"), ("int", "string"), ("decimal(38,0)", "decimal(38,10)"), ("date", "int"), ("int", "float"), ("array<int>", "int")])
def test_conflicts_name_the_column(spark, a, b):
    with pytest.raises(evolve.SchemaConflict, match="outer.c"):
        evolve.merged_schema([_schema(f"outer struct<c:{a}>"), _schema(f"outer struct<c:{b}>")])


def test_versions_read_under_one_schema(spark, workdir):
    spark.sql("SELECT 1 AS id, named_struct('x', 1, 'deep', array(named_struct('p', 1))) AS s, map('k', 1) AS m").write.parquet(f"{workdir}/0")
    spark.sql("SELECT 2L AS id, named_struct('deep', array(named_struct('q', 'a', 'p', 5L)), 'x', 2L) AS s, 'new' AS n").write.parquet(f"{workdir}/1")
    spark.sql("SELECT 3L AS id, CAST(NULL AS struct<x:bigint>) AS s, map('k', 7L) AS m").write.parquet(f"{workdir}/2")
    rows = evolve.read_versions(spark, [f"{workdir}/{k}" for k in range(3)])
    got = {r["id"]: r.asDict(True) for r in rows.collect()}
    assert got[1] == {"id": 1, "s": {"x": 1, "deep": [{"p": 1, "q": None}]}, "m": {"k": 1}, "n": None}
    assert got[2] == {"id": 2, "s": {"x": 2, "deep": [{"p": 5, "q": "a"}]}, "m": None, "n": "new"}
    assert got[3]["s"] is None and got[3]["m"] == {"k": 7}
    plan = rows.filter("id = 2").select("n")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,2)]" in plan


def test_a_rerun_reads_only_what_is_missing(spark, workdir):
    src = spark.range(0, 100).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    plans, read = [], []

    def plan():
        plans.append(1)
        return ["k < 30", "k >= 30 AND k < 60", "k >= 60"]

    def reader(p, down=()):
        read.append(p)
        if p in down:
            raise IOError("gone")
        return src.filter(p)

    with pytest.raises(RangesFailed, match="range 1: OSError: gone"):
        migrate_ranges(spark, lambda p: reader(p, ("k >= 30 AND k < 60",)), plan, workdir)
    assert RangeLedger(spark, workdir, plan).missing() == [1]
    with pytest.raises(FileNotFoundError, match="1 of 3"):
        RangeLedger(spark, workdir, plan).read()
    read.clear()
    kept, again = migrate_ranges(spark, reader, plan, workdir)
    assert again == [1] and read == ["k >= 30 AND k < 60"] and plans == [1]
    assert sorted(r["k"] for r in kept.read().collect()) == list(range(100))
    assert migrate_ranges(spark, reader, plan, workdir)[1] == []


def test_clustered_files_prune_on_every_column(spark, workdir):
    df = spark.range(0, 20000).selectExpr("id % 141 AS a", "CASE WHEN id % 50 = 0 THEN NULL ELSE (id * 7919) % 10007 END AS b", "sha2(CAST(id AS STRING), 256) AS v")
    df.write.parquet(f"{workdir}/plain")
    whole = sum(r["bytes"] for r in K.manifest_entries(spark, f"{workdir}/plain").collect())
    n = layout.write_clustered(df, f"{workdir}/c", ["a", "b"], whole // 16)
    entries = K.manifest_entries(spark, f"{workdir}/c").collect()
    assert abs(len(entries) - n) <= 1 and max(r["bytes"] for r in entries) < 2 * whole / 16
    rows = spark.read.parquet(f"{workdir}/c")
    assert rows.count() == 20000 and rows.agg(F.sum("a"), F.sum("b")).first() == df.agg(F.sum("a"), F.sum("b")).first()
    files = rows.groupBy(F.col("_metadata.file_path").alias("f")).agg(*(f(c).alias(f"{f.__name__}_{c}") for c in "ab" for f in (F.min, F.max)))
    for c, cut in (("a", 14), ("b", 1000)):
        assert files.filter(F.col(f"min_{c}") <= cut).count() <= len(entries) * 0.6
    assert layout.write_clustered(df.limit(0), f"{workdir}/empty", ["a"], 1000) == 1


def test_a_size_sample_is_taken_by_all_tasks(spark):
    class RowsOfTasks(AccumulatorParam):
        def zero(self, value):
            return {}

        def addInPlace(self, a, b):
            return {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}}

    read = spark.sparkContext.accumulator({}, RowsOfTasks())

    def through(batches):
        for b in batches:
            read.add({TaskContext.get().taskAttemptId(): b.num_rows})
            yield b

    df = spark.range(0, 8000, 1, 8).mapInArrow(through, "id bigint")
    assert layout.encoded_row_bytes(df, 8000, 400) > 0
    assert sum(read.value.values()) == 8000 and max(read.value.values()) == 1000


def test_clustered_rows_that_take_less_room_than_the_sample(spark, workdir):
    df = spark.range(0, 60000).selectExpr("id % 300 AS a", "sha2(CAST(id % 300 AS STRING), 512) AS v", "sha2(CAST(id % 300 + 1 AS STRING), 512) AS w", "id % 7 AS b")
    wide = df.selectExpr("a", "b", *(f"sha2(concat(v, {k}), 512) AS v{k}" for k in range(4)))
    sample = layout.encoded_row_bytes(wide, 60000, 1000) * 60000
    n = layout.write_clustered(wide, f"{workdir}/c", ["a"], int(sample / 40))
    sizes = [r["bytes"] for r in K.manifest_entries(spark, f"{workdir}/c").collect()]
    assert abs(len(sizes) - n) <= 1 and n < 40 and sample / 80 <= sum(sizes) / len(sizes)
    assert spark.read.parquet(f"{workdir}/c").count() == 60000


def test_files_within_a_size(spark):
    df = spark.range(0, 20000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS v")
    whole = 20000 * layout.encoded_row_bytes(df, 20000)
    assert layout.files_within(df, int(whole * 2), least=6) == 6
    assert layout.files_within(df, int(whole / 9.5), least=6) == 10
    assert layout.files_within(df.limit(0), 1000) == 1


def test_manifest_lists_files_by_parts(spark, workdir):
    spark.range(0, 50).repartition(5).write.parquet(f"{workdir}/d")
    n = K.write_manifest(spark, f"{workdir}/d", f"{workdir}/m")
    names = {r["value"] for r in spark.read.text(f"{workdir}/m/symlink").collect()}
    assert n == len(names) and {x.rsplit("/", 1)[-1] for x in names} <= {x.rsplit("/", 1)[-1] for x in list_files(spark, f"{workdir}/d")}
    spark.range(50, 60).write.mode("append").parquet(f"{workdir}/d")
    assert K.read_manifest(spark, f"{workdir}/m").count() == 50
    assert spark.read.parquet(f"{workdir}/m/entries").agg(F.sum("rows")).first()[0] == 50


def test_ledger_notices_rewritten_and_late_files(spark, workdir):
    schema = _schema("k bigint, v string")
    src, sink = f"{workdir}/in", f"{workdir}/sink"

    def land(name, rows, time=None):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{src}/{name}")
        f = next(x for x in list_files(spark, f"{src}/{name}") if x.endswith(".parquet"))
        fs, p = hadoop_fs(spark, f)
        fs.rename(p, hadoop_fs(spark, f"{src}/{name}/data.parquet")[1])
        if time:
            ledger.set_file_time(spark, f"{src}/{name}/data.parquet", time)

    def rows():
        return sorted((r["k"], r["v"]) for r in ledger.current(spark, sink, schema).collect())

    assert rows() == []
    day = dt.datetime(2024, 1, 10)
    land("a", [(1, "x")], day)
    land("b", [(2, "y"), (3, "z")], day)
    assert ledger.take_in(spark, f"{src}/*/*.parquet", schema, sink) == 0 and rows() == [(1, "x"), (2, "y"), (3, "z")]
    assert ledger.take_in(spark, f"{src}/*/*.parquet", schema, sink) is None
    land("b", [(2, "Y")], day + dt.timedelta(days=1))
    land("c", [(4, "late")], day - dt.timedelta(days=3))
    land("d", [(5, "too late")], day - dt.timedelta(days=30))
    assert ledger.take_in(spark, f"{src}/*/*.parquet", schema, sink, lateness=dt.timedelta(days=7)) == 1
    assert rows() == [(1, "x"), (2, "Y"), (4, "late")]
    assert ledger.take_in(spark, f"{src}/*/*.parquet", schema, sink) == 2 and (5, "too late") in rows()
    # data without its ledger part: the batch is taken in again under its number
    fs, p = hadoop_fs(spark, f"{sink}/ledger/{ledger.BATCH}=2")
    fs.delete(p, True)
    assert (5, "too late") not in rows()
    assert ledger.take_in(spark, f"{src}/*/*.parquet", schema, sink) == 2 and rows() == [(1, "x"), (2, "Y"), (4, "late"), (5, "too late")]
