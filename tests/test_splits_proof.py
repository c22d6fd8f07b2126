"""Split points over any keys, and value proofs."""

import datetime as dt
import decimal
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakeshift.functions import proof
from lakeshift.plans.migrate import migrate_table, unproven_columns
from lakeshift.sources.catalog import classes_from_schema
from lakeshift.sources.splits import range_number, split_points, split_predicates, sql_literal


def _counts(df, keys, cuts):
    """How many of the ranges each row meets, and the sizes of the ranges."""
    met = sum((F.when(F.expr(p), 1).otherwise(0) for p in split_predicates(keys, cuts)), F.lit(0))
    rows = df.select(met.alias("met"), range_number(keys, cuts).alias("r"))
    return {r["met"] for r in rows.select("met").distinct().collect()}, {r["r"]: r["count"] for r in rows.groupBy("r").count().collect()}


def test_even_ranges_over_text_with_a_hot_value_and_nulls(spark):
    df = spark.range(0, 9000).selectExpr("CASE WHEN id % 3 = 0 THEN 'it''s \\\\ hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 700) END AS k", "id AS seq")
    cuts = split_points(df, ["k", "seq"], 10)
    met, sizes = _counts(df, ["k", "seq"], cuts)
    assert met == {1} and len(sizes) == 10 and max(sizes.values()) < 1.5 * 900
    assert split_points(df, ["k", "seq"], 10) == cuts


def test_other_types_and_few_rows(spark):
    days = spark.range(0, 400).selectExpr("date_add(DATE '2020-01-01', CAST(id AS INT)) AS d", "CAST(id % 7 AS DECIMAL(5,1)) AS n", "CAST(id AS DOUBLE) / 3 AS x")
    for keys in (["d"], ["n", "d"], ["x"], ["n", "x"]):
        met, sizes = _counts(days, keys, split_points(days, keys, 4))
        assert met == {1} and len(sizes) == 4 and max(sizes.values()) < 200
    same = spark.range(0, 10).selectExpr("'a' AS k")
    assert split_points(same, "k", 5) == [] and split_predicates("k", []) == ["1 = 1"]
    assert split_points(same.limit(0), "k", 5) == []
    two = spark.createDataFrame([("a",), ("b",)], "k string")
    assert _counts(two, ["k"], split_points(two, "k", 5)) == ({1}, {0: 1, 1: 1})


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_every_tuple_meets_one_range(data):
    """The clauses as Python comparisons: disjoint and complete, nulls first."""
    value = st.one_of(st.none(), st.integers(0, 4))
    cuts = sorted(set(data.draw(st.lists(st.tuples(value, value), max_size=5))), key=lambda c: tuple((x is not None, x or 0) for x in c))
    first = (None, None)
    cuts = [c for c in cuts if c != first]
    rows = [(a, b) for a in [None, *range(5)] for b in [None, *range(5)]]
    for row in rows:
        met = 0
        for p in split_predicates(["a", "b"], cuts):
            met += _sql_true(p, row)
        assert met == 1, (row, cuts)


def _sql_true(clause: str, row: tuple) -> bool:
    import duckdb

    a, b = (sql_literal(x) for x in row)
    return bool(duckdb.execute(f'SELECT ({clause.replace("`", chr(34))}) FROM (SELECT CAST({a} AS INT) AS a, CAST({b} AS INT) AS b)').fetchone()[0])


def test_literals(spark):
    for v in ("a'b\\c\n", 5, -3, 2.5, 1e300, decimal.Decimal("1.20"), dt.date(2020, 2, 29), True, dt.datetime(2020, 1, 2, 3, 4, 5, 6)):
        assert spark.sql(f"SELECT {sql_literal(v)} AS v").first()["v"] == v


def test_proof_ignores_order_and_names_what_changed(spark):
    r = random.Random(1)
    rows = [(i, r.choice([None, "x", "y"]), r.choice([0.0, -0.0, 1.5, None]), [i, None], {"k": i}) for i in range(300)]
    schema = "id int, s string, f double, a array<int>, m map<string,int>"
    df = spark.createDataFrame(rows, schema)
    base = proof.proof_of(df)
    shuffled = spark.createDataFrame(r.sample(rows, len(rows)), schema).repartition(7)
    assert proof.proof_of(shuffled) == base
    for column, change in (("s", "coalesce(s, 'z')"), ("f", "CASE WHEN id = 3 THEN 9.0 ELSE f END"), ("a", "CASE WHEN id = 3 THEN array(1) ELSE a END")):
        assert proof.differing_columns(base, proof.proof_of(df.withColumn(column, F.expr(change)))) == [column]
    swapped = df.withColumn("id", F.expr("CASE WHEN id = 1 THEN 2 WHEN id = 2 THEN 2 ELSE id END"))  # equal under xor of pairs
    assert proof.differing_columns(base, proof.proof_of(swapped)) == ["id"]
    assert proof.proof_of(df.limit(0))["s"] == (0, 0, 0)
    assert proof.differing_columns(base, {k: v for k, v in base.items() if k != "s"}) == ["s"]


def test_proof_is_gathered_by_the_write(spark, workdir):
    df = spark.range(0, 100).selectExpr("id", "CAST(id AS STRING) AS s")
    seen = Observation("proof_test")
    proof.observe_proof(df, seen).write.parquet(workdir)
    assert unproven_columns(spark.read.parquet(workdir), proof.observed_proof(seen, df.columns)) == []


def test_migration_proves_values_and_names_a_damaged_column(spark, workdir, monkeypatch):
    df = spark.createDataFrame([(1, "2001-02-30", "a"), (2, "0000-00-00", "b")], "id bigint, d string, s string")
    classes = classes_from_schema("src", "t", df.schema)
    ok = migrate_table(spark, "src", "t", classes, lambda *a: df, f"{workdir}/a", target_database="lakeshift_proof", prove=True)
    assert (ok.status, ok.rows_written) == ("ok", 2)
    from lakeshift.plans import migrate

    whole = migrate.refresh_table
    monkeypatch.setattr(migrate, "refresh_table", lambda spark, rows, *a, **k: whole(spark, rows.withColumn("s", F.lit("lost")), *a, **k))
    bad = migrate_table(spark, "src", "t", classes, lambda *a: df, f"{workdir}/b", target_database="lakeshift_proof", prove=True)
    assert bad.status == "failed" and bad.error.endswith("in columns s")


def test_a_table_that_fails_once_is_tried_again(spark, workdir):
    df = spark.createDataFrame([(1,)], "id bigint")
    tries = []

    def reader(*a):
        tries.append(1)
        if len(tries) == 1:
            raise IOError("connection lost")
        return df

    classes = classes_from_schema("src", "again", df.schema)
    got = migrate_table(spark, "src", "again", classes, reader, workdir, target_database="lakeshift_proof")
    assert got.status == "ok" and len(tries) == 2

    def broken(*a):
        raise IOError(f"down {len(tries)}")

    assert migrate_table(spark, "src", "never", classes, broken, workdir, target_database="lakeshift_proof").error == "OSError: down 2"
