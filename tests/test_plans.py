"""Plan-level checks: pruning, pushdown, partial aggregation, no driver round trips."""

from lakeshift.operators import basic as B
from lakeshift.operators import cdc
from lakeshift.plans import marts
from lakeshift.queries import fixtures as fx
from lakeshift.queries.registry import QUERIES
from tests.conftest import SF_CHECK


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_projection_prunes_scan_columns(spark):
    plan = _plan(QUERIES["select_columns"](spark, SF_CHECK))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_cutoff_filter_reaches_parquet_scan(spark):
    df = marts.reservation_information(fx.Tables(spark, SF_CHECK), fx.MART_TODAY)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan
    assert "o_custkey" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_hot_key_latest_and_dedup_are_partially_aggregated(spark):
    # one key holds a third of the rows
    feed = spark.range(0, 3000).selectExpr(
        "'U' AS Op", "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS seq", "CAST(id AS STRING) AS v")
    plan = _plan(cdc.latest_changes(feed, "k", ["seq"]))
    assert plan.index("partial_max_by") > plan.index("Exchange")  # partial step sits below the shuffle
    dplan = _plan(B.dedup_by_key(feed, "k"))
    assert "partial_first" in dplan
    got = cdc.latest_changes(feed, "k", ["seq"]).filter("k = 0").first()
    assert got.seq == 2997


def test_domestic_settlement_aggregates_before_final_shuffle(spark):
    plan = _plan(marts.domestic_settlement(fx.Tables(spark, SF_CHECK)))
    assert "partial_sum" in plan and ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan)


def test_equality_filter_is_pushed_to_scan(spark):
    plan = _plan(QUERIES["equality_filter_pushdown"](spark, SF_CHECK))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
