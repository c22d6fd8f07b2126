import collections
import random
import re

import pytest

from lakeshift.llm import quality
from lakeshift.llm.queries import ORACLE_SQL, QUERIES
from lakeshift.queries.compare import compare
from tests.conftest import SF_SMALL
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    t = text or ""
    ws = WORD.findall(t)
    windows = list(zip(ws, ws[1:], ws[2:], strict=False))
    n = collections.Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in t)
    failed = len(ws) < 50 or 100 * len(covered) > 50 * len(ws)
    chars, dup = sum(map(len, ws)), len(lines) - len(set(lines))
    upper, letters = sum(c.isupper() for c in t), sum(c.isalpha() for c in t)
    more = 10 * symbols > len(ws) or 100 * dup > 40 * len(lines) or not 3 * len(ws) <= chars <= 10 * len(ws) or 2 * upper > letters
    return len(ws), chars, symbols, dup, len(covered), failed, not (failed or more)


def test_features_equal_brute_force(spark):
    r = random.Random(5)
    pairs = cases.rows() + [(1000 + k, " ".join(r.choice("abc") for _ in range(r.randint(0, 30)))) for k in range(200)]
    got = sorted(map(tuple, quality.quality_features(cases.frame(spark, pairs)).drop("rejected_by").collect()), key=cases.key)
    assert got == sorted(((i, *brute(t)) for i, t in pairs), key=cases.key)


def test_filter_keeps_rows_whole_whatever_the_order(spark):
    df = cases.frame(spark)
    got = quality.quality_filter(df)
    assert got.schema == df.schema
    want = sorted(tuple(x) for x in ((i, t) for i, t in cases.rows() if brute(t)[-1]) if x[0] is not None)
    assert sorted(tuple(r) for r in got.where("doc_id is not null").select("doc_id", "text").collect()) == want
    rules = list(quality.BASE_RULES + quality.MORE_RULES)
    texts = df.selectExpr("doc_id", "coalesce(text, '') as _text")
    one, other = (sum(r[0] is None for r in quality._cascade(texts, o).select("rejected_by").collect()) for o in (rules, rules[::-1]))
    assert one == other == got.count()


def test_empty_table(spark):
    df = cases.frame(spark).limit(0)
    assert quality.quality_features(df).collect() == []
    assert quality.quality_filter(df).collect() == []


def test_order_covers_all_rules(spark):
    rules = quality.BASE_RULES + quality.MORE_RULES
    assert set(quality.cascade_order(cases.frame(spark), rules)) == set(rules)


def test_no_python_in_the_plan(spark):
    plan = quality.quality_features(cases.frame(spark).selectExpr("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert r["ok"], r


def test_order_is_the_same_in_every_run_and_no_text_reaches_the_driver(spark):
    rules = quality.BASE_RULES + quality.MORE_RULES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert len({tuple(quality.cascade_order(docs, rules)) for _ in range(3)}) == 1


def test_cascade_passes_over_rows_already_rejected(spark):
    df = spark.createDataFrame([("A B C",), (None,)], "_text string").withColumn("_text", quality.F.coalesce("_text", quality.F.lit("")))
    out = quality._cascade(df, list(quality.MORE_RULES), quality.F.lit(True))
    assert [r["rejected_by"] for r in out.collect()] == ["base", "base"]
    assert all(r["_n_upper"] is None for r in out.collect())
