"""J3/J4 against a plain-Python model on random small inputs (brute force)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeshift.operators import cdc

OPS = st.sampled_from(["I", "U", "D", None])


def model_latest(target, feed):
    """Last change per key by (ts, seq); D removes, anything else replaces."""
    out = dict(target)
    last = {}
    for op, k, v, ts, seq in feed:
        if op is None:
            continue
        if k not in last or (ts, seq) > last[k][:2]:
            last[k] = (ts, seq, op, v)
    for k, (_, _, op, v) in last.items():
        if op == "D":
            out.pop(k, None)
        else:
            out[k] = v
    return sorted(out.items())


def model_j3(target, feed):
    out = dict(target)
    for op, k, v, *_ in feed:
        if op is not None and op != "D":
            out[k] = v
    for op, k, *_ in feed:
        if op == "D":
            out.pop(k, None)
    return sorted(out.items())


feeds = st.lists(
    st.tuples(OPS, st.integers(0, 12), st.text("abc", max_size=2), st.integers(0, 5), st.integers(0, 10**6)),
    max_size=25,
    unique_by=lambda r: r[4],  # sequence numbers are unique: the order within a key is total
)
targets = st.dictionaries(st.integers(0, 12), st.text("xyz", max_size=2), max_size=10)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=targets, feed=feeds)
def test_apply_latest_matches_model(spark, target, feed):
    t = spark.createDataFrame(sorted(target.items()), "k bigint, v string")
    f = spark.createDataFrame(feed, "Op string, k bigint, v string, ts int, seq bigint")
    out = cdc.apply_latest(t, f, "k", ["ts", "seq"], drop_cols=["Op", "ts", "seq"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == model_latest(target, feed)
    again = cdc.apply_latest(out, f, "k", ["ts", "seq"], drop_cols=["Op", "ts", "seq"])
    assert sorted(tuple(r) for r in again.collect()) == got  # applying twice = once


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=targets, feed=feeds)
def test_apply_changes_matches_model_or_raises(spark, target, feed):
    t = spark.createDataFrame(sorted(target.items()), "k bigint, v string")
    f = spark.createDataFrame(feed, "Op string, k bigint, v string, ts int, seq bigint").drop("ts", "seq")
    up_keys = [k for op, k, *_ in feed if op is not None and op != "D"]
    if len(up_keys) != len(set(up_keys)):
        try:
            cdc.apply_changes(t, f, "k")
        except cdc.DuplicateKeyError:
            return
        raise AssertionError("repeated upsert keys must raise")
    got = sorted(tuple(r) for r in cdc.apply_changes(t, f, "k").collect())
    assert got == model_j3(target, feed)
