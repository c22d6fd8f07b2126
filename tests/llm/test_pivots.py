import hashlib
import math
import random
from collections import defaultdict

import numpy as np

from lakeshift.llm import pivots
from lakeshift.llm.common import ship_package
from lakeshift.llm.queries import ORACLE_SQL, op11_vector_codes
from lakeshift.queries.compare import compare
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, parts int, cell string"


def expected(rows: list[tuple]) -> list[tuple]:
    """Every part against every entry, in plain Python."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    whole = [[math.floor(1024 * float(np.float32(x))) for x in r[1]] for r in kept]
    whole = [v + [0] * (-len(v) % 4) for v in whole]
    d = len(whole[0]) // 4
    parts = [[v[m * d : (m + 1) * d] for m in range(4)] for v in whole]
    books = [[p[m] for p in parts[:256]] for m in range(4)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(4):
        for m in range(4):
            groups = defaultdict(list)
            for p in parts:
                groups[near(p[m], books[m])[1]].append(p[m])
            for e, xs in groups.items():
                books[m][e] = [sum(x) // len(xs) for x in zip(*xs, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[near(p[m], books[m]) for m in range(4)] for p in parts]
    totals = defaultdict(int)
    for r, f in zip(kept, found, strict=True):
        totals[r[2]] += sum(x for x, _ in f)
    return [(r[0], "".join(f"{e:02x}" for _, e in f), sum(x for x, _ in f), totals[r[2]], digest) for r, f in zip(kept, found, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA).repartition(3)


def check(spark, rows):
    def order(r):
        return (r[0] is not None, r)

    ship_package(spark)
    got = [tuple(r) for r in pivots.codes_with_errors(frame(spark, rows)).collect()]
    assert sorted(got, key=order) == sorted(expected(rows), key=order)


def vectors(n: int, size: int, seed: int, spread: float = 1.0) -> list[tuple]:
    r = random.Random(seed)
    return [(3 * i, [float(np.float32(r.gauss(0, spread))) for _ in range(size)], r.choice([None, 1, 1, 1, 2])) for i in range(n)]


def test_odd_rows(spark):
    rows = vectors(400, 8, 1)
    rows += [(1, None, 1), (2, [], 1), (4, [None] * 8, 1), (5, [1.0, float("nan")] + [0.0] * 6, 1), (7, [float("-inf")] + [0.0] * 7, 2), (8, [1.0] * 4, 1)]
    rows += [(None, [0.25] * 8, None), (9, rows[3][1], None), (9, rows[3][1], None), (9, rows[4][1], 3)]
    check(spark, rows)


def test_copies_few_rows_and_uneven_lengths(spark):
    check(spark, [(i, [0.5, -0.5, 0.001, -0.001], 1) for i in range(300)])  # all entries are equal: ties go to the first
    check(spark, vectors(20, 6, 2))
    check(spark, vectors(1, 4, 3))
    check(spark, [])


def test_hot_value_and_wide_values(spark):
    rows = vectors(300, 8, 4) + [(10_000 + i, [0.125] * 8, 5) for i in range(400)]
    check(spark, rows)
    check(spark, vectors(300, 4, 5, spread=1e4))


def test_bounds_keep_the_nearest_entry():
    r = np.random.default_rng(1)
    for spread in (3, 1000, 10**6):
        parts, entries = r.integers(-spread, spread, (3000, 6)), r.integers(-spread, spread, (256, 6))
        chosen = pivots.choose_pivots(entries[:100])
        away = pivots.distances(parts, chosen).astype(np.float32)
        at, best = pivots.nearest(parts, away, entries, chosen)
        exact = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (exact.argmin(1) == at).all() and (exact.min(1) == best).all()


def test_components_out_of_range_are_held():
    assert np.abs(pivots.to_integers(np.array([[3e38, -3e38, 1.0]]))).tolist() == [[pivots.bound(4), pivots.bound(4), 1024, 0]]


def test_query_equals_sql(spark):
    r = compare(spark, "op11", op11_vector_codes, ORACLE_SQL["op11_vector_codes"], SF_SMALL)
    assert r["ok"], r
