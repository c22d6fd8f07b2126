import hashlib
import random
import zlib
from fractions import Fraction

from lakeshift.llm import periodic
from lakeshift.llm.common import ship_package
from tests.llm import cases


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    out = []
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s = w[i : j + q]
            if len(s) >= max(24, 3 * q) and not any(s[d:] == s[:-d] for d in range(1, q)):
                out.append((i, len(s), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def odd_words(r: random.Random, most: int) -> list[bytes]:
    """Repetitions within repetitions, broken here and there, over few words."""
    some = r.choice([1, 2, 3, 20])

    def words(n: int) -> list[bytes]:
        return [b"%d" % r.randrange(some) for _ in range(n)]

    out = words(r.randint(0, 60))
    for _ in range(r.randint(0, 4)):
        unit = words(r.randint(1, most))
        if r.random() < 0.5:
            unit = (words(r.randint(1, 6)) * r.randint(1, 9) + unit)[: most + 20]
        if r.random() < 0.3:
            unit.append(b"z%d" % r.randrange(1000))
        if r.random() < 0.3:
            unit = unit * 3 + words(2)
        out += (unit * 5)[: int(len(unit) * (1 + 3.5 * r.random()))]
        if r.random() < 0.5:
            out[r.randrange(len(out))] = b"q"
        out += words(r.randint(0, 20))
    return out


def test_runs_equal_brute_force():
    r = random.Random(5)
    found = 0
    for most in [70] * 30 + [400] * 4:
        docs = [odd_words(r, most) for _ in range(r.randint(1, 10))]
        want = [brute_runs(d) for d in docs]
        assert periodic.runs_of(docs) == want
        found += sum(map(len, want))
    assert found > 500


def test_long_runs():
    r = random.Random(6)
    unit = [b"%d" % r.randrange(10**6) for _ in range(20_000)]
    assert periodic.runs_of([unit * 3, unit + unit, [b"a", b"b", b"c"] * 30_000]) == [[(0, 60_000, 20_000)], [], [(0, 90_000, 3)]]


def expected(doc: int | None, text: str | None) -> tuple:
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    stay = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc, len(runs), *most, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(stay)).hexdigest()


def test_digests_of_all_cases(spark):
    ship_package(spark)
    short = [(i, " ".join(t.split(" ")[:600]) if t else t) for i, t in cases.rows()]
    short += [(1000 + k, cases.prose(k, 90)) for k in range(60)]  # one in ten is made to repeat
    got = sorted(map(tuple, periodic.run_digests(cases.frame(spark, short)).collect()), key=cases.key)
    assert got == sorted([expected(*row) for row in short], key=cases.key)
    assert sum(r[1] > 0 for r in got) >= 6
    assert periodic.run_digests(cases.frame(spark).limit(0)).collect() == []


def test_collapsed_texts(spark):
    ship_package(spark)
    got = {r["doc_id"]: r for r in periodic.collapse(cases.frame(spark)).collect()}
    for i, t in cases.rows():
        if i is not None and t and "same same" in t:
            assert got[i]["text"] == "same" and got[i]["runs"][0].asDict() == {"start": 0, "length": 300, "period": 1}
        if i is not None and not t:
            assert got[i]["text"] == "" and got[i]["runs"] == []
