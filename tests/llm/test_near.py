import hashlib
import os
import random
import re
import subprocess
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from lakeshift.llm import blocks, fingerprint, shingles, suffix, superminhash
from lakeshift.llm.common import ship_package
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def group_of_near_copies(n: int, seed: int = 1) -> list[tuple]:
    """Copies of one text with growing numbers of changes: some link to it, some only to each other, some to none."""
    r = random.Random(seed)
    base = cases.prose(seed, 200).split(" ")
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(r.randint(0, 40)):
            words[r.randrange(len(words))] = f"w{r.randrange(60)}"
        out.append((500 + i, " ".join(words)))
    return out


def components(pairs: list[tuple], k: int, percent: int) -> dict:
    sets = {i: shingle_set(t, k) for i, t in pairs if i is not None}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    u, v = root(a), root(b)
                    least[max(u, v)] = min(u, v)
    return {i: root(i) for i in ids}


def test_words_and_shingles_count_as_brute_force():
    r = random.Random(2)
    texts = ["".join(r.choice("aB \n\t\x0bé") for _ in range(r.randint(0, 30))) for _ in range(500)] + ["x" * 3000, ""]
    h, of = shingles.words([t.encode() for t in texts])
    for k in (1, 3, 5):
        s, bounds = shingles.shingles(h, of, len(texts), k)
        for i, t in enumerate(texts):
            assert len(set(s[bounds[i] : bounds[i + 1]].tolist())) == len(shingle_set(t, k)), t


def test_words_across_pieces(monkeypatch):
    texts = [cases.prose(k, 300).encode() for k in range(5)]
    whole = shingles.words(texts)
    monkeypatch.setattr(shingles, "PIECE", 100)
    for a, b in zip(whole, shingles.words(texts), strict=True):
        assert (a == b).all()


def superminhash_slowly(elements: np.ndarray, m: int) -> np.ndarray:
    h = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    for x in elements:
        p = list(range(m))
        for j in range(m):
            u = int(shingles.mix(np.array([(int(x) + (j + 1) * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
            k = j + ((u & 0xFFFFFFFF) * (m - j) >> 32)
            p[j], p[k] = p[k], p[j]
            h[p[j]] = min(int(h[p[j]]), j << 32 | u >> 32)
    return h


def test_signature_equals_the_definition():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 7, 40, 300)]
    got = superminhash.signatures(sets, 32)
    for s, row in zip(sets, got, strict=True):
        assert (superminhash_slowly(s, 32) == row).all()


def test_components_equal_brute_force(spark):
    ship_package(spark)
    pairs = cases.rows() + group_of_near_copies(120)
    for k, percent in ((3, 85), (5, 80)):
        want = components(pairs, k, percent)
        got = superminhash.near_duplicates(cases.frame(spark, pairs), k, percent).collect()
        assert len(got) == len(pairs)
        assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == want
        assert all(r["kept"] == (r["doc_id"] is None or want[r["doc_id"]] == r["doc_id"]) for r in got)
        assert {(r["doc_id"], r["n_shingles"]) for r in got} == {(i, len(shingle_set(t, k))) for i, t in pairs}


def test_cells_of_many_blocks(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(superminhash, "CELL_IDS", 16)
    monkeypatch.setattr(superminhash, "BLOCK_IDS", 16)
    pairs = group_of_near_copies(100, 7)
    got = superminhash.near_duplicates(cases.frame(spark, pairs), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == components(pairs, 3, 85)


def test_one_of_each_group_stays(spark):
    ship_package(spark)
    df = cases.frame(spark)
    got = superminhash.first_of_groups(df, 5, 80)
    assert got.schema == df.schema
    want = components(cases.rows(), 5, 80)
    assert sorted(r["doc_id"] for r in got.where("doc_id is not null").collect()) == sorted(i for i, c in want.items() if i == c)
    assert got.where("doc_id is null").count() == 2
    assert superminhash.first_of_groups(df.limit(0)).collect() == []


def test_different_texts_under_one_id_are_different_documents(spark):
    ship_package(spark)
    a, b, c, d, e = (cases.prose(400 + k, 120) for k in range(5))
    near = lambda t: t.replace(t.split(" ")[60], "changed", 1)
    pairs = [(5, a), (5, b), (5, a), (3, b), (7, near(a)), (9, c), (9, near(c)), (9, d), (11, e), (11, e.replace(" ", "  ")), (13, ""), (13, d), (2, "")]
    df = cases.frame(spark, pairs)
    got = superminhash.first_of_groups(df, 5, 80)
    assert got.schema == df.schema
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len(kept) == len(set(kept))
    assert {x for x in kept if x[0] not in (9, 11)} == {(5, a), (3, b), (13, ""), (2, "")}
    assert len([t for i, t in kept if i == 9]) == 2 and (9, d) in kept
    assert [t for i, t in kept if i == 11] == [e.replace(" ", "  ")]
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in superminhash.near_duplicates(df, 5, 80).collect()}
    n = lambda t: len(shingle_set(t, 5))
    assert {(5, n(a), 5, True), (5, n(b), 3, False), (3, n(b), 3, True), (7, n(near(a)), 5, False), (13, 0, 13, True), (13, n(d), 9, False)} <= found


def test_long_chains_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (201, 200), (200, 203)], "a long, b long")
    got = {r["id"]: r["component"] for r in superminhash.components(edges).collect()}
    assert {i: got.get(i, i) for i in range(61)} == {i: 0 for i in range(61)}
    assert got[201] == got[203] == 200


# -- repeated passages -------------------------------------------------------------


def cut_slowly(pairs: list[tuple]) -> list[tuple]:
    """(id, bytes, removed, stretches, digest of the rest) by looking up every window."""
    first: dict[bytes, int] = {}
    for i, t in pairs:
        b = (t or "").encode()
        for j in range(len(b) - 49):
            if i is not None:
                first[b[j : j + 50]] = min(first.get(b[j : j + 50], i), i)
    out = []
    for i, t in pairs:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - 49):
            if i is not None and first[b[j : j + 50]] < i:
                gone[j : j + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeats_of(spark, pairs) -> list[tuple]:
    got = suffix.repeats(cases.frame(spark, pairs)).collect()
    return sorted(((*tuple(r)[:4], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got), key=cases.key)


def test_repeats_equal_brute_force(spark):
    ship_package(spark)
    r = random.Random(4)
    passages = [cases.prose(50 + k, 15) for k in range(6)]
    pairs = cases.rows()
    for k in range(60):
        parts = [r.choice(passages)[r.randrange(10) :] if r.random() < 0.5 else cases.prose(900 + 10 * k + j, 12) for j in range(r.randint(1, 6))]
        pairs.append((1000 + k, " ".join(parts)))
    pairs += [(2000, "ab" * 400), (2001, "ab" * 300), (2002, "x" * 49), (2003, "x" * 50), (2004, "x" * 51)]
    assert repeats_of(spark, pairs) == sorted(cut_slowly(pairs), key=cases.key)


def test_repeats_over_many_pieces_blocks_and_ranges(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(suffix, "ranges_for", lambda b: 7)
    pairs = group_of_near_copies(40, 9)
    assert repeats_of(spark, pairs) == sorted(cut_slowly(pairs), key=cases.key)


def test_phrases_cover_each_window_once(monkeypatch):
    texts = [cases.prose(k, 80).encode() for k in range(6)] + [b"", b"short", b"a" * 500]
    for piece in (64, 1 << 20):
        monkeypatch.setattr(suffix, "PIECE", piece)
        p = suffix.parse(texts)
        seen, at = [], 0
        for s, n in zip(p.start.tolist(), p.count.tolist(), strict=True):
            seen += range(s, s + n)
        want = []
        for t in texts:
            want += range(at, at + max(len(t) - 49, 0))
            at += len(t)
        assert sorted(seen) == want


def shared_block() -> tuple[list[bytes], pa.Table]:
    """A block of 2 MB without copies, and answers that send all of its phrases."""
    r = random.Random(11)
    texts = [bytes(r.choices(b"abcdefghij ", k=4000)) for _ in range(500)]
    u = blocks.distinct(suffix.parse(texts).key)
    return texts, pa.table({"range": pa.array([0], pa.int32()), "shared": pa.array([b"\xff" * (len(u) // 8 + 1)], pa.binary())})


def test_a_block_is_worked_on_in_pieces():
    """Working memory of the steps on a block, in bytes for each of its bytes."""
    texts, shared = shared_block()
    size = sum(map(len, texts))
    held = {}
    tracemalloc.start()
    try:
        for name, work in (("parse", suffix.parse), ("shared", lambda t: suffix._shared_phrases(suffix.parse(t), shared, suffix.FINER))):
            work(texts[:1])
            tracemalloc.reset_peak()
            before = tracemalloc.get_traced_memory()[0]
            work(texts)
            held[name] = (tracemalloc.get_traced_memory()[1] - before) / size
    finally:
        tracemalloc.stop()
    assert held["parse"] < 14 and held["shared"] < 14, held


def test_dictionary_is_sorted_by_whole_groups(monkeypatch):
    group, sizes = np.array([2, 0, 1, 0, 2, 1, 1]), np.array([60, 70, 80, 90, 60, 60, 60])
    order = np.argsort(group, kind="stable")
    for most in (1, 161, 1000):
        monkeypatch.setattr(suffix, "SORTED", most)
        parts = [p.tolist() for p in suffix._whole_groups(order, group, sizes)]
        assert sum(parts, []) == order.tolist() and len(parts) == {1: 3, 161: 2, 1000: 1}[most]
        assert all(not set(group[a]) & set(group[b]) for a in parts for b in parts if a is not b)
    assert list(suffix._whole_groups(order[:0], group, sizes)) == []


def test_answers_do_not_depend_on_the_sort_size(monkeypatch):
    pairs = group_of_near_copies(30, 5)
    table = pa.table({"doc_id": [i for i, _ in pairs], "text": [t for _, t in pairs]})
    u = blocks.distinct(suffix.parse([t.encode() for _, t in pairs]).key)
    shared = pa.table({"range": pa.array([0], pa.int32()), "shared": pa.array([b"\xff" * (len(u) // 8 + 1)], pa.binary())})
    docs = pa.table({"block": [0], "docs": pa.array([blocks._pack(table.to_batches())], pa.binary())})
    asked = suffix._ask_phrases(suffix.FINER)(docs, shared)
    whole = suffix._answer_phrases(asked).column("runs").to_pylist()
    monkeypatch.setattr(suffix, "SORTED", 1)
    assert suffix._answer_phrases(asked).column("runs").to_pylist() == whole


def test_freed_memory_goes_back():
    """A worker that waits for its next group holds no memory of the last."""
    code = """
import numpy as np
from lakeshift.llm.common import frugal
def held():
    return next(int(x.split()[1]) for x in open("/proc/self/status") if x.startswith("RssAnon")) >> 10
def work(table):
    return [np.ones(10_000) for _ in range(1000)][-1]
before = held()
last = frugal(work)(None)
print(held() - before)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True, timeout=60)
    assert int(out.stdout) < 20


def test_ranks_are_the_order_of_windows():
    text = np.frombuffer(cases.prose(8, 300).encode() * 2, np.uint8)
    rank = suffix.window_ranks(text)
    raw = text.tobytes()
    windows = [raw[i : i + 50] for i in range(len(raw) - 49)]
    order = {w: k for k, w in enumerate(sorted(set(windows)))}
    # places too near the end for a whole window have ranks, too
    assert [order[w] for w in windows] == np.unique(rank[: len(windows)], return_inverse=True)[1].tolist()


def test_without_repeats_keeps_columns(spark):
    ship_package(spark)
    df = cases.frame(spark)
    got = suffix.without_repeats(df)
    assert got.schema == df.schema
    assert got.count() == df.count()
    by_id = {i: n for i, n, removed, _, _ in cut_slowly(cases.rows()) if not removed}
    for r in got.where("doc_id is not null").collect():
        if r["doc_id"] in by_id:
            assert len((r["text"] or "").encode()) == by_id[r["doc_id"]]
        else:
            assert r["n_chars"] == len(r["text"])
    assert suffix.without_repeats(df.limit(0)).collect() == []
    assert suffix.repeats(df.limit(0)).collect() == []


# -- fingerprints ------------------------------------------------------------------


def test_fingerprints_of_all_cases(spark):
    ship_package(spark)
    pairs = cases.rows()
    got = sorted(map(tuple, fingerprint.fingerprint_documents(cases.frame(spark, pairs)).collect()), key=cases.key)
    order = sorted(pairs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 4
        want.append((i, len(t), hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()))
    assert [g[:3] for g in got] == sorted(want, key=cases.key)
    texts = {t or "": None for _, t in pairs}
    by_text = {}
    for g in got:
        by_text.setdefault((g[1], g[3]), set()).add(g[0])
    assert len({g[3] for g in got}) <= len(texts)
    assert fingerprint.fingerprint_documents(cases.frame(spark, pairs).limit(0)).collect() == []


def test_likeness_estimates_jaccard():
    r = random.Random(6)
    words = cases.prose(12, 800).split(" ")
    for share in (0.1, 0.4, 0.9):
        other = [w if r.random() < share else f"n{k}" for k, w in enumerate(words)]
        a, b = " ".join(words), " ".join(other)
        f = fingerprint.fingerprints([a, b])
        x, y = shingle_set(a, 5), shingle_set(b, 5)
        assert abs(fingerprint.likeness(f[:1], f[1:])[0] - len(x & y) / len(x | y)) < 0.25
    assert (fingerprint.minima(np.zeros(0, np.uint64)) == fingerprint.EMPTY).all()


def test_near_documents_equal_brute_force(spark):
    ship_package(spark)
    pairs = cases.rows() + group_of_near_copies(60, 3)
    got = fingerprint.near_documents(cases.frame(spark, pairs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None} == components(pairs, 5, 80)
