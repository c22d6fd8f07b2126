import bisect
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lakeshift.llm import bpe, packing
from lakeshift.llm.common import ship_package
from tests.llm import cases

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghilmnorstu'.!<|>endoftext 12éΣçñ\n\t日本\xa0") for _ in range(r.randint(0, 60))) for _ in range(n)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_word_ids_equal_the_library():
    ours, library = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    some = odd_texts(1, 3000) + ["a" + chr(c) + "b" for c in range(0x800)] + ["a" * 5000, "<|endoftext|>x<|ENDOFTEXT|>"]
    for text, (ids, decoded) in zip(some, ours.encode_batch(some), strict=True):
        e = library.encode(text, add_special_tokens=False)
        assert (ids, decoded) == (" ".join(map(str, e.ids)), library.decode(e.ids, skip_special_tokens=False)), text


def test_pair_checks_agree_with_exact_merging():
    t = bpe.WordBpe(WORD)
    r = random.Random(3)
    words = ["".join(r.choice("thereingsoua") for _ in range(r.randint(2, 14))) + bpe.END for _ in range(4000)]
    for w in words:
        g = t.greedy(w)
        fine = bool(t.compatible(np.array(g[:-1], np.int64), np.array(g[1:], np.int64)).all()) if len(g) > 1 else True
        assert fine == (g == t.merge(w)), w


def test_long_words_merge_alike():
    t = bpe.WordBpe(WORD)
    for w in ("thereintheot" * 3, "aaaa" * 9):
        symbols = [t.ids[s] for s in t.symbols(w + bpe.END)]
        assert t._merge_long(symbols) == t.merge(w + bpe.END)


def test_encode_handles_all_cases(spark):
    ship_package(spark)
    library = Tokenizer.from_file(WORD)
    got = sorted(map(tuple, bpe.encode_digests(cases.frame(spark), WORD).collect()), key=cases.key)
    want = []
    for i, t in cases.rows():
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=cases.key)
    whole = {tuple(r["ids"]) for r in bpe.encode(cases.frame(spark), WORD).collect()}
    assert tuple(library.encode("two words", add_special_tokens=False).ids) in whole
    assert bpe.encode_digests(cases.frame(spark).limit(0), WORD).collect() == []


def one_at_a_time(lengths: list[int], capacity: int) -> list[int]:
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(left, n)
        bisect.insort(left, (left.pop(i) if i < len(left) else capacity) - n)
    return left


def test_runs_equal_best_fit_decreasing_one_at_a_time():
    r = random.Random(7)
    for _ in range(200):
        capacity = r.choice([7, 16, 50, 2048])
        lengths = [min(capacity, 1 + int(r.expovariate(1 / (capacity * r.choice([0.1, 0.3, 0.6]))))) for _ in range(r.randint(0, 300))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        runs, bins = packing.best_fit_decreasing(counts, capacity)
        held: dict[int, list[tuple[int, int]]] = {}
        for n, _, k, first, offset in runs:
            for i in range(k):
                held.setdefault(first + i, []).append((offset, n))
        for pieces in held.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= capacity
        left = sorted(capacity - sum(n for _, n in p) for p in held.values())
        assert left == one_at_a_time(lengths, capacity)
        assert len(held) == bins


def test_pack_handles_all_cases(spark):
    ship_package(spark)
    library = Tokenizer.from_file(BYTE)
    got = packing.pack(cases.frame(spark), BYTE, 256, 0).collect()
    want = []
    for i, t in cases.rows():
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        at, to, piece = 0, (len(ids) - 1) % 256 + 1, 0
        while at < len(ids):
            want.append((i, piece, at, to - at, zlib.crc32(ids[at:to].tobytes())))
            at, to, piece = to, to + 256, piece + 1
    assert sorted((tuple(r)[:5] for r in got), key=cases.key) == sorted(want, key=cases.key)
    filled: dict[int, list[tuple[int, int]]] = {}
    for r in got:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 256
    assert len(filled) == len(one_at_a_time([w[3] for w in want], 256))
    assert packing.pack(cases.frame(spark).limit(0), BYTE).collect() == []


def test_byte_ids_equal_the_library():
    ours, library = packing.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for t in odd_texts(2, 3000) + ["<|endoftext|>x <|endoftext|>", " a", "a ", "a\n", "  ", "x" * 3000]:
        assert ours.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_every_code_point_gives_the_library_ids():
    words, whole = bpe.WordBpe(WORD), Tokenizer.from_file(WORD)
    bytewise, library = packing.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20000):
        texts = [f"a{chr(c)}b {chr(c)}" for c in points[at : at + 20000 : 1 if at < 0x20000 else 7]]
        want = whole.encode_batch(texts, add_special_tokens=False)
        for text, (ids, _), e in zip(texts, words.encode_batch(texts), want, strict=True):
            assert ids == " ".join(map(str, e.ids)), ascii(text)
        for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
            assert bytewise.encode(text).tolist() == e.ids, ascii(text)


def test_long_white_space_is_cut_as_the_pattern_cuts_it():
    ours, library = packing.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for run in (" " * 6000, "\n" * 6000, " \n" * 3000, "\n " * 3000, "\u3000 " * 3000):
        for text in (run, "a" + run, run + "b", "a" + run + "b " + run + "!", run + "<|endoftext|>", "x" + run + "<|endoftext|> y"):
            assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    for run in (" " * 3_000_000, "\n" * 2_000_000, " \n" * 1_000_000):
        ids = ours.encode("a" + run + "b")
        assert ours.encoding.decode(ids.tolist()) == "a" + run + "b"
