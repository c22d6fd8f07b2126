import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from lakeshift.llm import bytebpe
from lakeshift.llm.common import ship_package
from tests.llm import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "abstrevmld'' ''   \n\t  　 12é٣²Σ日本.,!<|>\x00\x1c\x85﻿"


@pytest.fixture(scope="module")
def bpe():
    return bytebpe.ByteRanks(RANKS)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def odd_text(r: random.Random, n: int) -> str:
    return "".join(r.choice(ODD) for _ in range(n))


def test_ids_and_bytes_equal_the_library(bpe, library):
    r = random.Random(1)
    texts = [odd_text(r, r.randint(0, 80)) for _ in range(5000)]
    for text, (decimal, ids) in zip(texts, bpe.encode_batch(texts), strict=True):
        assert decimal == ",".join(map(str, library.encode_ordinary(text))), text
        assert bpe.decode(ids) == text.encode()


def test_every_code_point_splits_as_in_the_library(bpe, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 20000):
        text = "".join(f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}'s" for c in points[at : at + 20000])
        ((decimal, _),) = bpe.encode_batch([text])
        assert decimal == ",".join(map(str, library.encode_ordinary(text)))


def test_scan_equals_one_step_after_another():
    r = random.Random(2)
    own, _, values, _, _ = bytebpe.monoid()
    for n in (1, 63, 64, 65, 5000):
        symbols = [r.randrange(9) for _ in range(n)]
        got = values[bytebpe.scan(own[np.array(symbols)]), bytebpe.CLOSED]
        state, want = bytebpe.CLOSED, []
        for x in symbols:
            state = bytebpe.step(state, x)[0]
            want.append(state)
        assert got.tolist() == want


def test_merging_together_equals_the_heap_and_tokens_keep_their_ids(bpe):
    tokens = list(bpe.ranks)
    assert [int(np.frombuffer(i, "<u4")[0]) if len(i) == 4 else -1 for i in bpe.merge_words(tokens)] == list(bpe.ranks.values())
    for t in tokens[::200]:
        assert bpe.merge_long(t * 9) == bpe.merge_words([t * 9])[0]


def test_pieces_of_a_long_text_split_as_the_whole(bpe, library):
    text = odd_text(random.Random(3), 100_000)
    ids = [int(i) for p in bytebpe.pieces(text, 1000) for decimal, _ in bpe.encode_batch([p]) for i in decimal.split(",") if i]
    assert ids == library.encode_ordinary(text)


def test_millions_of_blanks(bpe):
    for text in (" " * 3_000_000 + "x", "\n" * 1_000_000, " \n" * 500_000):
        data = b"".join(bpe.decode(ids) for p in bytebpe.pieces(text) for _, ids in bpe.encode_batch([p]))
        assert data == text.encode()


def test_all_cases(spark, library):
    ship_package(spark)
    got = sorted(map(tuple, bytebpe.encode_digests(cases.frame(spark), RANKS).collect()), key=cases.key)
    want = []
    for i, t in cases.rows():
        ids = library.encode_ordinary(t or "")
        digests = (hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (t or "").encode()))
        want.append((i, len(ids), *digests))
    assert got == sorted(want, key=cases.key)
    assert bytebpe.encode_digests(cases.frame(spark).limit(0), RANKS).collect() == []


def test_round_trip_and_offsets(spark):
    ship_package(spark)
    texts = dict(cases.rows())
    whole = bytebpe.encode(cases.frame(spark), RANKS)
    for r in whole.collect():
        if r["doc_id"] is not None:
            assert len(r["ids"]) == len(r["starts"]) and (not r["starts"] or r["starts"][0] == 0)
    for r in bytebpe.decode(whole, RANKS).collect():
        if r["doc_id"] is not None:
            assert bytes(r["data"]) == (texts[r["doc_id"]] or "").encode()
    assert [bytes(r["data"]) for r in bytebpe.decode(spark.createDataFrame([(1, None)], "doc_id int, ids array<int>"), RANKS).collect()] == [b""]
