"""Language-model scores by deleted interpolation of n-grams.

P(w | v) = a2 c(v w) / c(v) + a1 c(w) / N + a0 / (V + 1), with weights that
depend on how often the context v was seen. The weights of each frequency
bucket are learned by expectation-maximisation on training documents set aside
(one in ten), with counts from which these are deleted; scores use the counts
of all training documents.

Counts are exact over all training text: each block of documents sends its
distinct words and word pairs with their counts to key ranges and gets the
corpus counts of just these back.

Defined cases: null or empty text is the end token alone; with no training text
every probability is 1; a null id is a training document and stays null;
repeated rows each count and get a row; extra columns are dropped; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.blocks import blocks, counts_in, distinct, pack_numbers, pack_sorted, range_bounds, ranges_for, unpack, unpack_numbers, unpack_sorted
from lakeshift.llm.common import id_and_text, staged
from lakeshift.llm.shingles import mix, words

FOLDS, HELD_OUT, DEV = 7, 2, 10
END, BEGIN = np.uint64(0x452821E638D01377), np.uint64(0xBE5466CF34E90C6C)
#: Pair keys keep 56 bits.
PAIR_DROP = 8
#: Buckets of context frequency (powers of two), and steps of log2 probability in the statistics for EM.
BUCKETS, STEP, BINS = 40, 0.25, 200


def roles(ids: list[int | None]) -> np.ndarray:
    """0 training, 1 training set aside for the weights, 2 held out."""
    out = []
    for i in ids:
        c = zlib.crc32(str(i).encode()) if i is not None else 0
        out.append(2 if c % FOLDS == HELD_OUT else int(c // FOLDS % DEV == 0))
    return np.array(out, np.int8)


@dataclass
class Tokens:
    """The tokens of a block, documents in order, each with its end token."""

    ids: list
    role: np.ndarray  # of documents
    doc: np.ndarray  # of tokens
    word: np.ndarray
    context: np.ndarray
    pair: np.ndarray


def tokens(docs: bytes) -> Tokens:
    table = unpack(docs)
    ids, texts = table.column("doc_id").to_pylist(), [t.encode() for t in table.column("text").to_pylist()]
    h, of = words(texts)
    n = len(ids)
    at = np.arange(len(h)) + of  # every document before has one end token
    word, doc = np.full(len(h) + n, END), np.empty(len(h) + n, np.int64)
    word[at] = h
    doc[at] = of
    ends = np.cumsum(np.bincount(of, minlength=n) + 1) - 1
    doc[ends] = np.arange(n)
    context = np.concatenate(([BEGIN], word[:-1]))
    context[np.concatenate(([0], ends[:-1] + 1))] = BEGIN
    pair = mix(context * np.uint64(0x9E3779B97F4A7C15) + word) >> np.uint64(PAIR_DROP) << np.uint64(PAIR_DROP)
    return Tokens(ids, roles(ids), doc, word, context, pair)


def _counted(keys: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their counts in all training documents, and in those set aside."""
    u = distinct(keys)
    return u, counts_in(u, keys[role < 2]), counts_in(u, keys[role == 1])


ASK = "range int, block long, words binary, pairs binary, n binary"


def _asks(blocked: DataFrame, ranges: int) -> DataFrame:
    """For each block and key range: the block's words and pairs there, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, docs in zip(b.column("block").to_pylist(), b.column("docs"), strict=True):
                t = tokens(docs.as_buffer())
                role = t.role[t.doc]
                w, p = _counted(t.word, role), _counted(t.pair, role)
                wb, pb = range_bounds(w[0], ranges), range_bounds(p[0], ranges)
                rows = []
                for r in range(ranges):
                    x, y = slice(wb[r], wb[r + 1]), slice(pb[r], pb[r + 1])
                    counts = np.concatenate((w[1][x], w[2][x], p[1][y], p[2][y]))
                    rows.append((pack_sorted(w[0][x]), pack_sorted(p[0][y], PAIR_DROP), pack_numbers(counts)))
                columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(ranges, dtype=np.int32)), pa.array(np.full(ranges, block)), *columns], ["range", "block", "words", "pairs", "n"])

    return blocked.select("block", "docs").mapInArrow(run, ASK)


REPLY = "block long, range int, words binary, pairs binary, train_tokens long, dev_tokens long, types long"


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of one key range, for each block the counts of the keys it sent."""
    counts = [unpack_numbers(n).astype(np.int64) for n in asked["n"]]
    out = {"words": [], "pairs": []}
    stats = [0, 0, 0]
    for kind, drop in (("words", 0), ("pairs", PAIR_DROP)):
        keys = [unpack_sorted(k, drop) for k in asked[kind]]
        sizes = [len(k) for k in keys]
        u, where = np.unique(np.concatenate(keys), return_inverse=True)
        at = [0 if kind == "words" else len(c) - 2 * s for c, s in zip(counts, sizes, strict=True)]
        total = [np.bincount(where, np.concatenate([c[a + j * s : a + (j + 1) * s] for c, a, s in zip(counts, at, sizes, strict=True)]), len(u)) for j in (0, 1)]
        if kind == "words":
            stats = [int(total[0].sum()), int(total[1].sum()), int((total[0] > 0).sum())]
        ends = np.cumsum(sizes)
        for e, s in zip(ends, sizes, strict=True):
            mine = where[e - s : e]
            out[kind].append(pack_numbers(np.concatenate((total[0][mine], total[1][mine])).astype(np.int64)))
    n = len(asked)
    rows = {"block": asked["block"], "range": asked["range"], **out}
    for name, value in zip(("train_tokens", "dev_tokens", "types"), stats, strict=True):
        rows[name] = [value] + [0] * (n - 1)
    return pd.DataFrame(rows)


def _joined(replies: pd.DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Counts (all training, set aside) of a block's distinct keys in key order."""
    parts = [unpack_numbers(x).astype(np.int64) for x in replies.sort_values("range")[kind]]
    return tuple(np.concatenate([p[j * (len(p) // 2) : (j + 1) * (len(p) // 2)] for p in parts]) for j in (0, 1))


def _looked_up(t: Tokens, replies: pd.DataFrame, tokens_kept: np.ndarray | slice = slice(None)) -> list[tuple[np.ndarray, np.ndarray]]:
    """(all training, set aside) counts of the word, the context and the pair of each token."""
    w, p = distinct(t.word), distinct(t.pair)
    wc, pc = _joined(replies, "words"), _joined(replies, "pairs")
    word, pair = np.searchsorted(w, t.word[tokens_kept]), np.searchsorted(p, t.pair[tokens_kept])
    context = t.context[tokens_kept]
    begin = context == BEGIN  # as many as there are documents, so as many as end tokens
    of_context = np.searchsorted(w, np.where(begin, END, context))
    return [tuple(c[i] for c in cs) for cs, i in ((wc, word), (wc, of_context), (pc, pair))]


def _bucket(context_count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context_count + 1).astype(np.int64), BUCKETS - 1)


def _bin(p: np.ndarray) -> np.ndarray:
    """Bin of a probability by its logarithm; 0 is no probability."""
    with np.errstate(divide="ignore"):
        return np.where(p > 0, 1 + np.clip((-np.log2(p) / STEP).astype(np.int64), 0, BINS - 2), 0)


def _divided(a: np.ndarray, b: np.ndarray | float) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.broadcast_to(b, a.shape) > 0)


def learn_weights(cells: list[tuple[int, int, int, int]], types: int, steps: int = 60) -> np.ndarray:
    """EM over (bucket, bin of the pair's probability, bin of the word's, count): weights [bucket, (uniform, word, pair)].
    Four pseudo-tokens of the overall weights stand for buckets with little or no data."""
    c = np.array(cells, float).reshape(-1, 4)
    value = np.concatenate(([0.0], 2.0 ** (-(np.arange(BINS - 1) + 0.5) * STEP)))
    bucket = c[:, 0].astype(int)
    p = np.stack([np.full(len(c), 1 / (types + 1)), value[c[:, 2].astype(int)], value[c[:, 1].astype(int)]], axis=1)
    overall, weights = np.full(3, 1 / 3), np.full((BUCKETS, 3), 1 / 3)
    for _ in range(steps):
        part = weights[bucket] * p
        part *= (c[:, 3] / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        overall = (part.sum(axis=0) + 1) / (part.sum() + 3)
        got = np.stack([np.bincount(bucket, part[:, j], BUCKETS) for j in range(3)], axis=1) + 4 * overall
        weights = got / got.sum(axis=1, keepdims=True)
    return weights


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its token counts, its unigram base score and its log10 probability."""
    blocked = blocks(id_and_text(df, id_col, text_col), "lm-blocks")
    ranges = ranges_for(blocked)
    replies = staged(_asks(blocked, ranges).groupBy("range").applyInPandas(_answer, REPLY), "lm-counts")
    stats = replies.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("train_tokens", "dev_tokens", "types"))).first()
    n, n_dev, types = (int(x) for x in stats)
    by_block = replies.select("block", "range", "words", "pairs").groupBy("block")

    def dev_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks reduced to what the weights are learned from: word, context and pair of documents set aside."""
        for b in batches:
            for block, docs in zip(b.column("block").to_pylist(), b.column("docs"), strict=True):
                t = tokens(docs.as_buffer())
                own = t.role[t.doc] == 1
                w, p = distinct(t.word), distinct(t.pair)
                context = np.where(t.context == BEGIN, END, t.context)[own]
                places = np.concatenate([np.searchsorted(w, t.word[own]), np.searchsorted(w, context), np.searchsorted(p, t.pair[own])])
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([pack_numbers(places)], pa.binary())], ["block", "places"])

    def statistics(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"bucket": [], "pair_bin": [], "word_bin": [], "n": []})
        places = unpack_numbers(left["places"].iloc[0]).astype(np.int64).reshape(3, -1)
        wc, pc = (c[0] - c[1] for c in (_joined(right, "words"), _joined(right, "pairs")))  # without the documents set aside
        word, context, pair = wc[places[0]], wc[places[1]], pc[places[2]]
        cell = (_bucket(context) * BINS + _bin(_divided(pair, context))) * BINS + _bin(_divided(word, float(n - n_dev)))
        u, count = np.unique(cell, return_counts=True)
        return pd.DataFrame({"bucket": u // BINS**2, "pair_bin": u // BINS % BINS, "word_bin": u % BINS, "n": count})

    dev = blocked.select("block", "docs").mapInArrow(dev_documents, "block long, places binary").groupBy("block")
    found = dev.cogroup(by_block).applyInPandas(statistics, "bucket long, pair_bin long, word_bin long, n long")
    cells = found.groupBy("bucket", "pair_bin", "word_bin").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS * BINS ** 2
    weights = learn_weights(sorted(tuple(r) for r in cells), types)

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for docs in left["docs"]:
            t = tokens(docs)
            (word, _), (context, _), (pair, _) = _looked_up(t, right)
            of = weights[_bucket(context)]
            p = of[:, 0] / (types + 1) + of[:, 1] * _divided(word, float(n)) + of[:, 2] * _divided(pair, context)
            if not n:
                p = np.ones(len(word))
            docs_n = len(t.ids)
            base = np.log10((word + 1) / (n + (types + 1)))
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.array(t.ids, "Int64"),
                        "held_out": t.role == 2,
                        "n_tokens": np.bincount(t.doc, minlength=docs_n),
                        "n_known": np.bincount(t.doc, word > 0, docs_n).astype(np.int64),
                        "train_tokens": n,
                        "base_score": np.bincount(t.doc, base, docs_n),
                        "score": np.bincount(t.doc, np.log10(p), docs_n),
                    }
                )
            )
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in SCORES.split(", ")})

    return blocked.select("block", "docs").groupBy("block").cogroup(by_block).applyInPandas(scored, SCORES)
