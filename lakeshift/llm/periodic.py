"""Stretches of words that repeat with a period, by multi-scale minimizers.

A run is a stretch of words with smallest period q and at least 3 q words that
no neighbouring word extends. Periods below ``DIRECT`` are found by comparing
the words with themselves that many places on. For periods from 2^j to 2^(j+1)
every stretch of K = 2^(j-1) words has a hash, and the least hash of each 2^j
places on is kept: within a run these minimizers repeat exactly q places on.

Stretches of K words with a period up to K/3 are no minimizers. They lie in runs
of smaller scales, which are known by then; a run with period q has others, or
its period would be smaller. Equal ones of the rest are more than K/3 apart, so
that at most ``NEIGHBOURS`` of them are less than two periods apart: all pairs of
these are candidates, and none is missed. A candidate is extended to both sides
by comparing words, so no result rests on a hash.

All documents of a batch are worked on together, with words between them that
occur once.

Defined cases: null or empty text, or white space alone, has no words and no run;
a null id has no checksum, so its words stay as they are; repeated rows give
repeated results; extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import by_bytes, id_and_text

#: Bytes of text worked on at a time (one text may be longer).
PIECE = 1 << 21
#: Words of the shortest run, and periods it holds at least.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Periods below this are compared directly; it is a power of two.
DIRECT = 8
#: Minimizers that can follow one within two periods: 2^(j+1) places, more than 2^(j-1)/3 apart.
NEIGHBOURS = 12
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

Run = tuple[int, int, int]  # first word, words, period


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _twice(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of 2 k words from those of k."""
    n = max(len(hashes) - k, 0)
    return _mixed(hashes[:n] * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])


def _sliding(values: np.ndarray, window: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each ``window`` values (a power of two) in a row."""
    pick = np.minimum if least else np.maximum
    at = 1
    while at < window:
        values = pick(values[:-at], values[at:])
        at *= 2
    return values


def minimizers(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some ``window`` places in a row."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    least = _sliding(hashes, window, True)
    least[least == _NONE] = 0  # nothing to keep in such a window
    edge = np.zeros(window - 1, np.uint64)
    return np.flatnonzero((_sliding(np.concatenate([edge, least, edge]), window, False) == hashes) & (hashes != _NONE))


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The stretch around place ``at`` where every word equals the one ``period`` on: first place and end."""
    end, block, top = at, 64, len(words) - period
    while end < top:
        to = min(end + block, top)
        differ = words[end:to] != words[end + period : to + period]
        if differ.any():
            end += int(differ.argmax())
            break
        end, block = to, min(2 * block, 1 << 16)
    first, block = at, 64
    while first > 0:
        down = max(first - block, 0)
        differ = words[down:first] != words[down + period : first + period]
        if differ.any():
            first -= int(differ[::-1].argmax())
            break
        first, block = down, min(2 * block, 1 << 16)
    return first, end


def _is_smallest(words: np.ndarray, first: int, period: int) -> bool:
    """Whether a stretch of at least two periods has no smaller one; it would divide this one."""
    left, p = period, 2
    while left > 1:
        if p * p > left:
            p = left
        if left % p == 0:
            while left % p == 0:
                left //= p
            d = period // p
            if np.array_equal(words[first : first + period], words[first + d : first + d + period]):
                return False
        p += 1
    return True


def _short_periods(words: np.ndarray) -> list[Run]:
    """Runs with periods below ``DIRECT`` by direct comparison, one lag at a time."""
    found: list[Run] = []
    sums: dict[int, np.ndarray] = {}
    for q in range(1, min(DIRECT, len(words) // LEAST_PERIODS + 1)):
        same = words[:-q] == words[q:]
        sums[q] = np.concatenate([[0], np.cumsum(same)])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
        first, end = edges[::2], edges[1::2]
        long = end - first >= (LEAST_PERIODS - 1) * q
        first, end = first[long], end[long] + q
        for d in range(1, q):
            if q % d == 0 and len(first):
                other = sums[d][end - d] - sums[d][first] < end - d - first
                first, end = first[other], end[other]
        found += [(a, b - a, q) for a, b in zip(first.tolist(), end.tolist(), strict=True)]
    return found


def _periodic(n: int, runs: list[Run], k: int) -> np.ndarray:
    """Places whose next ``k`` words have a period of at most ``k`` / 3."""
    edges = np.zeros(n + 1, np.int64)
    for first, length, period in runs:
        if length >= k and 3 * period <= k:
            edges[first] += 1
            edges[first + length - k + 1] -= 1
    return np.cumsum(edges)[:n] > 0


def find_runs(words: np.ndarray, sizes: np.ndarray) -> list[Run]:
    """All runs of documents that lie one after the other in ``words``, each followed by one word
    that occurs nowhere else; ``sizes`` counts the documents' words with it. Runs have at least
    ``LEAST_PERIODS`` periods, in no order; none holds such a word."""
    runs = _short_periods(words)
    size_at = np.repeat(sizes - 1, sizes)  # words of the document of each place
    place = np.arange(len(words))
    hashes, k = _mixed(words.astype(np.uint64)), 1
    scale = DIRECT
    while k < scale // 2:
        hashes, k = _twice(hashes, k), 2 * k
    while len(place) and LEAST_PERIODS * scale <= int(size_at.max()):
        # here ``hashes`` holds those of scale/2 words, for places of documents long enough
        keep = size_at >= LEAST_PERIODS * scale
        if keep.mean() < 0.7:
            place, size_at, hashes = place[keep], size_at[keep], hashes[keep[: len(hashes)]]
        # a gram that leaves its document holds a word that occurs once: it equals no other
        odd = _periodic(len(words), runs, k)[place[: len(hashes)]]
        chosen = minimizers(np.where(odd, _NONE, hashes), scale)
        order = chosen[np.lexsort((chosen, hashes[chosen]))]
        twice = _twice(hashes, k)
        pairs = []
        for r in range(1, NEIGHBOURS + 1):
            x, y = order[:-r], order[r:]
            apart = place[y] - place[x]
            near = (hashes[x] == hashes[y]) & (apart >= scale) & (apart < 2 * scale)
            x, y = x[near], y[near]
            # a run's words equal those a period on for 2^(j+1) places, so for 2^j after or before these
            last = max(len(twice) - 1, 0)
            if len(x):
                after = (y <= last) & (twice[np.minimum(x, last)] == twice[np.minimum(y, last)])
                before = (x >= scale) & (twice[np.maximum(x - scale, 0)] == twice[np.minimum(np.maximum(y - scale, 0), last)])
                x, y = x[after | before], y[after | before]
            pairs.append(np.stack([place[y] - place[x], place[x]]))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1)
        period, end = 0, 0
        for q, at in both.T.tolist():
            if q == period and at < end:
                continue  # within the stretch found last
            first, end = _extended(words, at, q)
            period = q
            if end - first >= (LEAST_PERIODS - 1) * q and _is_smallest(words, first, q):
                runs.append((first, end - first + q, q))
        hashes, k, scale = twice, 2 * k, 2 * scale
    return runs


def _repeating(doc: int | None, n: int) -> np.ndarray | None:
    """Which word stands at each place of a document that is made to repeat; None leaves it as it is."""
    if doc is None or not n:
        return None
    h = zlib.crc32(str(doc).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def runs_of(texts: list[list[bytes]], least_words: int = LEAST_WORDS) -> list[list[Run]]:
    """The runs of each list of words, by first word, then period."""
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    for k, words in enumerate(texts):
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
        flat.append(-1 - k)
    sizes = np.fromiter((len(w) + 1 for w in texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    out: list[list[Run]] = [[] for _ in texts]
    found = [r for r in set(find_runs(np.array(flat, np.int64), sizes)) if r[1] >= least_words]
    for (first, length, period), k in zip(found, np.searchsorted(starts, [r[0] for r in found], side="right") - 1, strict=True):
        out[k].append((first - int(starts[k]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(n: int, runs: list[Run]) -> np.ndarray:
    """Which of ``n`` words stay: all but those of a run after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for first, length, period in runs:
        edges[first + period] += 1
        edges[first + length] -= 1
    return np.cumsum(edges)[:n] == 0


_RUN = "array<struct<start:long,length:long,period:long>>"


def _documents(batches: Iterator[pa.RecordBatch], made_to_repeat: bool) -> Iterator[list[tuple[int | None, list[bytes], list[Run]]]]:
    for b in by_bytes(batches, "text", PIECE):
        docs, texts = b.column("doc_id").to_pylist(), [t.split() for t in b.column("text").to_pylist()]
        if made_to_repeat:
            for k, doc in enumerate(docs):
                if (at := _repeating(doc, len(texts[k]))) is not None:
                    texts[k] = [texts[k][i] for i in at.tolist()]
        yield list(zip(docs, texts, runs_of(texts), strict=True))


def _binary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(df, id_col, text_col).withColumn("text", F.col("text").cast("binary"))


def collapse(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, its runs, and its words without repetitions, one space between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _documents(batches, False):
            shown = [[{"start": r[0], "length": r[1], "period": r[2]} for r in runs] for _, _, runs in group]
            texts = [b" ".join([w for w, k in zip(words, kept(len(words), runs).tolist(), strict=True) if k]) for _, words, runs in group]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _, _ in group], pa.int64()), pa.array(shown, kind), pa.array([t.decode("utf-8", "replace") for t in texts])], ["doc_id", "runs", "text"]
            )

    return _binary(df, id_col, text_col).mapInArrow(run, f"doc_id long, runs {_RUN}, text string")


RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def run_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The number of runs of each text, its run of most periods, and digests of all runs and of
    the words left. The texts of one in ten ids, by their checksum, are first made to repeat."""

    def row(doc: int | None, words: list[bytes], runs: list[Run]) -> tuple:
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        most = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        stay = [w for w, k in zip(words, kept(len(words), runs).tolist(), strict=True) if k] if runs else words
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        return doc, len(runs), *most, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(stay)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _documents(batches, True):
            columns = zip(*(row(*g) for g in group), strict=True)
            names, kinds = zip(*(c.split() for c in RESULT.split(", ")), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(columns, kinds, strict=True)], list(names))

    return _binary(df, id_col, text_col).mapInArrow(run, RESULT)
