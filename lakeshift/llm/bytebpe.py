"""Byte-level BPE over a rank file: vectorised pre-tokenisation, cached pair merging.

Words are found without a regular expression. Each code point has a class
(letter, digit, white space, other); a class with its next code points is a
symbol, and a symbol is a transition function between the states that the split
pattern can be in. These functions form a small monoid, so composing them is a
table look-up and associative: a batch of texts is scanned as a grid, all its
columns at once, and the columns' totals by the same scan. The state before a
code point and its symbol then say whether a word begins there.

A worker keeps the ids of words it has seen. New words are merged together in
numpy, one merge per word and round: always the pair of least rank, leftmost
first. Decoding gathers the ids' bytes through the offsets of a flat table.

Defined cases: null or empty text has no tokens and decodes to no bytes; a null
id stays null; repeated rows are encoded alike; extra columns are dropped; an
empty table gives an empty result; a text of any length is worked on in pieces.
Bytes that are not UTF-8 count as U+FFFD.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache as once

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import by_bytes, id_and_text, ship_file, shipped_file
from lakeshift.llm.merging import Pairs

#: Words whose ids a Python worker keeps; beyond this number it starts anew.
CACHE_WORDS = 400_000
#: Bytes of text worked on at a time, and the length up to which a word is cached and merged among others.
PIECE, WORD = 1 << 21, 64
#: Rows of the grid that the scan composes one after the other, for all columns at once.
ROWS = 64

# Classes of code points; END stands between texts.
LETTER, DIGIT, OTHER, BLANK, SPACE, END = range(6)
# Symbols: runs go on with equal ones. BLANK_LAST and SPACE_LAST are followed by no white space,
# CUT1 and CUT2 are apostrophes before one and two letters of a contraction.
S_LETTER, S_DIGIT, S_OTHER, S_SPACE, S_BLANK_LAST, S_SPACE_LAST, S_END, S_CUT1, S_CUT2 = range(9)
# States after a symbol: within a word of a kind, after a blank that belongs to the next word, at the
# end of a word, or with one or two letters of a contraction to come.
IN_LETTERS, IN_DIGITS, IN_OTHER, IN_SPACE, PREFIX, CLOSED, TWO_LEFT, ONE_LEFT = range(8)


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after ``symbol``, and whether a word begins with it."""
    if symbol == S_LETTER:
        if state in (TWO_LEFT, ONE_LEFT):
            return (ONE_LEFT if state == TWO_LEFT else CLOSED), False
        return IN_LETTERS, state not in (IN_LETTERS, PREFIX)
    if symbol == S_DIGIT:
        return IN_DIGITS, state not in (IN_DIGITS, PREFIX)
    if symbol == S_OTHER or symbol in (S_CUT1, S_CUT2) and state in (IN_OTHER, PREFIX):
        return IN_OTHER, state not in (IN_OTHER, PREFIX)
    if symbol == S_SPACE:
        return IN_SPACE, state != IN_SPACE
    after = {S_BLANK_LAST: PREFIX, S_SPACE_LAST: CLOSED, S_END: CLOSED, S_CUT1: ONE_LEFT, S_CUT2: TWO_LEFT}
    return after[symbol], True


@once
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """All compositions of the symbols' functions: numbers of the symbols' own
    functions, the composition table, each function's values, the table of word
    beginnings, and the number of functions."""
    states, symbols = range(8), range(9)
    own = [tuple(step(s, x)[0] for s in states) for x in symbols]
    numbers: dict[tuple, int] = {tuple(states): 0}
    todo = list(numbers)
    for f in todo:  # grows while new functions appear
        for g in own:
            h = tuple(g[v] for v in f)
            if h not in numbers:
                numbers[h] = len(numbers)
                todo.append(h)
    n = len(todo)
    compose = np.array([[numbers[tuple(g[v] for v in f)] for g in todo] for f in todo], np.uint8 if n < 256 else np.uint16)
    begins = np.array([[step(s, x)[1] for x in symbols] for s in states])
    return np.array([numbers[f] for f in own], compose.dtype), compose.ravel(), np.array(todo, np.uint8), begins, n


def scan(functions: np.ndarray) -> np.ndarray:
    """Composition of each function with all before it."""
    _, compose, _, _, n = monoid()
    if len(functions) <= ROWS:
        out = functions.copy()
        for i in range(1, len(out)):
            out[i] = compose[int(out[i - 1]) * n + out[i]]
        return out
    columns = -(-len(functions) // ROWS)
    grid = np.zeros(columns * ROWS, functions.dtype)  # zero is the identity
    grid[: len(functions)] = functions
    grid = np.ascontiguousarray(grid.reshape(columns, ROWS).T)
    for i in range(1, ROWS):
        grid[i] = compose[grid[i - 1].astype(np.intp) * n + grid[i]]
    before = np.zeros(columns, functions.dtype)
    before[1:] = scan(grid[-1])[:-1]
    grid = compose[before.astype(np.intp)[None, :] * n + grid]
    return grid.T.ravel()[: len(functions)]


@once
def classes() -> np.ndarray:
    """The class of each code point, as the library's own pattern engine has it."""
    import tiktoken

    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], "<u4").tobytes().decode("utf-32-le")
    plain = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", DIGIT), (r"\s", SPACE)):
        found = bytes(tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=plain, special_tokens={}).encode_ordinary(points))
        out[np.frombuffer(found.decode().encode("utf-32-le"), "<u4")] = kind
    out[0x20] = BLANK
    return out


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``ends`` are the places between texts."""
    kind = classes()[points]
    kind[ends] = END
    after = np.append(kind[1:], END)
    more = after >= BLANK  # white space or the end follows
    names = np.array([S_LETTER, S_DIGIT, S_OTHER, S_BLANK_LAST, S_SPACE_LAST, S_END], np.uint8)
    out = names[kind]
    out[more & ((kind == BLANK) | (kind == SPACE))] = S_SPACE
    at = np.flatnonzero(points == ord("'"))
    at = at[kind[at] != END]
    if len(at):
        padded = np.append(points, np.zeros(2, points.dtype))
        first, second = padded[at + 1], padded[at + 2]
        one = np.isin(first, np.frombuffer("stmd".encode("utf-32-le"), "<u4"))
        two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (first == ord(a)) & (second == ord(b))
        out[at[one]], out[at[two]] = S_CUT1, S_CUT2
    return out


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where words begin, and the places between texts."""
    own, _, values, begins, _ = monoid()
    symbol = symbols(points, ends)
    state = np.empty(len(symbol), np.uint8)
    state[0] = CLOSED
    state[1:] = values[scan(own[symbol])[:-1], CLOSED]
    return np.flatnonzero(begins[state, symbol])


def split(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The words of all texts in order, and where each text's words end in that list."""
    joined = "\n".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
    bounds = boundaries(points, ends)
    at_end = np.zeros(len(points), bool)
    at_end[ends] = True
    inside = ~at_end[bounds[:-1]]
    a, b = bounds[:-1][inside], bounds[1:][inside]
    return [joined[i:j] for i, j in zip(a.tolist(), b.tolist(), strict=True)], np.searchsorted(a, ends)


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """A text cut at word beginnings that follow no white space, so that each piece splits as
    it does in the text. A piece holds at most ``most`` code points unless there is no such place."""
    at, size = 0, most
    while len(text) - at > size:
        points = np.frombuffer(text[at : at + size].encode("utf-32-le"), "<u4")
        bounds = boundaries(points, np.zeros(0, np.int64))
        bounds = bounds[(bounds > 0) & (bounds < len(points) - 3)]
        bounds = bounds[classes()[points[bounds - 1]] < BLANK]
        if len(bounds):
            yield text[at : at + int(bounds[-1])]
            at, size = at + int(bounds[-1]), most
        else:
            size *= 2
    yield text[at:]


class ByteRanks:
    """Tables of one rank file (base64 bytes and rank, one a line); a token's id is its rank."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max(self.ranks.values()) + 1
        self.byte_id = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], r)
            for t, r in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, rank = np.array(pairs, np.int64).reshape(-1, 3).T
        self.pairs = Pairs(size, left, right, rank, rank)
        spelt = {r: t for t, r in self.ranks.items()}
        self.length = np.array([len(spelt.get(i, b"")) for i in range(size)], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(spelt.get(i, b"") for i in range(size)), np.uint8)
        self.cache: dict[str, tuple[str, bytes]] = {}

    # -- merging --------------------------------------------------------------

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word, all merged together round by round."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        return self.pairs.merge(self.byte_id[np.frombuffer(b"".join(words), np.uint8)], lengths) if words else []

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long word, through a heap of (rank, place) in one number."""
        at = self.byte_id[np.frombuffer(word, np.uint8)]
        n = len(at)
        rank = self.pairs.rank_of(at[:-1], at[1:])
        has = np.flatnonzero(rank < self.pairs.none)
        heap = ((rank[has] << 32) | has).tolist()
        heapq.heapify(heap)
        at, after, before = at.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        spelt, ranks = self.spelt, self.ranks
        while heap:
            top = heapq.heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if at[i] < 0 or j >= n or ranks.get(spelt(at[i]) + spelt(at[j])) != r:
                continue  # one side has merged meanwhile
            at[i], at[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := ranks.get(spelt(r) + spelt(at[k]))) is not None:
                    heapq.heappush(heap, (s << 32) | i)
            h = before[i]
            if h >= 0 and (s := ranks.get(spelt(at[h]) + spelt(r))) is not None:
                heapq.heappush(heap, (s << 32) | h)
        return np.array([t for t in at if t >= 0], "<u4").tobytes()

    def spelt(self, token: int) -> bytes:
        at = self.offset[token]
        return self.flat[at : at + self.length[token]].tobytes()

    # -- texts ----------------------------------------------------------------

    def learn(self, words: set[str]) -> None:
        spelt = [(w, w.encode()) for w in words]
        short = [x for x in spelt if len(x[1]) <= WORD]
        merged = self.merge_words([b for _, b in short])
        found = [*zip([w for w, _ in short], merged, strict=True), *((w, self.merge_long(b)) for w, b in spelt if len(b) > WORD)]
        for w, ids in found:
            self.cache[w] = (",".join(map(str, np.frombuffer(ids, "<u4").tolist())), ids)

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[str, np.ndarray]]:
        """For each text its ids, decimal with commas between and as an array."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        words, ends = split(texts)
        found = list(map(self.cache.get, words))
        if None in found:
            new = {w for w, f in zip(words, found, strict=True) if f is None}
            self.learn(new)
            found = list(map(self.cache.get, words))
            for w in new:
                if len(w) > WORD:
                    del self.cache[w]
        at = 0
        for end in ends.tolist():
            here, at = found[at:end], end
            yield ",".join([f[0] for f in here]), np.frombuffer(b"".join([f[1] for f in here]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a sequence of ids."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        return self.flat[np.repeat(self.offset[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


@once
def load(path: str) -> ByteRanks:
    """One set of tables per Python worker and file."""
    return ByteRanks(path)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    for b in by_bytes(batches, "text", PIECE):
        yield b.column("doc_id").to_pylist(), [t.decode("utf-8", "replace") for t in b.column("text").to_pylist()]


def _binary(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(df, id_col, text_col).withColumn("text", F.col("text").cast("binary"))


def encode(df: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, token ids, and each token's first byte in the text's UTF-8."""
    name = ship_file(df.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shipped_file(name))
        for docs, texts in _texts(batches):
            found = []
            for text in texts:
                parts = [ids for p in pieces(text) for _, ids in bpe.encode_batch([p])]
                found.append(np.concatenate(parts))
            starts = [np.cumsum(bpe.length[i]) - bpe.length[i] for i in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array([i.astype(np.int32) for i in found], pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int64()))],
                ["doc_id", "ids", "starts"],
            )

    return _binary(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, starts array<long>")


def decode(df: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the bytes its token ids stand for (null: none)."""
    name = ship_file(df.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shipped_file(name))
        for b in batches:
            data = [bpe.decode(np.array(i or [], np.int64)) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(data, pa.binary())], ["doc_id", "data"])

    columns = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return columns.mapInArrow(run, "doc_id long, data binary")


def encode_digests(df: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` reduced in the task to counts and digests, so that no id
    leaves it. A long text goes piece by piece into its digests."""
    name = ship_file(df.sparkSession, ranks)

    def digests(bpe: ByteRanks, found: Iterator[tuple[str, np.ndarray]]) -> tuple[int, str, str]:
        n, ids, data = 0, hashlib.sha256(), hashlib.sha256()
        for decimal, numbers in found:
            if n and len(numbers):
                ids.update(b",")
            ids.update(decimal.encode())
            data.update(bpe.decode(numbers))
            n += len(numbers)
        return n, ids.hexdigest(), data.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(shipped_file(name))
        for docs, texts in _texts(batches):
            if len(texts) == 1:
                rows = [digests(bpe, (f for p in pieces(texts[0]) for f in bpe.encode_batch([p])))]
            else:
                rows = [digests(bpe, iter([f])) for f in bpe.encode_batch(texts)]
            n, ids, data = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(ids), pa.array(data)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

    return _binary(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
