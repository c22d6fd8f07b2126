"""Best-fit-decreasing packing of tokenised documents into fixed-size sequences.

Pieces are ints between 1 and ``capacity``, so which piece goes where depends
only on how many pieces have each length. The driver gets that histogram (at
most ``capacity`` rows at any data size) and runs best-fit decreasing over it:
for each length, longest first, a segment tree over remaining capacities finds
the tightest open bins in logarithmic time, and all pieces of that length that
fit such bins move at once. The result is the same as for one document at a
time. Each piece then finds its place from its rank among the pieces of its
length, which Spark numbers in parallel.

Defined cases: null or empty text is the end token alone; a null id stays null;
repeated rows are packed one by one; extra columns are dropped; an empty table
gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.bpe import byte_characters
from lakeshift.llm.common import id_and_text, in_slices, shuffle_partitions, staged

#: Characters of white space in a row that are cut out before the split pattern.
LONG_SPACE = 5000


class ByteBpe:
    """Token ids of a byte-level tokenizer file whose merges are numbered in rank order.

    Added tokens found in a text count as such, as the tokenizers library does by default.
    """

    # The fixed split pattern of this kind of tokenizer file.
    SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    LONG_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, byte_of = spec["model"]["vocab"], {c: b for b, c in enumerate(byte_characters())}
        made = [vocab["".join(m)] for m in spec["model"]["merges"]]
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or made != sorted(made):
            raise ValueError(f"{path} is not a plain byte-level BPE in rank order")
        self.special = [a["content"] for a in spec["added_tokens"]]
        self.encoding = tiktoken.Encoding(
            path,
            pat_str=self.SPLIT,
            mergeable_ranks={bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in {a["content"] for a in spec["added_tokens"]}},
            special_tokens={a["content"]: a["id"] for a in spec["added_tokens"]},
        )

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text. Of a run of white space, what is before its last blank (or all
        of it, where the text or a special token follows) is one word; long runs are cut out
        as such before the pattern, which would run out of stack, sees them."""
        parts, at = [], 0
        for run in self.LONG_SPACE.finditer(text) if len(text) > LONG_SPACE else ():
            begin, end = run.span()
            if end < len(text) and not any(text.startswith(t, end) for t in self.special):
                end -= 1
            parts += [self._plain(text[at:begin]), np.array(self.encoding._encode_single_piece(text[begin:end]), "<u4")]
            at = end
        return np.concatenate([*parts, self._plain(text[at:])]) if parts else self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, salt int"


def tokenised_pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int, salts: int) -> DataFrame:
    """Pieces of each document's ids plus ``end_id``: only what is longer than
    ``capacity`` is cut, and then the first piece takes the remainder. ``salt``
    deals the pieces evenly whatever the ids and lengths are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, dealt = load(tokenizer), np.array([end_id], "<u4").tobytes(), 0
        for rows in in_slices(batches):
            out: list[tuple] = []
            for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                ids = bpe.encode(text).tobytes() + end
                n = len(ids) // 4
                at, to, piece = 0, (n - 1) % capacity + 1, 0
                while at < n:
                    out.append((doc, piece, at, to - at, zlib.crc32(ids[4 * at : 4 * to]), dealt % salts))
                    at, to, piece, dealt = to, to + capacity, piece + 1, dealt + 1
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in PIECES.split(", ")])

    return df.mapInArrow(run, PIECES)


class OpenBins:
    """Bins grouped by remaining capacity, with a segment tree over the capacities
    that have any: the tightest fit is found in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.size)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]  # ranges: first bin, count

    def _mark(self, r: int) -> None:
        at = self.size + r
        self.some[at] = bool(self.bins[r])
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def add(self, r: int, first: int, count: int) -> None:
        if r and count:
            self.bins[r].append((first, count))
            self._mark(r)

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` that some bin has."""
        at = self.size + length
        if self.some[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:  # a subtree to the right has some
                at += 1
                while at < self.size:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None

    def take(self, r: int) -> tuple[int, int]:
        first_count = self.bins[r].pop()
        self._mark(r)
        return first_count


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where pieces go, given how many have each length: runs of (length, first
    rank, count, first bin, offset), where the i-th piece of a run goes to the
    i-th bin of it; and the number of bins.

    Pieces of one length fill a bin as long as they fit before the next bin is
    used, as they would one at a time: a bin that has just got tighter is the
    tightest. A group of bins is split at most once per length, so the number of
    runs depends on ``capacity``, not on the number of pieces.
    """
    runs, bins, opened = [], OpenBins(capacity), 0
    for length in range(capacity, 0, -1):
        left, rank = counts.get(length, 0), 0
        while left:
            r = bins.tightest(length)
            if r is None:
                r, first, there = capacity, opened, -(-left // (capacity // length))
                opened += there
            else:
                first, there = bins.take(r)
            each = r // length
            full = min(there, left // each)
            over = left - full * each if full < there else 0
            over = min(over, each - 1)
            for slot in range(each):
                n = full + (slot < over)
                if n:
                    runs.append((length, rank, n, first, capacity - r + slot * length))
                    rank += n
            left -= full * each + over
            used = full + (over > 0)
            bins.add(r - each * length, first, full)
            if over:
                bins.add(r - over * length, first + full, 1)
            bins.add(r, first + used, there - used)
    return runs, opened


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    spark = df.sparkSession
    salts = shuffle_partitions(spark)
    pieces = staged(tokenised_pieces(id_and_text(df, id_col, text_col), tokenizer, capacity, end_id, salts), "pack-pieces")
    cells = pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    runs, _ = best_fit_decreasing(counts, capacity)
    runs.sort()
    table = spark.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))  # its size is bounded by ``capacity``

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.join(cells, ["length", "salt"]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = (t[:, 0] << 44) | t[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(key, (length << 44) | rank, side="right") - 1
            sequence, offset = t[at, 3] + rank - t[at, 1], t[at, 4]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], [*b.schema.names[:5], "sequence_id", "offset"])

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*columns, "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
