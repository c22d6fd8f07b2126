"""Product codes of vectors, with nearest entries found through fixed pivots (LAESA).

A vector of integers is cut into ``PARTS`` parts, each coded as its nearest entry
of a codebook of ``ENTRIES``. The distances of every part to ``PIVOTS`` fixed
pivots are computed once and kept beside it. In each round only the distances
between pivots and entries are new: the difference of the two bounds the distance
of part and entry from below. A part's entry of least bound is evaluated first,
and of the others only those whose bound does not exceed that distance, in groups
of parts that start at the same entry. Evaluations are in exact integers, and the
bounds allow for rounding, so the result is that of comparing all.

A round sends from each task one number per entry and component, added up by
Spark; the driver gets these sums, whose number depends on the codebooks alone.

Defined cases: a null vector, one that holds a null, NaN or infinite component,
an empty one, and one of another length than the first kept vector is dropped; a
length that parts do not divide is filled up with zeros; with fewer than
``ENTRIES`` vectors kept the codebooks are that much smaller; a null id comes after
all others and stays null; repeated ids are separate vectors, ordered by their
components; null labels are one label; components are held within ``bound`` so
that sums of squares fit 64 bits; extra columns are dropped; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import drop_staged, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 8
#: Parts that evaluate their entries together, and vectors worked on at a time.
GROUP, SLICE = 128, 4096


def bound(size: int) -> int:
    """The greatest component of vectors of ``size`` whose squared distances, added up, fit 62 bits; it fits 31."""
    return min(1 << ((60 - (size - 1).bit_length()) // 2), (1 << 31) - 1)


def to_integers(vectors: np.ndarray) -> np.ndarray:
    """floor(``SCALE`` * x) of each component, filled up to a multiple of ``PARTS``."""
    n, size = vectors.shape
    more = -size % PARTS
    most = bound(size + more)
    whole = np.clip(np.floor(vectors.astype(np.float64) * SCALE), -most, most).astype(np.int64)
    return np.pad(whole, ((0, 0), (0, more))) if more else whole


def choose_pivots(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Entries far from each other: each is the one whose nearest pivot is farthest."""
    at, near = [0], np.full(len(entries), np.inf)
    for _ in range(min(count, len(entries)) - 1):
        near = np.minimum(near, distances(entries, entries[at[-1:]])[:, 0])
        at.append(int(near.argmax()))
    return entries[at]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two integer arrays, from exact squares."""
    return np.sqrt(squares(a, b).astype(np.float64))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of two integer arrays."""
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * most * most * a.shape[1] < 1 << 52:  # products and sums are exact in floating point
        a, b = a.astype(np.float64), b.astype(np.float64)
    return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)


def nearest(parts: np.ndarray, away: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each part's nearest entry (the first of equal ones) and its squared distance."""
    between = distances(entries, pivots).astype(np.float32)
    low = np.zeros((len(parts), len(entries)), np.float32)
    for p in range(len(pivots)):
        np.maximum(low, np.abs(away[:, p, None] - between[None, :, p]), out=low)
    start = low.argmin(1)
    step = parts - entries[start]
    known = np.sqrt((step * step).sum(1).astype(np.float64))
    # single precision is off by less than this
    slack = 1e-5 * (1 + float(away.max(initial=0)) + float(between.max(initial=0)))
    open_ = low <= (known + slack)[:, None]
    best, at = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    order = np.argsort(start, kind="stable")
    for k in range(0, len(order), GROUP):
        rows = order[k : k + GROUP]
        columns = np.flatnonzero(open_[rows].any(0))
        exact = squares(parts[rows], entries[columns])
        exact[~open_[rows][:, columns]] = np.iinfo(np.int64).max
        least = exact.argmin(1)
        at[rows], best[rows] = columns[least], exact[np.arange(len(rows)), least]
    return at, best


def codebooks(first: np.ndarray) -> np.ndarray:
    """Codebooks (part, entry, component) that start as the parts of the vectors given."""
    return np.ascontiguousarray(first.reshape(len(first), PARTS, -1).transpose(1, 0, 2))


def updated(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each entry as the mean of its parts, rounded down; an entry without parts stays."""
    return np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)


def _packed(b: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(b.column(name).to_pylist()), kind).reshape(b.num_rows, PARTS, -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            s = b.slice(at, SLICE)
            yield s, _packed(s, "parts", "<i4").astype(np.int64), _packed(s, "away", "<f4")


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Vectors without null, NaN or infinite components."""
    v = F.col(vector_col).cast("array<double>")
    some = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"), F.col(label_col).alias("label"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return some.filter((F.size("vector") > 0) & ~odd)


def _first(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """The length of the first vector, and the vectors of that length that the codebooks start with."""
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    rows = vectors.orderBy(*by_id).limit(ENTRIES).collect()
    size = len(rows[0]["vector"]) if rows else PARTS
    if any(len(r["vector"]) != size for r in rows):
        rows = vectors.filter(F.size("vector") == size).orderBy(*by_id).limit(ENTRIES).collect()
    return size, np.array([r["vector"] for r in rows] or [[0.0] * size])


def _with_pivot_distances(vectors: DataFrame, size: int, pivots: np.ndarray) -> DataFrame:
    """The vectors as packed integers, with the distance of each part to each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                s = b.slice(at, SLICE)
                whole = to_integers(np.array(s.column("vector").flatten()).reshape(-1, size))
                parts = whole.reshape(len(whole), PARTS, -1)
                away = np.stack([distances(parts[:, m], pivots[m]) for m in range(PARTS)], axis=1).astype("<f4")
                packed = [pa.array([r.tobytes() for r in x], pa.binary()) for x in (whole.astype("<i4"), away)]
                yield pa.RecordBatch.from_arrays([s.column("vec_id"), s.column("label"), *packed], ["vec_id", "label", "parts", "away"])

    label = dict(vectors.dtypes)["label"]
    return vectors.filter(F.size("vector") == size).mapInArrow(run, f"vec_id long, label {label}, parts binary, away binary")


def _round(data: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: counts and sums per entry, added up over all tasks."""
    _, n, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((PARTS, n, width + 1), np.int64)
        for _, parts, away in _slices(batches):
            for m in range(PARTS):
                at, _ = nearest(parts[:, m], away[:, m], books[m], pivots[m])
                cells[m, :, 0] += np.bincount(at, minlength=n)
                order = np.argsort(at, kind="stable")
                used, begin = np.unique(at[order], return_index=True)
                cells[m, used, 1:] += np.add.reduceat(parts[order, m], begin, axis=0)
        flat = cells.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(flat[some], pa.int64())], ["cell", "value"])

    sums = data.mapInArrow(run, "cell long, value long").groupBy("cell").agg(F.sum("value").alias("value"))
    flat = np.zeros(PARTS * n * (width + 1), np.int64)
    for r in sums.collect():  # at most one row per entry and component
        flat[r["cell"]] = r["value"]
    cells = flat.reshape(PARTS, n, width + 1)
    return updated(books, cells[:, :, 0], cells[:, :, 1:])


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors (vec_id, label, code array, error), and the final codebooks."""
    vectors = kept_vectors(df, id_col, vector_col, label_col)
    size, first = _first(vectors)
    books = codebooks(to_integers(first))
    pivots = np.stack([choose_pivots(b) for b in books])
    data = staged(_with_pivot_distances(vectors, size, pivots), "codes-parts")
    for _ in range(ROUNDS):
        books = _round(data, books, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, parts, away in _slices(batches):
            found = [nearest(parts[:, m], away[:, m], books[m], pivots[m]) for m in range(PARTS)]
            code = np.stack([at for at, _ in found], axis=1)
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array(list(code.astype(np.int32)), pa.list_(pa.int32())), pa.array(error, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    label = dict(vectors.dtypes)["label"]
    codes = staged(data.mapInArrow(run, f"vec_id long, label {label}, code array<int>, error long"), "codes")
    drop_staged(data)
    return codes, books


def codes_with_errors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Each vector's code in hexadecimal digits and its error, the error of all vectors
    of its label, and a digest of the codebooks."""
    codes, books = compress(df, id_col, vector_col, label_col)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    hex_digits = F.concat(*(F.lpad(F.lower(F.hex(F.element_at("code", m + 1))), 2, "0") for m in range(PARTS)))
    of_label = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(of_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", hex_digits.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
