"""Document fingerprints: MinHash of five-word shingles by universal hash functions.

The likeness of two fingerprints is the share of equal minima, an estimate of
the Jaccard similarity of the shingle sets. ``near_documents`` joins bands of
the fingerprints and verifies candidates on the full sets.

Defined cases: null or empty text, and text without words, has the fingerprint
of the empty set (all minima at their maximum), alike only to itself; fewer
than five words are one shingle; repeated rows and ids each get a row (order
among equal ids is by text); a null id sorts first and stays null; extra
columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import SLICE_ROWS, by_bytes, id_and_text, in_slices, shuffle_partitions
from lakeshift.llm.shingles import mix, shingles, words
from lakeshift.llm.superminhash import near_duplicates, set_hash, shingle_sets

WORDS = 5
HASHES = 64

_random = np.random.default_rng(77)
# multiply-shift: the upper half of a * x + b modulo 2**64 is a universal family
_A = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, HASHES, dtype=np.uint64)
EMPTY = np.full(HASHES, 0xFFFFFFFF, np.uint32)
#: Shingles multiplied at a time.
BLOCK = 4096


def minima(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over the shingles."""
    low = EMPTY.copy()
    for at in range(0, len(hashes), BLOCK):
        products = hashes[at : at + BLOCK, None] * _A[None, :] + _B[None, :]
        np.minimum(low, (products.min(axis=0) >> np.uint64(32)).astype(np.uint32), out=low)
    return low


def fingerprints(texts: list[str], k: int = WORDS) -> np.ndarray:
    """One row of minima per text."""
    h, of = words([t.encode() for t in texts])
    s, bounds = shingles(h, of, len(texts), k)
    return np.array([minima(s[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]).reshape(-1, HASHES)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as much of the start of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _following(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows dealt out in ranges of ids, each range followed by a copy of the row
    after it (``own`` false). Ranges begin at ids that exist, so the row after a
    range is the first row of that id; after the last range comes the first row of all.
    """
    spark = df.sparkSession
    ranges = max(1, shuffle_partitions(spark))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    keyed = df.select("doc_id", "text", key.alias("key"))
    found = keyed.approxQuantile("key", [i / ranges for i in range(ranges)], 1 / (20 * ranges)) if ranges > 1 else []
    low = keyed.agg(F.min("key")).first()[0]
    # quantiles are doubles: take the next id that exists at or above each
    cuts = sorted({int(c) for c in found} - {low})
    starts = _existing(keyed, cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = np.array(starts, np.int64)
        for b in batches:
            part = np.searchsorted(begin, b.column("key").to_numpy(), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part), pa.array(np.ones(len(part), bool))], [*b.schema.names, "part", "own"])

    schema = "doc_id long, text string, key long, part int, own boolean"
    rows = keyed.mapInArrow(place, schema)
    if low is None:
        return rows, 1
    heads = keyed.where(F.col("key").isin([low, *starts])).groupBy("key").agg(F.min("text").alias("text"))
    before = {low: len(starts)} | {s: i for i, s in enumerate(starts)}
    part = F.element_at(F.create_map(*(F.lit(x) for kv in before.items() for x in kv)), F.col("key")).cast("int")
    heads = heads.select(F.lit(None).cast("long").alias("doc_id"), "text", "key", part.alias("part"), F.lit(False).alias("own"))
    return rows.unionByName(heads), len(starts) + 1


def _existing(keyed: DataFrame, cuts: list[int]) -> list[int]:
    """For each cut the least key at or above it; as many rows as there are cuts."""
    if not cuts:
        return []

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = np.array(cuts, np.int64), {}
        for b in batches:
            keys = b.column(0).to_numpy()
            slot = np.searchsorted(at, keys, side="right") - 1
            for s in np.unique(slot[slot >= 0]):
                low = int(keys[slot == s].min())
                best[int(s)] = min(low, best.get(int(s), low))
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int32()), pa.array(list(best.values()), pa.int64())], ["slot", "key"])

    found = keyed.select("key").mapInArrow(nearest, "slot int, key long").groupBy("slot").agg(F.min("key").alias("key"))
    return sorted({r["key"] for r in found.collect()})


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike its own
    is to the latter and to the next document's (ascending ids; the first after the last)."""
    rows, ranges = _following(id_and_text(df, id_col, text_col))
    dealt = rows.repartitionById(ranges, F.col("part")).sortWithinPartitions(F.col("own").desc(), "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose follower is the first of the next slice

        def of(rows: list[tuple]) -> pa.RecordBatch:
            """All but the last row, each with the one after it."""
            texts = [r[1] for r in rows]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            own, other = fingerprints(texts), fingerprints(changed)
            n = len(changed)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows[:n]], pa.int64()),
                    pa.array([len(t) for t in texts[:n]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                    pa.array([f.astype(">u4").tobytes().hex() for f in own[:n]], pa.string()),
                    pa.array([f.astype(">u4").tobytes().hex() for f in other], pa.string()),
                    pa.array(likeness(own[:n], other), pa.float64()),
                    pa.array(likeness(own[:n], own[1:]), pa.float64()),
                ],
                [c.split()[0] for c in OUT.split(", ")],
            )

        for b in by_bytes(batches, "text", 1 << 20):
            for at in range(0, b.num_rows, SLICE_ROWS):
                d = b.slice(at, SLICE_ROWS).to_pydict()
                rows = [held] if held else []
                rows += [(i, t, o) for i, t, o in zip(d["doc_id"], d["text"], d["own"], strict=True)]
                last_own = next((k for k, r in enumerate(rows) if not r[2]), None)
                if last_own is not None:
                    rows = rows[: last_own + 1]
                if len(rows) > 1:
                    yield of(rows)
                held = rows[-1]
                if not held[2]:
                    return

    return dealt.select("doc_id", "text", "own").mapInArrow(run, OUT)


#: Rows of a band: documents of similarity 0.8 share none of 21 bands with probability 3e-7.
BAND_ROWS = 3


def _signed(docs: DataFrame, k: int) -> DataFrame:
    bands = HASHES // BAND_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_slices(by_bytes(batches, "text", 1 << 20)):
            sets = shingle_sets(rows["text"], k)
            low = np.array([minima(s) for s in sets], np.uint64)
            band = np.zeros((len(sets), bands), np.uint64)
            for r in range(BAND_ROWS):
                band = mix(band + low[:, r : bands * BAND_ROWS : BAND_ROWS])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) for s in sets], pa.binary()),
                    pa.array(list(band.view(np.int64)), pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "same", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, same binary, bands array<long>")


def near_documents(df: DataFrame, k: int = WORDS, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose fingerprints share a band and whose shingle sets,
    compared in full, are alike: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(df, k, percent, id_col, text_col, sign=lambda docs: _signed(docs, k))
