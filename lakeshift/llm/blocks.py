"""Documents in compressed blocks, and exchanges of sorted keys between blocks and key ranges.

Operators that need corpus-wide counts of many keys work in two moves instead
of one row per occurrence: each block sends its distinct keys, packed, to the
key ranges they belong to; each range answers every block with one packed array
aligned with what that block sent. A frequent key is one entry per block, so
no key is hot, and ranges are equal because keys are hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import staged

#: Text bytes of a block (one longer document is a block of its own).
BLOCK_BYTES = 6 << 20
#: Text bytes whose keys one key range holds, on average.
RANGE_BYTES = 10 << 20

_zstd = pa.Codec("zstd", compression_level=1)


def compress(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _zstd.compress(raw, asbytes=True)


def decompress(data: bytes) -> bytes:
    return _zstd.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)


def _pack(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        for b in batches:
            w.write_batch(b)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    """The documents of a block."""
    return pa.ipc.open_stream(data).read_all()


def blocks(df: DataFrame, name: str, size: int = BLOCK_BYTES) -> DataFrame:
    """``df`` (doc_id, text and any others), written once as rows (block, docs, bytes).
    Later steps read the written blocks, so a block holds the same documents in every step."""
    import pyarrow.compute as pc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n, held, total = TaskContext.get().partitionId() << 32, 0, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first + n]), pa.array([_pack(held)], pa.binary()), pa.array([total])], ["block", "docs", "bytes"])

        for b in batches:
            if not b.num_rows:
                continue
            ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy())
            at = 0
            while at < b.num_rows:
                before = int(ends[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + size - total, side="right")))
                held.append(b.slice(at, to - at))
                total += int(ends[to - 1]) - before
                at = to
                if total >= size or at < b.num_rows:
                    yield out()
                    n, held, total = n + 1, [], 0
        if held:
            yield out()

    return staged(df.mapInArrow(run, "block long, docs binary, bytes long"), name)


def ranges_for(blocked: DataFrame, per: int = RANGE_BYTES) -> int:
    """How many key ranges the text of all blocks needs."""
    return max(1, -(-int(blocked.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]) // per))


def pack_sorted(keys: np.ndarray, drop: int = 0) -> bytes:
    """Sorted 64-bit keys as differences, byte plane by byte plane, compressed.
    The lowest ``drop`` bits, if they are zero in all keys, are left out."""
    d = keys >> np.uint64(drop)
    d = np.diff(d, prepend=np.uint64(0))
    return pack_numbers(d)


def unpack_sorted(data: bytes, drop: int = 0) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=np.uint64) << np.uint64(drop)


def pack_numbers(x: np.ndarray) -> bytes:
    """Non-negative integers as byte planes, compressed; planes of zeros cost nothing."""
    n = len(x)
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(n, 8).T)
    used = [p.tobytes() for p in planes[: 1 + max((j for j in range(8) if planes[j].any()), default=0)]] if n else []
    raw = b"".join(used)
    return n.to_bytes(4, "little") + len(used).to_bytes(1, "little") + (_zstd.compress(raw, asbytes=True) if raw else b"")


def unpack_numbers(data: bytes) -> np.ndarray:
    n, used = int.from_bytes(data[:4], "little"), data[4]
    out = np.zeros((n, 8), np.uint8)
    if n:
        raw = _zstd.decompress(data[5:], decompressed_size=n * used, asbytes=True)
        out[:, :used] = np.frombuffer(raw, np.uint8).reshape(used, n).T
    return out.view("<u8").reshape(n)


def range_bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each key range begins among the sorted keys; range r's are between bounds[r] and bounds[r + 1]."""
    at = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(at, np.arange(ranges + 1, dtype=np.uint64))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys."""
    s = np.sort(keys)
    return s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) else s


def counts_in(universe: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each key of the sorted ``universe`` occurs among ``keys`` (all of which are in it)."""
    out = np.zeros(len(universe), np.int64)
    u, n = np.unique(keys, return_counts=True)
    out[np.searchsorted(universe, u)] = n
    return out
