"""Removal of passages that repeat across documents, by prefix-free parsing.

Documents are byte strings. A rolling hash runs over all grams of ``GRAM``
bytes; the least hash in a window of ``WINDOW`` bytes is the window's trigger,
and consecutive windows of one trigger form a phrase, which reaches to the end
of its last window. Equal windows have equal triggers, so all that can match
meets in one key range of triggers.

Phrases whose trigger occurs in one document only cannot repeat and stay where
they are. For the others each range builds the dictionary of distinct phrases,
sorts the dictionary's suffixes to ``WINDOW`` bytes by prefix doubling (each
phrase holds its windows whole, so this is their order in the corpus, too), and
combines it with the parse - which document each phrase occurs in - to the
least document of each group of equal windows. Highly repetitive text costs
little: a phrase is sorted once, however often it occurs.

Defined cases: null or empty text, and text shorter than a window, loses
nothing; a document with a null id loses nothing and takes nothing from others;
documents of equal id take nothing from each other; extra columns are dropped
by ``repeats`` and kept by ``without_repeats``; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.blocks import blocks, compress, decompress, distinct, pack_numbers, pack_sorted, range_bounds, ranges_for, unpack, unpack_numbers, unpack_sorted
from lakeshift.llm.common import frugal, give_back, id_and_text, release_shuffles, ship_package, staged
from lakeshift.llm.shingles import mix, powers

WINDOW, GRAM = 50, 24
#: Windows of a phrase at most (periodic text has one trigger throughout).
LONGEST = 64
#: Trigger keys keep 48 bits; two triggers under one key only make a range look at more.
KEY_DROP = 16
#: Key ranges of the dictionary for each range of triggers: a phrase is larger than its trigger.
FINER = 5
#: Bytes hashed at a time: a task's arrays of eight bytes per byte are this long, not as long as a block.
PIECE = (1 << 18) - WINDOW

_VALUE = np.random.default_rng(31).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def _triggers(data: np.ndarray) -> np.ndarray:
    """The trigger of each window that begins in ``data``."""
    n = len(data)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[:n], out=sums[1:])
    low = sums[GRAM:] - sums[:-GRAM]
    low *= down[: len(low)]
    low = mix(low)
    width, grams = 1, WINDOW - GRAM + 1
    while 2 * width <= grams:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[: len(low) - (grams - width)], low[grams - width :])


@dataclass
class Phrases:
    """Phrases of a block: first byte, windows, key of the trigger, document."""

    data: np.ndarray
    ends: np.ndarray  # of documents
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    doc: np.ndarray


def parse(texts: list[bytes]) -> Phrases:
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts]).astype(np.int64)
    starts, counts, keys = [], [], []
    for at in range(0, max(len(data) - WINDOW + 1, 0), PIECE):
        v = _triggers(data[at : at + PIECE + WINDOW - 1])
        # a window is whole unless a document ends inside it
        cut = ends[np.searchsorted(ends, at, side="right") : np.searchsorted(ends, at + len(v) + WINDOW, side="left")] - at
        change = np.zeros(len(v) + 1, np.int8)
        np.add.at(change, np.maximum(cut - WINDOW + 1, 0), 1)
        np.add.at(change, np.minimum(cut, len(v)), -1)
        whole = np.cumsum(change[:-1]) == 0
        begins = np.ones(len(v), bool)
        begins[1:] = (v[1:] != v[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(begins)
        length = np.diff(first, append=len(v))
        first, length = first[whole[first]], length[whole[first]]
        pieces = -(-length // LONGEST)
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(first, pieces) + within * LONGEST
        starts.append(start + at)
        counts.append(np.minimum(np.repeat(first + length, pieces) - start, LONGEST))
        keys.append(mix(v[start]) >> np.uint64(KEY_DROP) << np.uint64(KEY_DROP))
    if not starts:
        none = np.zeros(0, np.int64)
        return Phrases(data, ends, none, none, none.astype(np.uint64), none)
    start = np.concatenate(starts)
    return Phrases(data, ends, start, np.concatenate(counts), np.concatenate(keys), np.searchsorted(ends, start, side="right"))


def _texts(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    return table.column("doc_id").to_pylist(), [t.encode() for t in table.column("text").to_pylist()]


# -- which triggers occur in two documents or more -------------------------------


def _ask_shared(blocked: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, docs in zip(b.column("block").to_pylist(), b.column("docs"), strict=True):
                p = parse(_texts(unpack(docs.as_buffer()))[1])
                order = np.argsort(p.key, kind="stable")
                key, doc = p.key[order], p.doc[order]
                u = distinct(key)
                again = np.flatnonzero((key[1:] == key[:-1]) & (doc[1:] != doc[:-1]))
                several = np.zeros(len(u), bool)
                several[np.searchsorted(u, key[again])] = True
                at = range_bounds(u, ranges)
                rows = [(pack_sorted(u[at[r] : at[r + 1]], KEY_DROP), np.packbits(several[at[r] : at[r + 1]]).tobytes()) for r in range(ranges)]
                columns = [pa.array(c, pa.binary()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(ranges, dtype=np.int32)), pa.array(np.full(ranges, block)), *columns], ["range", "block", "keys", "several"])
                del p, order, key, doc, u, again, several, rows, columns
                give_back()

    return blocked.select("block", "docs").mapInArrow(run, "range int, block long, keys binary, several binary")


SHARED = "block long, range int, shared binary"


def _answer_shared(asked: pa.Table) -> pa.Table:
    keys = [unpack_sorted(k, KEY_DROP) for k in asked.column("keys").to_pylist()]
    several = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(k)) for s, k in zip(asked.column("several").to_pylist(), keys, strict=True)]
    u, where = np.unique(np.concatenate(keys), return_inverse=True)
    shared = np.bincount(where, 1.0 + np.concatenate(several), len(u)) > 1
    ends = np.cumsum([len(k) for k in keys])
    found = [np.packbits(shared[where[e - len(k) : e]]).tobytes() for e, k in zip(ends, keys, strict=True)]
    return pa.table({"block": asked.column("block"), "range": asked.column("range"), "shared": pa.array(found, pa.binary())})


# -- the dictionary of each range --------------------------------------------------


@dataclass
class Sent:
    """A block's distinct shared phrases, range by range, and where each occurs."""

    once: np.ndarray  # one place in Phrases for each distinct text, by key
    bounds: np.ndarray  # of ranges among them
    occurs: np.ndarray  # phrases (places in Phrases) with a shared trigger
    which: np.ndarray  # their text's index


def _shared_phrases(p: Phrases, shared: pa.Table, ranges: int) -> Sent:
    """``ranges``: key ranges of the dictionary; ``shared`` has answers for a divisor of as many."""
    u = distinct(p.key)
    at = range_bounds(u, ranges // FINER)
    bits = dict(zip(shared.column("range").to_pylist(), shared.column("shared").to_pylist(), strict=True))
    flag = np.concatenate([np.unpackbits(np.frombuffer(bits[r], np.uint8), count=at[r + 1] - at[r]) for r in range(ranges // FINER)]).astype(bool)
    place = np.searchsorted(u, p.key)
    occurs = np.flatnonzero(flag[place]) if len(u) else np.zeros(0, np.int64)
    occurs = occurs[np.argsort(place[occurs], kind="stable")]  # by key, so by range
    which, once, bounds, texts = np.empty(len(occurs), np.int64), [], [0], 0
    edges = np.searchsorted(place[occurs], range_bounds(u, ranges)).tolist()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        index: dict[bytes, int] = {}  # equal phrases have equal keys, so no two ranges share one
        here = occurs[a:b]
        which[a:b] = [index.setdefault(t, len(index)) for t in _phrase_texts(p, here)]
        first = np.empty(len(index), np.int64)
        first[which[a:b][::-1]] = here[::-1]
        which[a:b] += texts
        texts += len(index)
        once.append(first)
        bounds.append(texts)
    return Sent(np.concatenate(once), np.array(bounds), occurs, which)


def _phrase_texts(p: Phrases, places: np.ndarray) -> Iterator[bytes]:
    raw = p.data.data
    for s, n in zip(p.start[places].tolist(), (p.count[places] + WINDOW - 1).tolist(), strict=True):
        yield raw[s : s + n].tobytes()


def pack_ids(ids: np.ndarray) -> bytes:
    base = int(ids.min()) if len(ids) else 0
    return base.to_bytes(8, "little", signed=True) + pack_numbers((ids - base).astype(np.uint64))


def unpack_ids(data: bytes) -> np.ndarray:
    return unpack_numbers(data[8:]).astype(np.int64) + int.from_bytes(data[:8], "little", signed=True)


#: Stands for a document without id among the least documents: larger than any.
NOBODY = np.iinfo(np.int64).max

PHRASES = "range int, block long, keys binary, counts binary, texts binary, docs binary"


def _ask_phrases(ranges: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for block, docs in zip(left.column("block").to_pylist(), left.column("docs").to_pylist(), strict=True):
            ids, texts = _texts(unpack(docs))
            p = parse(texts)
            sent = _shared_phrases(p, right, ranges)
            doc = np.array([NOBODY if i is None else i for i in ids], np.int64)[p.doc[sent.occurs]]
            least = np.full(len(sent.once), NOBODY)
            np.minimum.at(least, sent.which, doc)
            for r in range(ranges):
                a, b = sent.bounds[r], sent.bounds[r + 1]
                if b > a:
                    once = sent.once[a:b]
                    blob = b"".join(_phrase_texts(p, once))
                    rows.append((r, block, pack_sorted(p.key[once], KEY_DROP), pack_numbers(p.count[once].astype(np.uint64)), compress(blob), pack_ids(least[a:b])))
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["range", "block", "keys", "counts", "texts", "docs"])

    return run


def window_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of the ``WINDOW`` bytes from each place among all such places of
    ``text``, by prefix doubling: the order of the suffixes to that depth."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.zeros(len(text), np.uint64)
    for j in range(8):
        word = word << np.uint64(8) | padded[j : j + len(text)]
    rank = np.unique(word, return_inverse=True)[1]
    known = 8
    while known < WINDOW:
        step = min(known, WINDOW - known)
        n = len(rank) - step
        if n <= 0:
            return np.zeros(0, np.int64)
        rank = np.unique(rank[:n].astype(np.uint64) * np.uint64(len(text) + 1) + rank[step:].astype(np.uint64), return_inverse=True)[1]
        known += step
    return rank


def least_documents(texts: list[bytes], docs: np.ndarray) -> np.ndarray:
    """The least document of each window of the dictionary, phrase by phrase."""
    sizes = np.array([len(t) for t in texts])
    counts = sizes - WINDOW + 1
    bounds = np.concatenate(([0], np.cumsum(counts)))
    phrase = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(bounds[-1]) - bounds[phrase] + (np.cumsum(sizes) - sizes)[phrase]
    rank = window_ranks(np.frombuffer(b"".join(texts), np.uint8))[at]
    least = np.full(int(rank.max()) + 1, NOBODY)
    np.minimum.at(least, rank, docs[phrase])
    return least[rank]


#: Bytes of a dictionary whose suffixes are sorted at a time (phrases of one trigger stay together).
SORTED = 1 << 20


def _whole_groups(phrases: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """``phrases`` (in order of their group) in parts of about ``SORTED`` bytes that divide no group."""
    if len(phrases):
        own = group[phrases]
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        before = np.cumsum(sizes[phrases]) - sizes[phrases]
        part = before[first] // SORTED
        yield from np.split(phrases, first[1:][part[1:] != part[:-1]])


FOUND = "block long, range int, runs binary"


def _answer_phrases(asked: pa.Table) -> pa.Table:
    """For each block's phrases: runs of windows with the same least document in the corpus."""
    index: dict[bytes, int] = {}
    least: list[int] = []
    trigger: list[int] = []
    mine: list[np.ndarray] = []
    for keys, counts, blob, docs in zip(*(asked.column(c).to_pylist() for c in ("keys", "counts", "texts", "docs")), strict=True):
        raw = decompress(blob)
        ends = np.cumsum(unpack_numbers(counts).astype(np.int64) + WINDOW - 1).tolist()
        which, at = np.empty(len(ends), np.int64), 0
        for k, (e, d, t) in enumerate(zip(ends, unpack_ids(docs).tolist(), unpack_sorted(keys, KEY_DROP).tolist(), strict=True)):
            i = index.setdefault(raw[at:e], len(index))
            if i == len(least):
                least.append(d)
                trigger.append(t)
            elif d < least[i]:
                least[i] = d
            which[k], at = i, e
        mine.append(which)
    texts, docs = list(index), np.array(least, np.int64)
    counts = np.array([len(t) for t in texts]) - WINDOW + 1
    bounds = np.concatenate(([0], np.cumsum(counts)))
    lowest = np.repeat(docs, counts)
    # only phrases with a trigger in common can have windows in common
    group, size = np.unique(np.array(trigger, np.uint64), return_inverse=True, return_counts=True)[1:]
    several = np.flatnonzero(size[group] > 1)
    for some in _whole_groups(several[np.argsort(group[several], kind="stable")], group, counts + WINDOW - 1):
        n = counts[some]
        at = np.arange(n.sum()) + np.repeat(bounds[some] - (np.cumsum(n) - n), n)
        lowest[at] = least_documents([texts[i] for i in some], docs[some])
    begins = np.ones(len(lowest), bool)
    begins[1:] = lowest[1:] != lowest[:-1]
    begins[bounds[:-1]] = True
    run = np.flatnonzero(begins)
    of_phrase = np.searchsorted(run, bounds)  # runs of phrase i: of_phrase[i] .. of_phrase[i + 1]
    length, value = np.diff(run, append=len(lowest)), lowest[run]
    out = []
    for which in mine:
        n = np.diff(of_phrase)[which]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(of_phrase[which], n)
        parts = [pack_numbers(n.astype(np.uint64)), pack_numbers(length[at].astype(np.uint64)), pack_ids(value[at])]
        out.append(b"".join(len(x).to_bytes(8, "little") + x for x in parts))
    return pa.table({"block": asked.column("block"), "range": asked.column("range"), "runs": pa.array(out, pa.binary())})


def _runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts, at = [], 0
    for _ in range(3):
        n = int.from_bytes(data[at : at + 8], "little")
        parts.append(data[at + 8 : at + 8 + n])
        at += 8 + n
    return unpack_numbers(parts[0]).astype(np.int64), unpack_numbers(parts[1]).astype(np.int64), unpack_ids(parts[2])


def removed_bytes(p: Phrases, ids: list[int | None], replies: pa.Table, ranges: int) -> np.ndarray:
    """Mask over the block's bytes: in a window that also begins in a document of smaller id."""
    kind = replies.column("runs").is_valid().to_numpy(zero_copy_only=False)
    sent = _shared_phrases(p, replies.filter(pa.array(~kind)), ranges)
    change = np.zeros(len(p.data) + 1, np.int32)
    if len(sent.once):
        answers = replies.filter(pa.array(kind))
        by_range = dict(zip(answers.column("range").to_pylist(), answers.column("runs").to_pylist(), strict=True))
        got = [_runs(by_range[r]) for r in range(ranges) if sent.bounds[r + 1] > sent.bounds[r]]
        n, length, value = (np.concatenate([g[j] for g in got]) for j in range(3))
        first = np.cumsum(n) - n
        each = n[sent.which]
        run = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first[sent.which], each)
        occurrence = np.repeat(np.arange(len(sent.occurs)), each)
        before = np.cumsum(length) - length
        before -= np.repeat(before[first], n)  # windows of the phrase before the run
        own = np.array([-NOBODY if i is None else i for i in ids], np.int64)[p.doc[sent.occurs]]
        gone = value[run] < own[occurrence]
        begin = p.start[sent.occurs][occurrence[gone]] + before[run[gone]]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + length[run[gone]] + WINDOW - 1, -1)
    return np.cumsum(change[:-1], dtype=np.int32, out=change[:-1]) > 0


def _exchange(blocked: DataFrame) -> tuple[DataFrame, int]:
    """(all replies for each block, number of the dictionary's key ranges)."""
    coarse = ranges_for(blocked)
    ranges = coarse * FINER
    shared = staged(_ask_shared(blocked, coarse).groupBy("range").applyInArrow(frugal(_answer_shared), SHARED), "repeats-shared")
    release_shuffles(blocked.sparkSession)
    asked = blocked.select("block", "docs").groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(frugal(_ask_phrases(ranges)), PHRASES)
    found = staged(asked.groupBy("range").applyInArrow(frugal(_answer_phrases), FOUND), "repeats-found")
    release_shuffles(blocked.sparkSession)
    none = F.lit(None).cast("binary")
    return shared.withColumn("runs", none).unionByName(found.withColumn("shared", none)), ranges


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its length in bytes, bytes and stretches removed, and the bytes that stay."""
    blocked = blocks(id_and_text(df, id_col, text_col), "repeats-blocks")
    replies, ranges = _exchange(blocked)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for docs in left.column("docs").to_pylist():
            ids, texts = _texts(unpack(docs))
            gone = removed_bytes(parse(texts), ids, right, ranges)
            at = 0
            for i, t in zip(ids, texts, strict=True):
                mask = gone[at : at + len(t)]
                n = int(mask.sum())
                spans = int(mask[:1].sum()) + int(np.count_nonzero(mask[1:] & ~mask[:-1])) if n else 0
                rows.append((i, len(t), n, spans, np.frombuffer(t, np.uint8)[~mask].tobytes() if n else t))
                at += len(t)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return blocked.select("block", "docs").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(frugal(run), RESULT)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with repeated passages cut from its text (a character cut in two goes
    whole) and ``length_col``, if there and the text has changed, set to its new length."""
    ship_package(df.sparkSession)
    names = {f"_c{k}": c for k, c in enumerate(df.columns)}
    inner = {c: k for k, c in names.items()}
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), *(F.col(f"`{c}`").alias(k) for k, c in names.items()))
    schema = rows.select(*names).schema
    blocked = blocks(rows, "repeats-blocks")
    replies, ranges = _exchange(blocked)
    text_at, length_at = inner[text_col], inner.get(length_col or "")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for docs in left.column("docs").to_pylist():
            table = unpack(docs)
            ids, texts = _texts(table)
            gone = removed_bytes(parse(texts), ids, right, ranges)
            own = table.select(list(names))
            new, lengths = own.column(text_at).to_pylist(), own.column(length_at).to_pylist() if length_at else []
            at = 0
            for k, t in enumerate(texts):
                mask = gone[at : at + len(t)]
                if mask.any():
                    new[k] = np.frombuffer(t, np.uint8)[~mask].tobytes().decode("utf-8", "ignore")
                    if length_at:
                        lengths[k] = len(new[k])
                at += len(t)
            for name, values in ((text_at, new), (length_at, lengths)):
                if name:
                    i = own.schema.get_field_index(name)
                    own = own.set_column(i, own.schema.field(i), pa.chunked_array([pa.array(values, own.schema.field(i).type)]))
            out.append(own)
        return pa.concat_tables(out) if out else pa.table([pa.array([], pa.null())] * 0)

    done = blocked.select("block", "docs").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(frugal(run), schema)
    return done.select(*(F.col(k).alias(c) for k, c in names.items()))
