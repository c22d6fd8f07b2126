"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification, components.

SuperMinHash gives each element a random permutation of the slots and visits
them in rounds: in round j an element offers ``j + r`` to the j-th slot of its
permutation, and the element stops as soon as no slot can still improve. The
correlated offers make estimates less variable than independent minima, and
most documents need one or two rounds.

Documents with equal shingle sets are one class, so copies are never compared.
Classes that share a band are first compared with one center of their bucket.
Buckets whose members are then not all in one component go on: the members of
buckets that hang together are a cluster, clusters are dealt into cells of two
bounded blocks, and each cell compares all its members through an inverted
index. A cell returns only the links that connect components, so no group's
pairs become rows. Every link is confirmed on the full sets.

Defined cases: null or empty text, and text without words, has an empty set and
is linked with nothing; fewer than ``k`` words are one shingle; rows with a null
id are linked with nothing and kept; rows of equal id and equal set count as one
document, rows of equal id and different sets as different ones (of a group's
rows with the least id, that of the least set hash is kept); extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, MapType, StructField, StructType

from lakeshift.llm.common import by_bytes, drop_staged, id_and_text, in_slices, staged
from lakeshift.llm.shingles import mix, shingles, words

#: Slots of a signature.
SLOTS = 192


def band_rows(percent: int) -> int:
    """Rows of a band. Sets at the threshold share no band with probability 3e-7 (85: 32 bands of 6; 80: 38 of 5)."""
    return 6 if percent >= 85 else 5 if percent >= 78 else 4 if percent >= 70 else 3


def set_hash(s: np.ndarray) -> bytes:
    """128 bits of a sorted set of hashes."""
    n = np.uint64(len(s))
    return (mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) ^ n).tobytes() + (mix(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64) + n).tobytes()


def signatures(sets: list[np.ndarray], m: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each set as (sets, m) integers ``round << 32 | r``."""
    h = np.full(len(sets) * m, np.iinfo(np.uint64).max, np.uint64)
    if not sets:
        return h.reshape(0, m)
    x = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    perm = first = None
    for j in range(m):
        u = mix(x + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        k = j + (((u & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            slot = first = k
        else:
            i = np.arange(len(x))
            slot = perm[i, k].astype(np.int64)
            perm[i, k] = perm[:, j]
            perm[:, j] = slot
        np.minimum.at(h, of * m + slot, (np.uint64(j) << np.uint64(32)) | (u >> np.uint64(32)))
        worst = h.reshape(-1, m).max(axis=1)
        live = (worst >= np.uint64((j + 1) << 32))[of]  # some slot can still improve
        if not live.any():
            break
        if j == 0:
            x, of, first = x[live], of[live], first[live]
            perm = np.tile(np.arange(m, dtype=np.uint8), (len(x), 1))
            perm[np.arange(len(x)), first] = 0
            perm[:, 0] = first
        elif not live.all():
            x, of, perm = x[live], of[live], perm[live]
    return h.reshape(-1, m)


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, of = words([t.encode() for t in texts])
    s, bounds = shingles(h, of, len(texts), k)
    return [np.unique(s[bounds[i] : bounds[i + 1]]) for i in range(len(texts))]


def _signed(df: DataFrame, k: int, rows: int) -> DataFrame:
    """Per document its set size, set hash and bands."""
    bands = SLOTS // rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in in_slices(by_bytes(batches, "text", 1 << 20)):
            sets = shingle_sets(cols["text"], k)
            mixed = mix(signatures(sets))
            band = np.zeros((len(sets), bands), np.uint64)
            for r in range(rows):
                band = mix(band + mixed[:, r : bands * rows : rows])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols["doc_id"], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_hash(s) for s in sets], pa.binary()),
                    pa.array(list(band.view(np.int64)), pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "same", "bands"],
            )

    return df.mapInArrow(run, "doc_id long, n_shingles long, same binary, bands array<long>")


def _sets(df: DataFrame, k: int) -> DataFrame:
    """(id, s) of the rows whose set has the hash ``same``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_slices(by_bytes(batches, "text", 1 << 20)):
            sets = shingle_sets(rows["text"], k)
            of = [j for j, s in enumerate(sets) if set_hash(s) == rows["same"][j]]
            ids = [rows["id"][j] for j in of]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([np.sort(sets[j].view(np.int64)) for j in of], pa.list_(pa.int64()))], ["id", "s"])

    return df.select("id", "same", "text").mapInArrow(run, "id long, s array<long>")


def _rooted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the edges of one partition: each node with its least node there."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while (p := parent.setdefault(i, i)) != i:
            parent[i] = parent[p]
            i = p
        return i

    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist(), strict=True):
            x, y = root(u), root(v)
            if x != y:
                parent[max(x, y)] = min(x, y)
    pairs = [(i, root(i)) for i in parent]
    yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["u", "v"], dtype="int64")


#: Copies of a parent among which its children are dealt.
SALTS = 32


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the least id reachable over ``links`` (a, b), for ids that are not it.

    Each round deals edges by their larger end, merges those that meet in a
    partition by union-find, and replaces each node's parent by the parent's
    parent, until nothing changes. Rounds grow with the logarithm of a chain.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    state, before = None, None
    while True:
        rooted = edges.repartition("u").mapInPandas(_rooted, "u long, v long")
        above = rooted.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("v"), "w")
        # only parents that have a parent themselves move their children; a star's center has
        # many, so the few such parents are copied and the children dealt over the copies
        moved = above.join(rooted.select("v").distinct(), "v", "left_semi")
        moved = moved.select("v", "w", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        dealt = rooted.withColumn("salt", F.pmod(F.xxhash64("u"), F.lit(SALTS)).cast("int"))
        edges = staged(dealt.join(moved, ["v", "salt"], "left").select("u", F.coalesce("w", "v").alias("v")), name)
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first()
        if before is not None:
            drop_staged(before)
        if now == state:
            out = staged(edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id"), name)
            drop_staged(edges)
            return out
        state, before = now, edges


#: Verification cells: sets of two blocks of ids meet in one task, with at most about so many ids and bytes a block.
BLOCK_IDS, BLOCK_BYTES = 2000, 16 << 20
#: Ids and bytes of sets in one block of a cluster; a task holds two blocks.
CELL_IDS, CELL_BYTES = 1000, 8 << 20


def _confirmed(pairs: DataFrame, sets: DataFrame, blocks: int, percent: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) whose full sets have at least ``percent`` of their union in common.

    Ids are dealt into ``blocks``, pairs into cells of two blocks. A set goes once
    to each cell that needs it, not once to each pair, so a set compared with
    thousands of others is not copied thousands of times.
    """
    cell = F.pmod(F.xxhash64("a"), F.lit(blocks)) * blocks + F.pmod(F.xxhash64("b"), F.lit(blocks))
    pairs = pairs.withColumn("cell", cell)
    needs = pairs.select(F.col("cell").alias("in_cell"), F.explode(F.array("a", "b")).alias("id")).distinct()

    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        s = dict(zip(right["id"], right["s"], strict=True))
        good = []
        for a, b in zip(left["a"], left["b"], strict=True):
            few, many = (s[a], s[b]) if len(s[a]) <= len(s[b]) else (s[b], s[a])
            at = np.minimum(np.searchsorted(many, few), len(many) - 1)
            both = int(np.count_nonzero(many[at] == few))
            good.append(100 * both >= percent * (len(few) + len(many) - both))
        return left.loc[np.array(good, bool), ["a", "b"]]

    return pairs.groupBy("cell").cogroup(needs.join(sets, "id").groupBy("in_cell")).applyInPandas(verify, "a long, b long")


def _linked_within(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links that connect what belongs together in a cell of two blocks (or of one
    with itself): every pair across is compared through an inverted index."""
    x, y = int(rows["x"].iloc[0]), int(rows["y"].iloc[0])
    rows = rows.sort_values("id").reset_index(drop=True)
    sizes = rows["s"].map(len).to_numpy()
    shingle = np.unique(np.concatenate(rows["s"].to_list()), return_inverse=True)[1]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    others = np.flatnonzero(rows["block"].to_numpy() == y)
    where = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in others]) if len(others) else np.zeros(0, np.int64)
    order = np.argsort(shingle[where], kind="stable")
    holder = np.repeat(np.arange(len(others)), sizes[others])[order]
    first = np.searchsorted(shingle[where][order], np.arange(shingle.max() + 2))
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = i = parent[parent[i]]
        return i

    component, ids, out = rows["component"].to_numpy(), rows["id"].to_numpy(), []
    for i in np.flatnonzero(rows["block"].to_numpy() == x):
        mine = shingle[bounds[i] : bounds[i + 1]]
        n = first[mine + 1] - first[mine]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[mine], n)
        both = np.bincount(holder[at], minlength=len(others))
        near = 100 * both >= percent * (sizes[i] + sizes[others] - both)
        for j in others[near & (component[others] != component[i])]:
            a, b = root(int(component[i])), root(int(component[j]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((ids[i], ids[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def grouped(classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(id, component) over all links between classes, for ids that are not their component's least.

    ``classes``: id (of the class's first document, or another number where that is
    not unique), doc_id (of that document), same (set hash) and bands.
    """
    bucket = classes.select("id", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("bucket"), "id")
    shared = bucket.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("center")).where("n > 1")
    live = staged(bucket.join(shared, "bucket").select("bucket", "id", "center"), "near-buckets")
    wanted = classes.select("id", "doc_id", "same").join(live.select("id").distinct(), "id", "left_semi")
    sets = staged(_sets(docs.join(wanted, "doc_id"), k), "near-sets")
    held = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("s")), F.lit(0))).first()
    blocks = max(1, -(-held[0] // BLOCK_IDS), -(-8 * held[1] // BLOCK_BYTES))

    # every member with the center of its buckets
    others = live.where("id != center")
    found = staged(_confirmed(others.select(F.col("id").alias("a"), F.col("center").alias("b")).distinct(), sets, blocks, percent), "near-links")
    of = components(found)

    # buckets whose other members are not all in one component: what such buckets connect is a cluster
    labelled = others.select("bucket", "id").join(of, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    open_ = labelled.groupBy("bucket").agg(F.min("id").alias("first"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    left = staged(labelled.join(open_, "bucket").select("id", "first", "component").distinct(), "near-open")
    if left.isEmpty():
        drop_staged(live, sets, found, left)
        return of
    cluster_ = components(left.select(F.col("id").alias("a"), F.col("first").alias("b")), "near-clusters")
    cluster = cluster_.withColumnRenamed("component", "cluster")
    rows = left.select("id", "component").distinct().join(cluster, "id", "left").withColumn("cluster", F.coalesce("cluster", "id")).join(sets, "id")
    rows = members = staged(rows, "near-members")
    drop_staged(left, cluster_)
    size = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("s")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / CELL_IDS), F.ceil(8 * F.col("bytes") / CELL_BYTES), F.lit(1)).cast("int")
    rows = rows.join(size.select("cluster", parts.alias("parts")), "cluster")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select("cluster", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "id", "component", "s")
    within = rows.groupBy("cluster", "x", "y").applyInPandas(lambda r: _linked_within(r, percent), "a long, b long")
    more = staged(within, "near-links")
    drop_staged(live, sets, found, members)
    if more.isEmpty():
        return of
    # the new links connect components: group these, then carry their members along
    ends = more
    for c in "ab":
        ends = ends.join(of.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")), c, "left").withColumn(c, F.coalesce(f"of_{c}", c)).select("a", "b")
    moved = components(ends)
    after = of.join(moved.select(F.col("id").alias("component"), F.col("component").alias("least")), "component", "left")
    out = staged(after.select("id", F.coalesce("least", "component").alias("component")).unionByName(moved), "near-components")
    drop_staged(more, moved, of)
    return out


def _near(df: DataFrame, k: int, percent: int, id_col: str, text_col: str, sign: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, bool]:
    """``near_duplicates`` with the set hash ``same`` of each row, and whether an id has different sets."""
    docs = id_and_text(df, id_col, text_col)
    signed = staged(sign(docs) if sign else _signed(docs, k, band_rows(percent)), "near-signed")
    able = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = able.groupBy("same").agg(F.min_by(F.struct("doc_id", "bands"), "doc_id").alias("x"), F.count(F.lit(1)).alias("copies"))
    classes = staged(first.select("same", F.col("x.doc_id").alias("id"), F.col("x.doc_id").alias("doc_id"), "x.bands", "copies"), "near-classes")
    held = signed.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("same").alias("h")).groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    clashing = staged(held.where("lo != hi").select("doc_id"), "near-clashing")
    if clashing.isEmpty():
        found = grouped(classes, docs.where("doc_id IS NOT NULL"), k, percent)
        # only classes with copies need their documents looked up
        copies = classes.where("copies > 1").select("same", "id")
        member = able.join(copies, "same").select("doc_id", "id").where("doc_id != id").distinct()
        linked = member.join(found, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component"))
        linked = linked.unionByName(found.select(F.col("id").alias("doc_id"), "component")).groupBy("doc_id").agg(F.min("component").alias("component"))
        linked = staged(linked, "near-linked")
        sizes = staged(signed.select("doc_id", "n_shingles", "same"), "near-sizes")
        drop_staged(signed, classes, found, clashing)
        least = F.coalesce("component", "doc_id")
        out = sizes.join(linked, "doc_id", "left")
        return out.select("doc_id", "n_shingles", "same", least.alias("component_id"), F.coalesce(F.col("doc_id") == least, F.lit(True)).alias("kept")), False
    # classes whose id has other sets too go under a hash of both
    marked = classes.join(clashing.withColumn("clashes", F.lit(True)), "doc_id", "left")
    apart = staged(marked.select(F.when(F.col("clashes"), F.xxhash64("doc_id", "same")).otherwise(F.col("doc_id")).alias("id"), "doc_id", "same", "bands"), "near-classes")
    found = grouped(apart, docs.where("doc_id IS NOT NULL"), k, percent)
    of = apart.select("id", "doc_id", "same").join(found, "id", "left").select("doc_id", "same", F.coalesce("component", "id").alias("group"))
    of = staged(of, "near-groups")
    best = of.groupBy("group").agg(F.min(F.struct("doc_id", "same")).alias("best"))
    linked = staged(of.join(best, "group").select("same", F.col("best.doc_id").alias("component"), F.col("best.same").alias("best")), "near-linked")
    sizes = staged(signed.select("doc_id", "n_shingles", "same"), "near-sizes")
    drop_staged(signed, classes, apart, found, of, clashing)
    out = sizes.join(linked, "same", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.col("doc_id").isNull() | F.col("best").isNull() | ((F.col("doc_id") == F.col("component")) & (F.col("same") == F.col("best")))
    return out.select("doc_id", "n_shingles", "same", component.alias("component_id"), kept.alias("kept")), True


def near_duplicates(
    df: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    sign: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Per document its set size, the component's least id, and whether it is that document.

    ``sign`` makes (doc_id, n_shingles, same, bands) of documents by another kind of signature.
    """
    return _near(df, k, percent, id_col, text_col, sign)[0].drop("same")


def _hashed(df: DataFrame, k: int, text_col: str) -> DataFrame:
    """``df`` plus ``_same``: the set hash, or for an empty set the text itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, text_col, 1 << 20):
            texts = [t or "" for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            same = [set_hash(s) if len(s) else b"0" + t.encode() for s, t in zip(shingle_sets(texts, k), texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(same, pa.binary())], [*b.schema.names, "_same"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("_same", BinaryType())]))


def first_of_groups(df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group its document of least id, once; all columns kept.

    Of rows of equal id and equal set the one of least text stays.
    """
    found, _ = _near(df, k, percent, id_col, text_col, None)
    gone = staged(found.where("NOT kept").select(F.col("doc_id").alias("_gone"), F.col("same").alias("_set")).distinct(), "near-gone")
    ids = staged(df.select(F.col(id_col).alias("_twice")).where("_twice IS NOT NULL").groupBy("_twice").count().where("count > 1").select("_twice"), "near-twice")
    again = F.col(id_col) == F.col("_twice")
    is_gone = F.col(id_col).cast("long") == F.col("_gone")
    if ids.isEmpty():
        return df.join(gone, is_gone, "left_anti")
    once = df.join(ids, again, "left_anti").join(gone, is_gone, "left_anti")
    twice = _hashed(df.join(ids, again, "left_semi"), k, text_col)
    twice = twice.join(gone, is_gone & (F.col("_same") == F.col("_set")), "left_anti")
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, MapType)]
    order = F.struct(F.col(text_col), F.xxhash64(*plain))
    row = F.min_by(F.struct(*df.columns), order).alias("_row")
    return once.unionByName(twice.groupBy(F.col(id_col).alias("_id"), "_same").agg(row).select("_row.*"))
