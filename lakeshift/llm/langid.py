"""Language identification by a byte convolutional network trained in numpy.

Whole texts are cut into fixed-length byte windows; bytes are embedded,
filters of several widths slide over them, the maximum of each filter over a
window is taken, and a softmax layer gives language probabilities. A document's
language is that of the largest mean log-probability over all its windows.

The network is fit on a bounded sample of labelled rows (``TRAIN_DOCS`` per
language, those with the least hash). Defined cases: null text and text without
a letter are ``und`` with score 0; without any labelled row all are ``und``;
a null id is not held out; repeated rows each get a row; extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.llm.common import by_bytes, in_slices

#: Bytes of a window, embedding size, filters of each width.
WINDOW, EMBED, FILTERS = 128, 4, {2: 8, 3: 8, 5: 8}
#: Documents of the training sample per language, and windows taken from each, spread over its whole text.
TRAIN_DOCS, TRAIN_WINDOWS = 800, 6
WIDEST = max(FILTERS)
#: Windows that go through the network at a time.
BATCH = 256


def windows(data: bytes) -> np.ndarray:
    """The text's bytes as rows of ``WINDOW``; the last row is filled with zeros, which stand for no byte."""
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


@dataclass
class Network:
    """Filters of all widths share one matrix over ``WIDEST`` embedded bytes; the
    rows beyond a filter's width are zero."""

    languages: list[str]
    embed: np.ndarray  # 256, EMBED
    filters: np.ndarray  # WIDEST * EMBED, all filters
    bias: np.ndarray
    out: np.ndarray  # all filters, languages
    out_bias: np.ndarray

    def columns(self, x: np.ndarray) -> np.ndarray:
        """(windows, places, WIDEST * EMBED): the embedded bytes under the filters at each place."""
        e = self.embed[x]
        padded = np.concatenate([e, np.zeros((len(x), WIDEST - 1, EMBED), np.float32)], axis=1)
        return np.concatenate([padded[:, k : k + WINDOW] for k in range(WIDEST)], axis=2)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c = self.columns(x)
        return (c.reshape(-1, WIDEST * EMBED) @ self.filters).reshape(len(x), WINDOW, -1).max(axis=1) + self.bias, c

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(self.pooled(x)[0], 0) @ self.out + self.out_bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _mask() -> np.ndarray:
    parts = []
    for width, n in FILTERS.items():
        m = np.zeros((WIDEST * EMBED, n), np.float32)
        m[: width * EMBED] = 1
        parts.append(m)
    return np.concatenate(parts, axis=1)


def train(texts: list[str], labels: list[str], epochs: int = 8, rate: float = 0.01, seed: int = 5) -> Network:
    """Adam on the cross entropy of single windows, gradients written out."""
    languages = sorted(set(labels))
    r, mask = np.random.default_rng(seed), _mask()
    xs, ys = [], []
    for t, lang in zip(texts, labels, strict=True):
        w = windows(t.encode())
        pick = np.unique(np.linspace(0, len(w) - 1, TRAIN_WINDOWS).astype(int))
        xs.append(w[pick])
        short = w[pick[: TRAIN_WINDOWS // 2]].copy()  # also windows that are mostly empty, as short texts have
        for row in short:
            row[r.integers(16, WINDOW) :] = 0
        xs.append(short)
        ys += [languages.index(lang)] * (len(pick) + len(short))
    x, y = np.concatenate(xs), np.array(ys)
    f = mask.shape[1]
    net = Network(
        languages,
        r.normal(0, 0.5, (256, EMBED)).astype(np.float32),
        (r.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(f, np.float32),
        r.normal(0, 0.1, (f, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    names = ("embed", "filters", "bias", "out", "out_bias")
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step, size = 0, 64
    total = epochs * -(-len(x) // size) + 1
    for _ in range(epochs):
        order = r.permutation(len(x))
        for at in range(0, len(x), size):
            i = order[at : at + size]
            xb, yb, n = x[i], y[i], len(i)
            c = net.columns(xb)
            a = (c.reshape(-1, c.shape[2]) @ net.filters).reshape(n, WINDOW, f)
            best = a.argmax(axis=1)  # window, filter: the place of the maximum
            h = np.take_along_axis(a, best[:, None], 1)[:, 0] + net.bias
            active = np.maximum(h, 0)
            z = active @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), yb] -= 1
            p /= n
            dh = (p @ net.out.T) * (h > 0)
            under = np.take_along_axis(c, best[:, :, None], 1)  # window, filter, WIDEST * EMBED
            dc = dh[:, :, None] * net.filters.T[None]
            place = best[:, :, None] + np.arange(WIDEST)[None, None]
            there = place < WINDOW
            byte = xb[np.arange(n)[:, None, None], np.minimum(place, WINDOW - 1)]
            de = np.zeros_like(net.embed)
            np.add.at(de, byte[there], dc.reshape(n, f, WIDEST, EMBED)[there])
            grads = {"embed": de, "filters": np.einsum("wf,wfk->kf", dh, under) * mask, "bias": dh.sum(0), "out": active.T @ p, "out_bias": p.sum(0)}
            step += 1
            slow = rate * 0.5 * (1 + np.cos(np.pi * step / total))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                update = slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, k, (getattr(net, k) - update).astype(np.float32))
    return net


def predict(net: Network | None, texts: list[str]) -> list[tuple[str, float]]:
    """(language, probability) of each whole text."""
    some = [net is not None and any(map(str.isalpha, t)) for t in texts]
    rows = [windows(t.encode()) for t, s in zip(texts, some, strict=True) if s]
    if not rows:
        return [("und", 0.0)] * len(texts)
    x = np.concatenate(rows)
    logs = np.concatenate([net.log_probabilities(x[at : at + BATCH]) for at in range(0, len(x), BATCH)])
    starts = np.concatenate(([0], np.cumsum([len(w) for w in rows])[:-1]))
    mean = np.add.reduceat(logs.astype(np.float64), starts) / np.array([len(w) for w in rows])[:, None]
    p = np.exp(mean - mean.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    found = iter(zip(p.argmax(axis=1), p.max(axis=1), strict=True))
    out = []
    for s in some:
        k, q = next(found) if s else (0, 0.0)
        out.append((net.languages[k], float(q)) if s else ("und", 0.0))
    return out


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether a document belongs to the held-out fold: crc32 of its id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, docs: int = TRAIN_DOCS) -> tuple[list[str], list[str]]:
    """Up to ``docs`` labelled texts of each language outside the held-out fold, those with the least hash of their id."""
    rows = df.where(~held_out(id_col, 4, 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    hashed = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.col(lang_col)).alias("h"))
    # a first bound by hash alone, so that the ranking sees a few thousand rows, not the corpus
    count = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = {r["lang"]: min(1.0, 3 * docs / r["n"]) for r in count.collect()}
    if not share:
        return [], []
    limit = F.element_at(F.create_map(*(x for k, v in share.items() for x in (F.lit(k), F.lit(min(int(v * 2**63), 2**63 - 1))))), F.col("lang"))
    few = hashed.where(F.col("h").bitwiseAND(F.lit(2**63 - 1)) <= limit)
    ranked = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("k") <= docs)
    got = ranked.orderBy("lang", "h", "text").select("text", "lang").collect()
    return [r["text"] for r in got], [r["lang"] for r in got]


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, whether held out from training, language, score."""
    texts, labels = training_sample(df, id_col, text_col, lang_col)
    net = train(texts, labels) if texts else None
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), held_out(id_col, 4, 2).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_slices(by_bytes(batches, "text", 1 << 19)):
            found = predict(net, rows["text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["held_out"], pa.bool_()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
