"""BPE encoding and decoding with a word-end vocabulary: speculate, verify, merge.

A word's tokens are first guessed by greedy longest match. A sequence of tokens
is the one merging would give if and only if every adjacent pair is
*compatible*: no merge across the border would have come before the merges
inside the two tokens. All pairs of all new words of a batch are tested at once
in numpy; only words with an incompatible pair are merged exactly.

Defined cases: null or empty text has no tokens and decodes to the empty
string; a null id stays null; repeated rows are encoded alike; extra columns
are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import normalizers

from lakeshift.llm.common import id_and_text, in_slices
from lakeshift.llm.merging import Pairs

#: Words whose encoding a Python worker keeps; beyond this number it starts anew.
CACHE_WORDS = 600_000
#: Characters up to which words are merged many at a time.
MERGED_TOGETHER = 64
#: Stands for the word-end mark while matching: one character that no byte maps to.
END = "\ue000"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


def newer_characters() -> str:
    """Characters that Python's own tables do not have yet."""
    known = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    return "".join(c for c in regex.findall(r"\P{Cn}", known) if unicodedata.category(c) == "Cn")


def later_characters(newer: str) -> str:
    """Those that are letters or digits to the pattern engine here, but not to that of the
    tokenizers library, whose tables may be older."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    theirs = Split(Regex(r"[\p{L}\p{N}]"), "removed", invert=True).pre_tokenize_str(newer)
    return "".join(sorted(set(regex.findall(r"[\p{L}\p{N}]", newer)) - {c for piece, _ in theirs for c in piece}))


class WordBpe:
    """Tables of one tokenizer file (BPE with ``</w>`` ends, lower-casing, NFC)."""

    # Fixed values of the tokenizer: its split pattern and the white space it collapses.
    SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    ODD_SPACE = regex.compile(r"[\x1c-\x1f]")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, mark = spec["model"], spec["model"]["end_of_word_suffix"]
        self.library_normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.tokens: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None

        def inner(t: str) -> str:
            return t[: -len(mark)] + END if t.endswith(mark) else t

        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        size = max(self.ids.values()) + 1
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.rank = np.full(size, -1, np.int64)  # base symbols come before all merges
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, z = self.ids[inner(a)], self.ids[inner(b)], self.ids[inner(a + b)]
            self.merges[x, y] = (rank, z)
            self.left[z], self.right[z], self.rank[z] = x, y, rank
        x, y, rank, z = np.array([(x, y, r, z) for (x, y), (r, z) in self.merges.items()], np.int64).T
        self.pairs = Pairs(size, x, y, rank, z)
        self.bytes = byte_characters()
        newer = newer_characters()
        self.newer = np.zeros(0x110000, bool)
        self.newer[list(map(ord, newer))] = True
        later = later_characters(newer)
        self.later = set(later)
        plain = "(?V1)" + self.SPLIT.pattern if not later else f"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\\p{{L}}--[{later}]]+|[\\p{{N}}--[{later}]]|(?:[^\\s\\p{{L}}\\p{{N}}]|[{later}])+"
        self.split_later = regex.compile(plain)
        # a token that merging would not give for its own text is never proposed
        own = self.merge_all(list(self.ids))
        self.propose = {t: i for (t, i), m in zip(self.ids.items(), own, strict=True) if self.rank[i] < 0 or m == [i]}
        self.longest = max(map(len, self.propose))
        self.cache: dict[str, tuple[str, str]] = {}

    # -- one word -------------------------------------------------------------

    def symbols(self, word: str) -> list[str]:
        return [*word[:-2], word[-2:]] if word.endswith(END) else list(word)

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """Exact merging of each word: always the lowest rank, leftmost first."""
        out: list[list[int]] = [[] for _ in words]
        short = [k for k, w in enumerate(words) if len(w) <= MERGED_TOGETHER]
        first = [[self.ids[s] for s in self.symbols(words[k])] for k in short]
        if short:
            merged = self.pairs.merge(np.fromiter((i for f in first for i in f), np.int64), np.fromiter(map(len, first), np.int64, len(first)))
            for k, ids in zip(short, merged, strict=True):
                out[k] = np.frombuffer(ids, "<u4").tolist()
        for k, w in enumerate(words):
            if len(w) > MERGED_TOGETHER:
                out[k] = self._merge_long([self.ids[s] for s in self.symbols(w)])
        return out

    def merge(self, word: str) -> list[int]:
        return self.merge_all([word])[0]

    def _merge_long(self, at: list[int]) -> list[int]:
        """The same through a heap, for words whose length would make a round for each merge slow."""
        n = len(at)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := self.merges.get((at[i], at[j]))):
                heapq.heappush(heap, (m[0], i, at[i], at[j], m[1]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, x, y, z = heapq.heappop(heap)
            j = after[i] if at[i] == x else n
            if j >= n or at[j] != y:
                continue  # one side has merged meanwhile
            at[i], at[j] = z, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [t for t in at if t >= 0]

    def greedy(self, word: str) -> list[int]:
        """Longest match from the left; the word-end mark never stands alone."""
        out, i, n, get = [], 0, len(word), self.propose.get
        body = n - 1 if word.endswith(END) else n + 1
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                if j != body and (t := get(word[i:j])) is not None:
                    break
            out.append(t)
            i = j
        return out

    # -- many words -----------------------------------------------------------

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens, whether merging would keep the border
        between them: the merges on both sides of it are taken back, latest first,
        and none that crosses it may be older than what has been taken back."""
        a, b = a.copy(), b.copy()
        good, limit = np.ones(len(a), bool), np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            found = self.pairs.rank_of(x, y)
            crosses = (found < self.pairs.none) & (found < limit[live])
            good[live[crosses]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~crosses & ((rx >= 0) | (ry >= 0))
            take_left = rx > ry
            i = live[go & take_left]
            limit[i], a[i] = self.rank[a[i]], self.right[a[i]]
            i = live[go & ~take_left]
            limit[i], b[i] = self.rank[b[i]] + 1, self.left[b[i]]  # at equal rank the left one comes first
            live = live[go]
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        guesses = [self.greedy(w) for w in words]
        flat = np.fromiter((t for g in guesses for t in g), np.int64)
        ends = np.cumsum([len(g) for g in guesses])
        if len(flat) < 2:
            return guesses
        inside = np.ones(len(flat) - 1, bool)
        inside[ends[:-1] - 1] = False  # the pair spans two words
        at = np.flatnonzero(inside)
        bad = at[~self.compatible(flat[at], flat[at + 1])]
        failing = np.unique(np.searchsorted(ends, bad, side="right")).tolist()
        for w, ids in zip(failing, self.merge_all([words[w] for w in failing]), strict=True):
            guesses[w] = ids
        return guesses

    # -- texts ----------------------------------------------------------------

    def normal(self, text: str) -> str:
        if not text.isascii() and self.newer[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            text = self.library_normal(text)  # its tables have what Python's lack
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # no final form of sigma

    def chunks(self, text: str) -> list[str]:
        """Normalised text between white space; merges never cross white space."""
        text = self.normal(text)
        return [c for c in self.SPACE.split(text) if c] if self.ODD_SPACE.search(text) else text.split()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokenizer file names no decoder: tokens stand with single spaces between them."""
        return " ".join(self.tokens[i] for i in ids)

    def pieces(self, chunk: str) -> list[str]:
        """What the tokenizer's pattern splits a chunk into; most are letters, or letters and one mark."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk]
            if chunk[:-1].isalpha() and chunk[-1] in ",.;:!?":
                return [chunk[:-1], chunk[-1]]
        return (self.SPLIT if self.later.isdisjoint(chunk) else self.split_later).findall(chunk)

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks the cache lacks, all their new words together."""
        cache = self.cache
        split = {c: self.pieces(c) for c in chunks}
        words = list({w for ws in split.values() for w in ws if w not in cache})
        spelt = [w + END if w.isascii() and w.isprintable() else "".join([self.bytes[b] for b in w.encode()]) + END for w in words]
        new = {w: (" ".join(map(str, t)), self.decode(t)) for w, t in zip(words, self.encode_words(spelt), strict=True)}
        for chunk, ws in split.items():
            if len(ws) == 1 and ws[0] in new:
                cache[chunk] = new[ws[0]]
            else:
                got = [new.get(w) or cache[w] for w in ws]
                cache[chunk] = (" ".join([g[0] for g in got]), " ".join([g[1] for g in got]))

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids (decimal, one space between) and its decoded form."""
        parts: list[list[str]] = []
        for text in texts:
            if self.special_split and "<|" in text:
                row = []
                for k, part in enumerate(self.special_split.split(text)):
                    row += [" " + part] if k % 2 else self.chunks(part)  # a chunk never holds a space
                parts.append(row)
            else:
                parts.append(self.chunks(text))
        if not self.cache or len(self.cache) > CACHE_WORDS:
            self.cache = {" " + t: (str(i), t) for t, i in self.special.items()}
        self.learn({c for c in set().union(*parts) if c not in self.cache})
        for row in parts:
            found = [self.cache[c] for c in row]
            yield " ".join([f[0] for f in found if f[0]]), " ".join([f[1] for f in found if f[0]])


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One set of tables per Python worker and file."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, token ids, and the text the ids decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for rows in in_slices(batches):
            got = list(bpe.encode_batch(rows["text"]))
            ids = [[int(i) for i in g[0].split()] for g in got]
            yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([g[1] for g in got])], ["doc_id", "ids", "decoded"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` reduced in the task to counts and digests, so that no id leaves it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for rows in in_slices(batches):
            ids, decoded = zip(*bpe.encode_batch(rows["text"]), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()),
                    pa.array([i.count(" ") + 1 if i else 0 for i in ids], pa.int64()),
                    pa.array([_sha256(i) for i in ids]),
                    pa.array([_sha256(d) for d in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
