"""Personal data by weak supervision.

Four base kinds (email, ip, card, phone) are defined by fixed patterns and
always reported. Beyond them, looser patterns propose candidates, and regex,
gazetteer and context labelers vote on each (for, against or abstaining).
Expectation-maximisation over the counts of all vote patterns in the corpus
estimates how reliable each labeler is; a logistic classifier is then trained
on the posteriors, and candidates it accepts are added. The number of distinct
vote patterns is bounded, so only their counts reach the driver.

Defined cases: null or empty text has no spans; a null id stays null; repeated
rows each get a row; extra columns are dropped by ``find`` and kept by
``redact``; an empty table gives an empty result (and the prior model).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import SLICE_BYTES, by_bytes, drop_staged, id_and_text, in_slices, staged

#: Kinds in the order spans are listed at equal starts.
KINDS = ("email", "ip", "card", "phone", "secret")
Span = tuple[str, int, int]

# Fixed patterns of the base kinds.
EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from the @ outwards: a match starts where the run of
    name characters before its @ does, or where the match before it ended."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and EMAIL_NAME.match(text[start - 1]):
            start -= 1
        if start < at and (m := EMAIL_HOST.match(text, at + 1)):
            yield "email", start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(spans of the base kinds, digit runs of a card's length that fail its checksum)."""
    found, failed = list(emails(text)) if "@" in text else [], []
    if not DIGIT.search(text):
        return found, failed
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19:
            (found if luhn(digits) else failed).append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found, failed


# Looser patterns that propose candidates.
AT = re.compile(r"\[at\]|\(at\)|\{at\}")
LOOSE_HOST = re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]++)+")
LOOSE_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
SECRET = re.compile(r"(?:[Tt]oken|TOKEN|[Pp]assw(?:or)?d|PASSWORD|[Ss]ecret|SECRET|[Aa]pi[_-]?[Kk]ey|API_?KEY|[Aa]ccess[_-]?[Kk]ey)[\"']?\s*+[=:]\s*+[\"']?([A-Za-z0-9_+/=-]{6,}+)")

# Gazetteers: words that announce a kind, in the corpus' languages.
ANNOUNCE = {
    "email": {"email", "e-mail", "mail", "contact", "write", "correo", "courriel", "kontakt"},
    "phone": {"phone", "tel", "tel.", "telephone", "call", "fax", "mobile", "telefon", "teléfono", "téléphone", "handy"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "carte", "karte", "tarjeta"},
    "secret": {"token", "password", "passwd", "secret", "key", "apikey", "api_key", "access_key"},
    "ip": {"ip", "host", "server", "address"},
}
AGAINST = {"order", "invoice", "isbn", "item", "article", "no", "nr", "nr.", "no.", "version", "page", "id"}
WORD = re.compile(r"[^\s=:\"'(),;]+")


#: No listed word is longer.
LONGEST = max(len(w) for ws in (*ANNOUNCE.values(), AGAINST) for w in ws)


def loose_emails(text: str) -> Iterator[Span]:
    """Written-out addresses, found from their marker outwards as ``emails`` does from the @."""
    done = 0
    for at in AT.finditer(text):
        end = at.start() - (at.start() > done and text[at.start() - 1] == " ")
        start = end
        while start > done and EMAIL_NAME.match(text[start - 1]):
            start -= 1
        if start < end and (m := LOOSE_HOST.match(text, at.end())):
            yield "email", start, m.end()
            done = m.end()


def words_of(text: str) -> tuple[list[int], list[int]]:
    """Where the words of ``text`` start and end."""
    found = [m.span() for m in WORD.finditer(text)]
    return [a for a, _ in found], [b for _, b in found]


def before(text: str, start: int, words: tuple[list[int], list[int]]) -> list[str]:
    """The last three words before ``start``, the last up to it; empty for words longer than any listed one."""
    starts, ends = words
    n = bisect_left(starts, start)
    spans = [(starts[i], min(ends[i], start)) for i in range(max(0, n - 3), n)]
    return [text[a:b].lower() if b - a <= LONGEST else "" for a, b in spans]


def votes(kind: str, text: str, start: int, end: int, base: bool, words: tuple[list[int], list[int]] | None = None) -> str:
    """One character per labeler: ``+`` for, ``-`` against, ``0`` abstains.
    ``words``: those of the text, if known."""
    span = text[start:end]
    digits = [c for c in span if c.isdigit()]
    near = before(text, start, words_of(text) if words is None else words)
    out = []
    # regex: the strict form of the kind, or a card number that fails its checksum
    out.append("+" if base else "-" if kind == "card" else "0")
    # gazetteers: words before it
    out.append("+" if any(w in ANNOUNCE[kind] for w in near) else "0")
    out.append("-" if any(w in AGAINST for w in near) else "0")
    # context: assigned or quoted values; a currency or number sign before it
    at = start
    while at and text[at - 1] in " \"'":
        at -= 1
    sign = text[max(at - 1, 0) : at]
    out.append("+" if kind == "secret" and sign in ("=", ":") else "-" if sign in ("#", "$", "€", "£", "№") else "0")
    # shape: variety of characters
    if kind == "secret":
        varied = bool(digits) and len(digits) < len(span) and len(set(span)) >= 6
        out.append("+" if varied and len(span) >= 10 else "-" if not digits else "0")
    elif kind == "card":
        out.append("-" if len(set(digits)) <= 2 else "+" if base and digits[0] in "3456" else "0")
    elif kind == "phone":
        out.append("-" if len(set(digits)) <= 2 or (len(digits) >= 10 and digits[-10] in "01") else "+")
    else:
        out.append("+" if 3 <= len(span) <= 80 else "-")
    return "".join(out)


LABELERS = 5


def candidates(text: str) -> list[tuple[str, int, int, bool, str]]:
    """Base spans, and all proposals that overlap none of them, each with its votes.
    Proposals may overlap each other."""
    found, failed = base_spans(text)
    more = list(failed)
    if "at]" in text or "at)" in text or "at}" in text:
        more += loose_emails(text)
    if DIGIT.search(text):
        more += [("phone", m.start(), m.end()) for m in LOOSE_PHONE.finditer(text)]
    if "=" in text or ":" in text:
        more += [("secret", m.start(1), m.end(1)) for m in SECRET.finditer(text)]
    words = words_of(text) if found or more else ([], [])
    out = [(k, a, b, True, votes(k, text, a, b, True, words)) for k, a, b in found]
    if more:
        taken = sorted((a, b) for _, a, b in found)
        ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)
        begins = [a for a, _ in taken]
        for k, a, b in sorted(more, key=lambda s: (s[1], -s[2])):
            i = int(np.searchsorted(begins, b))  # base spans that begin before its end
            if not (i and ends[i - 1] > a):
                out.append((k, a, b, False, votes(k, text, a, b, False, words)))
    return out


CANDIDATES = "doc_id long, found array<struct<kind:string,start:long,end:long,base:boolean,votes:string>>"


def _find_candidates(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.string())]))
        for rows in in_slices(batches):
            found = [[dict(zip(("kind", "start", "end", "base", "votes"), c, strict=True)) for c in candidates(t)] for t in rows["text"]]
            yield pa.RecordBatch.from_arrays([pa.array(rows["doc_id"], pa.int64()), pa.array(found, kind)], ["doc_id", "found"])

    return df.mapInArrow(run, CANDIDATES)


def reliabilities(patterns: list[tuple[str, str, int]], steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """EM over (kind, votes, count): P(vote for | class) of each labeler, where it
    votes, as [class, labeler], and the posterior of each pattern. Abstaining is no
    evidence. The Beta prior holds labelers to be right more often than not, which
    also settles the case of no data."""
    v = np.array([[{"-": -1, "0": 0, "+": 1}[c] for c in p[1]] for p in patterns], int).reshape(-1, LABELERS)
    n = np.array([p[2] for p in patterns], float)
    kind = np.array([KINDS.index(p[0]) for p in patterns], int)
    votes_for, votes_against = (v > 0).astype(float), (v < 0).astype(float)
    prior = np.array([[1.0, 4.0], [4.0, 1.0]])  # class, (for, against)
    table = np.repeat(prior[:, :1] / prior.sum(axis=1, keepdims=True), LABELERS, axis=1)
    share, post = np.full(len(KINDS), 0.5), np.full(len(n), 0.5)
    for _ in range(steps):
        score = np.log(np.stack([1 - share[kind], share[kind]])) + np.log(table) @ votes_for.T + np.log(1 - table) @ votes_against.T
        post = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        weight = np.stack([(1 - post) * n, post * n])
        yes, no = prior[:, :1] + weight @ votes_for, prior[:, 1:] + weight @ votes_against
        table = yes / (yes + no)
        for k in range(len(KINDS)):
            of = kind == k
            share[k] = (2 + (post * n)[of].sum()) / (4 + n[of].sum())
    return table, post


def _features(kind: str, pattern: str) -> np.ndarray:
    marks = [float(c == x) for c in pattern for x in "+-"]
    return np.array([1.0, *marks, *(float(kind == k) for k in KINDS)])


def train(patterns: list[tuple[str, str, int]], steps: int = 40) -> np.ndarray:
    """Weights of the span classifier: logistic regression (Newton steps, ridge 1)
    on the votes and the kind, with the EM posteriors as soft labels."""
    if not patterns:
        return np.zeros(1 + 2 * LABELERS + len(KINDS))
    _, post = reliabilities(patterns)
    x = np.array([_features(k, p) for k, p, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (post - p)) - w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w = w + np.linalg.solve(curve, gradient)
    return w


def classify(weights: np.ndarray, kind: str, pattern: str) -> float:
    return float(1 / (1 + np.exp(-np.clip(_features(kind, pattern) @ weights, -30, 30))))


def _learn(found: DataFrame) -> np.ndarray:
    """Counts of every vote pattern of the corpus (at most kinds x 3**labelers rows), then the model."""
    c = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.votes").agg(F.count(F.lit(1)).alias("n"))
    return train(sorted((r["kind"], r["votes"], r["n"]) for r in c.collect()))


def accepted(found: list[dict], weights: np.ndarray, least: float = 0.5) -> list[Span]:
    """Base spans and accepted candidates, by start, then kind as listed. Of accepted
    candidates that overlap, the most probable stay."""
    spans = [(f["kind"], f["start"], f["end"]) for f in found if f["base"]]
    rated = [(classify(weights, f["kind"], f["votes"]), f["kind"], f["start"], f["end"]) for f in found if not f["base"]]
    taken: list[tuple[int, int]] = []  # disjoint, by start
    for p, k, a, b in sorted(rated, key=lambda r: (-r[0], r[2], -r[3], KINDS.index(r[1]))):
        i = bisect_left(taken, (b, 0))  # those that begin before its end
        if p >= least and not (i and taken[i - 1][1] > a):
            taken.insert(i, (a, b))
            spans.append((k, a, b))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the base spans (counts and digest) and all spans."""
    found = staged(_find_candidates(id_and_text(df, id_col, text_col)), "pii-candidates")
    weights = _learn(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_slices(batches):
            base = [accepted([f for f in fs if f["base"]], weights) for fs in rows["found"]]
            columns = [pa.array(rows["doc_id"], pa.int64())]
            columns += [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in KINDS[:4]]
            columns.append(pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string()))
            columns.append(pa.array([_joined(accepted(fs, weights)) for fs in rows["found"]], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])

    return found.mapInArrow(run, FOUND)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with the spans masked in its text, and ``length_col``, if there, set to the new length."""
    found = staged(_find_candidates(id_and_text(df, id_col, text_col)).where(F.size("found") > 0), "pii-candidates")
    weights, schema = _learn(found), df.schema
    drop_staged(found)
    has_length = length_col in df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, text_col, SLICE_BYTES):
            at = b.schema.get_field_index(text_col)
            old = b.column(at).to_pylist()
            new = []
            for t in old:
                found = candidates(t) if t else []
                spans = accepted([dict(zip(("kind", "start", "end", "base", "votes"), c, strict=True)) for c in found], weights)
                new.append(masked(t, spans) if spans else t)
            columns = list(b.columns)
            columns[at] = pa.array(new, b.schema.field(at).type)
            if has_length:
                k = b.schema.get_field_index(length_col)
                lengths = [o if a is b_ or a is None else len(b_) for o, a, b_ in zip(columns[k].to_pylist(), old, new, strict=True)]
                columns[k] = pa.array(lengths, b.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return df.mapInArrow(run, schema)
