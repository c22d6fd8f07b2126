"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a boolean Column over the text. On a sample of rows the work of each
rule (characters read, words compared) and its selectivity (share rejected) are
counted; rules then run in descending order of rejection per work, and a document
rejected by one rule is not looked at by the next. The order never changes the
verdict, only the work, and the same table gives the same order in every run.

The sample is evaluated where the rows are: the driver gets one row of numbers per
sampled document, never a text. Windows of three words are compared by 64-bit
hashes.

Defined cases: null text counts as empty (no words, base failed); a null id is
kept as null; repeated rows each get their own verdict; extra columns are
dropped by ``quality_features`` and kept by ``quality_filter``; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the word and symbol definitions.
WORD = r"[^\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
NOT_UPPER = r"\P{Lu}+"
NOT_LETTER = r"\P{L}+"

#: Rows of the sample, and the share of rows that may be in it (by a hash of the text).
SAMPLE_ROWS, ONE_IN = 256, 8

WINDOWS = "array<struct<h:bigint,at:int>>"


def _sorted_windows() -> Column:
    """Hashes of all three-word windows with their positions, sorted by hash."""
    words, n = F.col("_words"), F.size("_words")
    placed = F.transform(
        F.slice(words, F.lit(1), n - 2),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("at")),
    )
    return F.when(n >= 3, F.sort_array(placed).cast(WINDOWS)).otherwise(F.array().cast(WINDOWS))


def _repeat_places() -> Column:
    """Sorted positions of windows found twice or more: those equal to a neighbour in hash order."""
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
    return F.sort_array(twice["at"])


def _covered_words() -> Column:
    """Words those windows cover: each adds ``min(3, distance to the one before)``."""
    at, m = F.col("_at"), F.size("_at")
    steps = F.zip_with(F.slice(at, F.lit(2), m - 1), F.slice(at, F.lit(1), m - 1), lambda b, a: F.least(F.lit(3), b - a))
    return F.when(m == 0, F.lit(0)).when(m > 0, F.aggregate(steps, F.lit(3), lambda acc, d: acc + d)).cast("long")


def _chars(keep_out: str) -> Column:
    return F.length(F.regexp_replace(F.col("_text"), keep_out, "")).cast("long")


#: Feature column: the columns it is made from, and how. ``_text`` is the text.
FEATURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "_words": (("_text",), lambda: F.regexp_extract_all(F.col("_text"), F.lit(WORD), F.lit(0))),
    "_lines": (("_text",), lambda: F.filter(F.split(F.col("_text"), "\n"), lambda line: line.rlike(WORD))),
    "n_words": (("_words",), lambda: F.size("_words").cast("long")),
    "word_chars": (("_words",), lambda: F.length(F.array_join("_words", "")).cast("long")),
    "n_symbols": (("_text",), lambda: _chars(NOT_SYMBOL)),
    "_n_upper": (("_text",), lambda: _chars(NOT_UPPER)),
    "_n_letters": (("_text",), lambda: _chars(NOT_LETTER)),
    "_n_lines": (("_lines",), lambda: F.size("_lines").cast("long")),
    "n_dup_lines": (("_lines",), lambda: (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")),
    "_sorted": (("_words",), _sorted_windows),
    "_at": (("_sorted",), _repeat_places),
    "n_repeat_words": (("_at",), _covered_words),
}


def _work(name: str) -> Column:
    """Work that the feature column takes by itself, in characters read once. Sorting and
    comparing an element counts as so many characters; the weights are fixed values."""
    chars, words = F.length("_text").cast("double"), F.size("_words").cast("double")
    per_word = {"n_words": 0, "word_chars": 2, "_sorted": 12, "_at": 4, "n_repeat_words": 1}
    if name in per_word:
        return per_word[name] * words * (F.log2(words + 2) if name == "_sorted" else F.lit(1.0))
    return {"_words": 4, "_lines": 2, "n_dup_lines": 1, "_n_lines": 0}.get(name, 1) * chars


def _made_of(names: tuple[str, ...]) -> list[str]:
    """The named features and all they are made from."""
    out: list[str] = []
    for name in names:
        if name in FEATURES and name not in out:
            out += [x for x in _made_of(FEATURES[name][0]) if x not in out] + [name]
    return out


def _with(df: DataFrame, names: tuple[str, ...], only_where: Column | None = None) -> DataFrame:
    """``df`` plus the named features and what they are made from, each in a step
    of its own so that no array is built twice; null outside ``only_where``."""
    for name in names:
        if name in df.columns:
            continue
        made_from, make = FEATURES[name]
        df = _with(df, made_from, only_where)
        df = df.withColumn(name, make() if only_where is None else F.when(only_where, make()))
    return df


@dataclass(frozen=True)
class Rule:
    """A rule rejects where ``fails`` (over the feature columns it ``needs``) is true."""

    name: str
    needs: tuple[str, ...]

    def fails(self) -> Column:
        n = F.col("n_words")
        return {
            "too_short": lambda: n < 50,
            "repeated_windows": lambda: 100 * F.col("n_repeat_words") > 50 * n,
            "symbols": lambda: 10 * F.col("n_symbols") > n,
            "repeated_lines": lambda: 100 * F.col("n_dup_lines") > 40 * F.col("_n_lines"),
            "word_length": lambda: (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
            "shouting": lambda: 2 * F.col("_n_upper") > F.col("_n_letters"),
        }[self.name]()


#: The two rules every verdict starts from, and the rules the cascade adds.
BASE_RULES = (Rule("too_short", ("n_words",)), Rule("repeated_windows", ("n_words", "n_repeat_words")))
MORE_RULES = (
    Rule("symbols", ("n_words", "n_symbols")),
    Rule("repeated_lines", ("n_dup_lines", "_n_lines")),
    Rule("word_length", ("n_words", "word_chars")),
    Rule("shouting", ("_n_upper", "_n_letters")),
)


def cascade_order(df: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per work, both counted on at most ``sample_rows`` rows; of
    equal ones the earlier comes first.

    Rows are taken by a hash of their text. ``collect`` of a limit reads partition
    after partition until it has enough, so the sample costs no scan of the table,
    and takes them in the table's order, so it is the same in every run.
    """
    some = df.select(F.coalesce(F.col(text), F.lit("")).alias("_text")).where(F.pmod(F.xxhash64("_text"), F.lit(ONE_IN)) == 0)
    some = _with(some, ("_words", *(n for rule in rules for n in rule.needs)))
    rejects = [F.coalesce(rule.fails(), F.lit(False)).alias(f"r{k}") for k, rule in enumerate(rules)]
    works = [sum((_work(n) for n in _made_of(rule.needs)), F.lit(1.0)).alias(f"w{k}") for k, rule in enumerate(rules)]
    rows = some.select(*rejects, *works).limit(sample_rows).collect()
    gain = [sum(r[f"r{k}"] for r in rows) / max(sum(r[f"w{k}"] for r in rows), 1.0) for k in range(len(rules))]
    return [rules[k] for k in sorted(range(len(rules)), key=lambda k: (-gain[k], k))]


def _cascade(df: DataFrame, rules: list[Rule], rejected: Column | None = None) -> DataFrame:
    """``df`` plus ``rejected_by``: the first rule that rejects, null if none. What a
    rule needs is computed only for rows that no earlier rule rejected, nor ``rejected``
    (then ``rejected_by`` is "base")."""
    start = F.lit(None) if rejected is None else F.when(rejected, F.lit("base"))
    df = df.withColumn("_by0", start.cast("string"))
    for k, rule in enumerate(rules, 1):
        still_open = F.col(f"_by{k - 1}").isNull()
        df = _with(df, rule.needs, still_open)
        df = df.withColumn(f"_by{k}", F.when(still_open, F.when(rule.fails(), F.lit(rule.name))).otherwise(F.col(f"_by{k - 1}")))
    return df.withColumn("rejected_by", F.col(f"_by{len(rules)}"))


def quality_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept`` and ``rejected_by``
    (the first cascade rule that rejects; null if kept or if a base rule failed).

    All five counts are returned for every row, so the order of the cascade decides
    only about what they do not need; a row that a base rule rejects does not enter it."""
    order = cascade_order(df, MORE_RULES, text_col)
    out = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = _with(out, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    out = out.withColumn("base_failed", BASE_RULES[0].fails() | BASE_RULES[1].fails())
    out = _cascade(out, order, F.col("base_failed"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.col("rejected_by").isNull().alias("kept"),
        F.when(~F.col("base_failed"), F.col("rejected_by")).alias("rejected_by"),
    )


def quality_filter(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` no rule rejects, all columns kept.

    The text goes through the steps once, with its other columns under plain names.
    Rejected rows leave through ``explode`` of a null array, not through a filter: the
    optimizer would push a filter below the steps and repeat their expressions inside it.
    """
    order = cascade_order(df, BASE_RULES + MORE_RULES, text_col)
    text = F.col(f"`{text_col}`")
    others = {c: f"_c{k}" for k, c in enumerate(df.columns) if c != text_col}
    out = df.select(*(F.col(f"`{c}`").alias(k) for c, k in others.items()), text.isNull().alias("_null"), F.coalesce(text, F.lit("")).alias("_text"))
    out = _cascade(out, order)
    kept = F.when(F.col("rejected_by").isNull(), F.array(F.lit(True)))
    out = out.select(*others.values(), "_null", "_text", F.explode(kept))
    whole = F.when(~F.col("_null"), F.col("_text"))
    return out.select(*((whole if c == text_col else F.col(others[c])).alias(c) for c in df.columns))
