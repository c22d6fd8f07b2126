"""Small documents with every awkward case, and the columns operators return."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n_tokens string, component_id int, score string, _text string, block string"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = "the an ou er ing tion re st ha le du für ñes éau".split()
    out = ["".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n)]
    for k in range(11, n, 12):
        out[k] += ".\n" if k % 24 == 11 else ","
    return " ".join(out).replace("\n ", "\n")


def texts() -> list[str | None]:
    long = prose(1, 30000)
    base = prose(2, 400)
    words = base.split(" ")
    near = " ".join(words[:200] + ["changed"] + words[201:])
    passage = prose(3, 70)
    return [
        None, "", "   \n\t ", "word", "two words", "Three Short Words", long, base, base, near, near.upper(),
        prose(4, 60) + "\n" + passage + "\n" + prose(5, 60), prose(6, 40) + "\n" + passage, passage,
        "same " * 300, "a" * 3000, "line one two\n" * 40, "### *** $$$ %%% " * 40, "é" * 60, "日本語 テキスト です。" * 20,
        "mail a.b@host.example.org or call +1 (446) 555-8962, card 4111 1111 1111 1111, ip 10.0.0.255 now",
        'token = "e11843671a2706b8500a79e6a0ed1a884af77d43" end', "<|endoftext|> and <|startoftext|>", "\x00\x1c  odd \U0001f600 spaces here",
    ]


def rows() -> list[tuple]:
    """All texts under ids out of order, one id twice, and two rows without id."""
    out = []
    for k, t in enumerate(texts()):
        out.append(((k * 7) % 101 - 3, t))
    out.append((out[7][0], out[7][1]))  # a repeated row
    out += [(None, prose(2, 400)), (None, None)]
    return out


def frame(spark: SparkSession, pairs: list[tuple] | None = None) -> DataFrame:
    """Documents with columns whose names clash with what operators add."""
    pairs = rows() if pairs is None else pairs
    data = [(i, t, "en" if k % 2 else None, None, None if t is None else len(t), k % 2 == 0, "x", k, None, "y", "z") for k, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def key(row: tuple) -> tuple:
    return tuple((x is not None, x) for x in row)
