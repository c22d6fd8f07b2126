"""Ranges of about equal size over keys of any ordered type, and over tuples.

The key's distribution comes from a bottom-k sketch: every row has a hash as its
priority, and the rows of least priority are a uniform sample of the table. Each task
keeps its own least rows and these partial sketches merge into one, so the driver gets
at most ``SKETCH_ROWS`` keys whatever the table's size.

Cuts between ranges are tuples. A value of the first column that holds more than a
range's share is split by the columns after it; give a column that tells its rows
apart (a sequence, a second key part) as the last one.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.sources.jdbc import quoted

#: Rows of the sketch for each range, and at most. With 400 a range is off by about 5 % (one standard deviation).
ROWS_PER_RANGE, SKETCH_ROWS = 400, 200_000

Cut = tuple


def key_sketch(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """A uniform sample of the key tuples, as many as ``rows``, the same in every run over
    the same rows; equal rows are told apart by their whole content and place."""
    shown = [F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]
    plain = [F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t and "variant" not in t]
    priority = F.xxhash64(*plain, F.monotonically_increasing_id())
    return df.select(*shown, priority.alias("p")).orderBy("p").limit(rows).drop("p")


def split_points(df: DataFrame, keys: str | list[str], ranges: int) -> list[Cut]:
    """At most ``ranges - 1`` ascending cuts (nulls first) that leave about as many rows
    between any two. A table whose keys are all equal has none."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if ranges < 2:
        return []
    names = [f"k{i}" for i in range(len(keys))]
    rows = key_sketch(df, keys, min(ROWS_PER_RANGE * ranges, SKETCH_ROWS)).orderBy(*(F.col(n).asc_nulls_first() for n in names)).collect()
    cuts: list[Cut] = []
    for r in range(1, ranges):
        if not rows:
            break
        cut = tuple(rows[math.ceil(len(rows) * r / ranges) - 1 if len(rows) < ranges else len(rows) * r // ranges])
        if cut != tuple(rows[0]) and (not cuts or cut != cuts[-1]):
            cuts.append(cut)
    return cuts


def sql_literal(v) -> str:
    """A value as SQL that Spark and MySQL read alike."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, decimal.Decimal)):
        return str(v)
    if isinstance(v, float):
        if not math.isfinite(v):
            raise ValueError(f"no literal for {v}")
        return f"{v!r}E0" if "e" not in repr(v) else repr(v)
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"no literal for {type(v).__name__}")


def _from(keys: list[str], cut: Cut) -> str:
    """Rows at or after ``cut``; nulls come before all values."""
    k, a = quoted(keys[0]), cut[0]
    if len(keys) == 1:
        return "1 = 1" if a is None else f"{k} >= {sql_literal(a)}"
    rest = _from(keys[1:], cut[1:])
    if a is None:
        return f"({k} IS NOT NULL OR {rest})"
    return f"({k} > {sql_literal(a)} OR ({k} = {sql_literal(a)} AND {rest}))"


def _before(keys: list[str], cut: Cut) -> str:
    """Rows before ``cut``."""
    k, b = quoted(keys[0]), cut[0]
    if len(keys) == 1:
        return "1 = 0" if b is None else f"({k} < {sql_literal(b)} OR {k} IS NULL)"
    rest = _before(keys[1:], cut[1:])
    if b is None:
        return f"({k} IS NULL AND {rest})"
    return f"({k} < {sql_literal(b)} OR {k} IS NULL OR ({k} = {sql_literal(b)} AND {rest}))"


def split_predicates(keys: str | list[str], cuts: list[Cut]) -> list[str]:
    """One WHERE clause per range. Every row meets exactly one of them, rows with nulls among
    their keys too, and so do rows that arrive after the cuts were made.

    The source must order the keys as Spark does (binary for text): read a text key of
    a case-insensitive collation through its binary form.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not cuts:
        return ["1 = 1"]
    lower = [None, *(_from(keys, c) for c in cuts)]
    upper = [*(_before(keys, c) for c in cuts), None]
    return [" AND ".join(x for x in both if x) for both in zip(lower, upper, strict=True)]


def range_number(keys: str | list[str], cuts: list[Cut]) -> Column:
    """The number of the range a row is in, for one pass over a frame."""
    out = F.lit(0)
    for i, p in enumerate(split_predicates(keys, cuts)):
        out = F.when(F.expr(p), F.lit(i)).otherwise(out)
    return out
