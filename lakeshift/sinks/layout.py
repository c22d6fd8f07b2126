"""K4/M3: files of a target size, with rows that belong together in several columns.

The size of a file is planned from encoded bytes of a sample, not from a guess, and compared
with what was written: rows that lie together can take less room than the sample's. Rows are
clustered along a space-filling order of the columns' quantiles, so that a range of any
one of them lies in few files.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.session import hadoop_fs, new_work_dir

#: Rows whose encoded size is measured, and bits of each column's quantile in the order.
SAMPLE_ROWS, ORDER_BITS = 100_000, 8
#: Files are written again, in a number that follows from their size, if that number is off by this factor.
OFF = 1.8


def _bytes(spark, path: str) -> int:
    fs, p = hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def encoded_row_bytes(df: DataFrame, rows: int, sample_rows: int = SAMPLE_ROWS) -> float:
    """Bytes a row takes in parquet, measured on about ``sample_rows`` rows spread over the table
    and written as one file, as the table's files will be. All tasks take the sample; one gets only its rows."""
    spark = df.sparkSession
    path = new_work_dir(spark, "size-sample")
    share = min(1.0, sample_rows / max(rows, 1))
    some = df if share == 1.0 else df.sample(False, share, seed=11)
    try:
        some.repartition(1).write.parquet(path)
        n = spark.read.parquet(path).count()
        return _bytes(spark, path) / max(n, 1)
    finally:
        fs, p = hadoop_fs(spark, path)
        fs.delete(p, True)


def files_within(df: DataFrame, most_bytes: int, least: int = 1) -> int:
    """How many files ``df`` needs so that none is much larger than ``most_bytes``, and at least ``least``."""
    rows = df.count()
    return max(least, math.ceil(rows * encoded_row_bytes(df, rows) / most_bytes))


def with_place(df: DataFrame, columns: list[str], bits: int = ORDER_BITS) -> DataFrame:
    """``df`` plus ``__place``, where a row lies along a curve through the columns' quantiles:
    their bits, taken in turn, highest first. Nulls come first in their column. Columns:
    numbers, dates or times."""
    kinds = dict(df.dtypes)

    def number(c: str) -> Column:
        col = F.col(f"`{c}`")
        if kinds[c] == "date":
            return F.unix_date(col).cast("double")
        if kinds[c].startswith("timestamp"):
            return F.unix_micros(col.cast("timestamp")).cast("double")
        return col.cast("double")

    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    got = df.agg(*(F.percentile_approx(number(c), shares, 20_000).alias(f"q{i}") for i, c in enumerate(columns))).first()
    cuts = [sorted(set(got[f"q{i}"] or [])) for i in range(len(columns))]
    values = {f"__v{i}": number(c) for i, c in enumerate(columns)}
    steps = {f"__h{i}": _at_or_below(cuts[i][::STEP], F.col(f"__v{i}")) for i in range(len(columns))}
    ranks = {f"__r{i}": _rank(cuts[i], F.col(f"__v{i}"), F.col(f"__h{i}")) for i in range(len(columns))}
    place = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for r in ranks:
            place = place * 2 + F.shiftright(F.col(r), b).bitwiseAND(F.lit(1))
    # each step is a column of its own, as the next uses it several times
    out = df.withColumns(values).withColumns(steps).withColumns(ranks).withColumn("__place", place)
    return out.drop(*values, *steps, *ranks)


#: Cuts passed over at a time when a value is looked up among them.
STEP = 16


def _at_or_below(cuts: list[float], value: Column) -> Column:
    """How many of the cuts are at or below the value (none for a null)."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= value)), F.lit(0))


def _rank(cuts: list[float], value: Column, steps: Column) -> Column:
    """The same over all cuts, given how many of each ``STEP``-th are at or below the value."""
    if not cuts:
        return F.lit(0)
    groups = F.array(*(F.array(*map(F.lit, cuts[at : at + STEP])) for at in range(0, len(cuts), STEP)))
    inside = F.size(F.filter(F.element_at(groups, steps), lambda c: c <= value))
    return F.when(steps == 0, F.lit(0)).otherwise((steps - 1) * STEP + inside)


def write_clustered(df: DataFrame, path: str, columns: list[str], target_bytes: int) -> int:
    """Write ``df`` in files of about ``target_bytes``, clustered on ``columns``; returns how many were planned."""
    spark = df.sparkSession
    files = files_within(df, target_bytes)
    placed = with_place(df, columns)
    # rows of one place are told apart by their content, so that no range is larger than a file
    tie = F.xxhash64(*(F.col(f"`{c}`") for c, t in df.dtypes if "map<" not in t))

    def write(files: int) -> None:
        placed.repartitionByRange(files, "__place", tie).sortWithinPartitions("__place").drop("__place").write.mode("overwrite").parquet(path)

    write(files)
    needed = max(1, math.ceil(_bytes(spark, path) / target_bytes))
    if not 1 / OFF <= needed / files <= OFF:
        files = needed
        write(files)
    return files
