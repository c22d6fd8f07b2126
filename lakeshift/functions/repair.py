"""Column repairs for values that do not survive the move out of MySQL.

Everything here returns a ``Column`` built from built-in functions, so the
repairs stay inside whole-stage codegen; ``repair_columns`` applies all of a
table's repairs in one ``withColumns`` projection.

Parsing uses the ``try_`` forms: with ANSI on (the Spark 4 default) the plain
parsers raise on bad text, while the jobs this replaces ran with ANSI off and
relied on null.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: these must equal the source system's conventions. ---------
# MySQL zero date and what it becomes; zero month/day parts and what they become.
ZERO_DATE = "0000-00-00"
ZERO_DATE_REPLACEMENT = "1900-01-01"
ZERO_DATE_PART = "-00"
ZERO_DATE_PART_REPLACEMENT = "-01"
# MySQL zero datetime and what it becomes; the only datetime text layout accepted.
ZERO_DATETIME = "0000-00-00 00:00:00"
ZERO_DATETIME_REPLACEMENT = "1970-01-01 00:00:00"
DATETIME_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
DATETIME_SHAPE_WITH_FRACTION = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?$"
# MySQL ``CAST(x AS DECIMAL)`` has precision 10, scale 0.
TINYINT_TRANSFER_TYPE = "decimal(10,0)"
# ------------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def repair_zero_date(c: str | Column) -> Column:
    """date text -> date. Zero date -> 1900-01-01, zero month/day -> 01,
    anything still invalid (e.g. Feb 30) -> null."""
    text = F.replace(
        F.replace(_col(c).cast("string"), F.lit(ZERO_DATE), F.lit(ZERO_DATE_REPLACEMENT)),
        F.lit(ZERO_DATE_PART),
        F.lit(ZERO_DATE_PART_REPLACEMENT),
    )
    return F.try_to_date(text)


def repair_zero_datetime(c: str | Column, *, keep_fraction: bool = False) -> Column:
    """datetime text -> timestamp_ntz (MySQL DATETIME has no zone).

    The zero datetime becomes 1970-01-01 00:00:00; text not exactly in
    ``yyyy-MM-dd HH:mm:ss`` (fractions, date only, zero month, Feb 30, hour 24)
    becomes null - the same results as a strict parse with that pattern.
    Implemented as a shape test plus one cast to NTZ: a single parse per value,
    no session time zone involved (so no daylight-saving shift), never raises.

    ``keep_fraction`` also accepts fractions of a second (``DATETIME(n)``
    columns); the migration uses it, so that no time value is lost.
    """
    text = F.replace(_col(c).cast("string"), F.lit(ZERO_DATETIME), F.lit(ZERO_DATETIME_REPLACEMENT))
    shape = DATETIME_SHAPE_WITH_FRACTION if keep_fraction else DATETIME_SHAPE
    return F.when(text.rlike(shape), text.try_cast("timestamp_ntz"))


def tinyint_to_int(c: str | Column) -> Column:
    """tinyint carried as decimal (or boolean) -> int."""
    return _col(c).cast("int")


def tinyint_transfer(c: str | Column) -> Column:
    """what ``CAST(c AS DECIMAL)`` hands over: decimal(10,0)."""
    return _col(c).cast(TINYINT_TRANSFER_TYPE)


def _zone_free(dtype: str) -> bool:
    """NTZ timestamps and dates render as text without any session time zone."""
    return dtype in ("timestamp_ntz", "date")


def time_text(c: str | Column, dtype: str = "timestamp_ntz") -> Column:
    """F6 for time columns: ``HH:mm:ss`` text with the fraction, if any (strings pass through)."""
    col = _col(c)
    return col if dtype == "string" else F.substring_index(col.cast("string"), " ", -1)


def datetime_text(c: str | Column, dtype: str = "timestamp_ntz") -> Column:
    """F6 for datetime columns: what ``CONVERT(c, CHAR)`` returns for a
    DATETIME: ``yyyy-MM-dd HH:mm:ss`` and the fraction of a second, if any. NTZ
    values are rendered by a string cast, which involves no time zone, so no
    wall-clock time moves across a daylight-saving gap; zone-aware timestamps
    use the session zone."""
    col = _col(c)
    return (col.cast("timestamp_ntz") if _zone_free(dtype) else col).cast("string")


def date_text(c: str | Column, dtype: str = "date") -> Column:
    """F6 for date columns: ``yyyy-MM-dd``."""
    return _col(c).cast("date").cast("string")


def change_timestamp(c: str | Column) -> Column:
    """change-time text (any layout a cast accepts) -> timestamp_ntz, bad text -> null."""
    return _col(c).try_cast("timestamp_ntz")


def run_timestamp(value: str | datetime) -> Column:
    """the run's timestamp as a literal; a parameter, never the executor clock."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def repair_columns(
    df: DataFrame,
    *,
    date_cols: list[str] = (),
    datetime_cols: list[str] = (),
    tinyint_cols: list[str] = (),
    keep_fraction: bool = False,
) -> DataFrame:
    """Apply F1/F2/F3 to the named columns in a single projection."""
    repairs = _repairs(date_cols, datetime_cols, tinyint_cols, keep_fraction)
    return df.withColumns(repairs) if repairs else df


def _repairs(date_cols, datetime_cols, tinyint_cols, keep_fraction=False) -> dict[str, Column]:
    repairs: dict[str, Column] = {}
    for c in datetime_cols:
        repairs[c] = repair_zero_datetime(c, keep_fraction=keep_fraction)
    for c in date_cols:
        repairs[c] = repair_zero_date(c)
    for c in tinyint_cols:
        repairs[c] = tinyint_to_int(c)
    return repairs


def repair_observed(
    df: DataFrame,
    observation,
    *,
    date_cols: list[str] = (),
    datetime_cols: list[str] = (),
    tinyint_cols: list[str] = (),
    keep_fraction: bool = False,
) -> DataFrame:
    """Repair and attach an ``Observation`` with ``rows`` and ``nulled`` counts.

    ``nulled`` counts values that were non-null before and null after repair.
    The metrics are gathered by whatever action runs next (normally the
    snapshot write), so the counts cost no second pass over the data.
    """
    repairs = _repairs(date_cols, datetime_cols, tinyint_cols, keep_fraction)
    if not repairs:
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("nulled"))
    raw = {f"__raw_{i}": F.col(c) for i, c in enumerate(repairs)}
    staged = df.withColumns(raw).withColumns(repairs)
    flags = [
        F.when(F.col(f"__raw_{i}").isNotNull() & F.col(c).isNull(), 1).otherwise(0)
        for i, c in enumerate(repairs)
    ]
    nulled = flags[0]
    for f in flags[1:]:
        nulled = nulled + f
    staged = staged.withColumn("__nulled", nulled)
    observed = staged.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("__nulled"), F.lit(0)).cast("bigint").alias("nulled"),
    )
    return observed.drop("__nulled", *raw)
