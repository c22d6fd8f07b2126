"""Small table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """A1/A4 as a frame: one row, ``row_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def max_key(df: DataFrame, key: str) -> DataFrame:
    """A5."""
    return df.agg(F.max(key).alias("max_key"))


def dedup_by_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key. Planned as an aggregate (first row per key) with a
    map-side partial step, so a heavily repeated key does not pile up in one task."""
    return df.dropDuplicates([key] if isinstance(key, str) else key)


def is_empty(df: DataFrame) -> bool:
    """Stops at the first row."""
    return df.isEmpty()


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """L1: the first ``n`` rows in a stated total order (all columns unless given),
    so the preview is reproducible. Planned as a per-partition top-n."""
    return df.orderBy(*(order_by or df.columns)).limit(n)
