"""File sources (S9): recursive batch scan of landed change files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_recursive(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Every file below ``path`` at any depth, no partition inference from folder
    names. Without ``schema``, the files' schemas are merged: a column that only
    later files have is read, too."""
    r = spark.read.format(fmt).option("recursiveFileLookup", "true").option("mergeSchema", str(schema is None).lower())
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)
