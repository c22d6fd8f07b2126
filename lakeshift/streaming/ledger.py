"""ST1: intake by a ledger of landed files, for sources that rewrite files or land them late.

A file stream's bookmark knows a file by its name alone. The ledger knows name, size and
time: a file whose size or time has changed is taken in again, and replaces what its
earlier form brought. The listing is a scan of file metadata on the executors; with
``lateness`` it keeps only files at most that much older than the newest one taken, so
that neither the listing nor the ledger it is compared with follows all history.

Layout: ``<sink>/data/intake_batch=<n>`` holds the rows with ``source_file``, and
``<sink>/ledger/intake_batch=<n>``, written after them, the files. A batch without its
ledger part is taken in again under the same number.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeshift.session import hadoop_fs, list_dirs, path_exists
from lakeshift.sinks.snapshot import SUCCESS_MARKER

BATCH, FILE = "intake_batch", "source_file"
_LEDGER = "source_file string, size bigint, time timestamp"


def _done(spark: SparkSession, sink: str) -> list[int]:
    names = (n for n in list_dirs(spark, f"{sink}/ledger") if n.startswith(f"{BATCH}="))
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{sink}/ledger/{n}/{SUCCESS_MARKER}"))


def taken(spark: SparkSession, sink: str) -> DataFrame:
    """The ledger: every form of every file, with the batch that took it in."""
    done = _done(spark, sink)
    if not done:
        return spark.createDataFrame([], f"{_LEDGER}, {BATCH} int")
    parts = [f"{sink}/ledger/{BATCH}={n}" for n in done]
    return spark.read.schema(f"{_LEDGER}, {BATCH} int").option("basePath", f"{sink}/ledger").parquet(*parts)


def landed(spark: SparkSession, source: str, newer_than: dt.datetime | None = None) -> DataFrame:
    """Name, size and time of the files under ``source``; their content is not read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if newer_than is not None:
        r = r.option("modifiedAfter", newer_than.strftime("%Y-%m-%dT%H:%M:%S"))
    m = F.col("_metadata")
    return r.load(source).select(m.file_path.alias(FILE), m.file_size.alias("size"), m.file_modification_time.alias("time"))


def take_in(spark: SparkSession, source: str, schema: StructType, sink: str, *, lateness: dt.timedelta | None = None, fmt: str = "parquet") -> int | None:
    """Take in what is new, rewritten or late under ``source``; the batch's number, or None if there is nothing."""
    done = _done(spark, sink)
    known, newest = taken(spark, sink), None
    if lateness is not None and done:
        newest = known.agg(F.max("time")).first()[0] - lateness
        known = known.filter(F.col("time") >= F.lit(newest))
    batch = done[-1] + 1 if done else 0
    new = landed(spark, source, newest).join(known.drop(BATCH), [FILE, "size", "time"], "left_anti")
    files = [tuple(r) for r in new.collect()]  # the files of one batch
    if not files:
        return None
    rows = spark.read.format(fmt).schema(schema).load([f for f, _, _ in files]).withColumn(FILE, F.col("_metadata.file_path"))
    rows.write.mode("overwrite").parquet(f"{sink}/data/{BATCH}={batch}")
    spark.createDataFrame(files, _LEDGER).write.mode("overwrite").parquet(f"{sink}/ledger/{BATCH}={batch}")
    return batch


def current(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """The rows of each file as it was taken in last, with ``source_file`` and the batch."""
    done = _done(spark, sink)
    whole = StructType([*schema.fields, StructField(FILE, StringType())])
    if not done:
        return spark.createDataFrame([], whole).withColumn(BATCH, F.lit(None).cast("int"))
    last = taken(spark, sink).groupBy(FILE).agg(F.max(BATCH).alias(BATCH))
    rows = spark.read.schema(StructType([*whole.fields, StructField(BATCH, IntegerType())])).option("basePath", f"{sink}/data").parquet(*(f"{sink}/data/{BATCH}={n}" for n in done))
    return rows.join(last, [FILE, BATCH], "left_semi")


def set_file_time(spark: SparkSession, path: str, time: dt.datetime) -> None:
    """Give a file an earlier time, as a copy that keeps times does."""
    fs, p = hadoop_fs(spark, path)
    fs.setTimes(p, int(time.timestamp() * 1000), -1)
