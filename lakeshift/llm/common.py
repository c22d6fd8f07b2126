"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import io
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.session import hadoop_fs, new_work_dir

#: Rows a Python task handles at a time, so that a task's memory does not follow the Arrow batch size.
SLICE_ROWS = 256
SLICE_BYTES = 4 << 20

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever they start: the
    driver hands it to executors as a zip (once per application)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    buf, digest = io.BytesIO(), hashlib.sha256()
    with zipfile.ZipFile(buf, "w") as z:
        for folder, _, names in sorted(os.walk(os.path.join(root, "lakeshift"))):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    data = open(p, "rb").read()
                    digest.update(data)
                    z.writestr(os.path.relpath(p, root), data)
    path = os.path.join(tempfile.mkdtemp(prefix="lakeshift-zip-"), f"lakeshift-{digest.hexdigest()[:12]}.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def ship_file(spark: SparkSession, path: str) -> str:
    """Hand a file of the driver to the executors; tasks open it by ``shipped_file`` of the name returned."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def shipped_file(name: str) -> str:
    from pyspark import SparkFiles

    return SparkFiles.get(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, under fixed names; null text is empty.
    Other columns are dropped, so their names cannot clash with results."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES) -> Iterator[dict[str, list]]:
    """Arrow batches as small column dicts of Python values: at most ``rows`` rows, and
    at most ``size`` bytes of any text column (one row may be longer)."""
    for b in batches:
        pieces = iter([b])
        for f in b.schema:
            if pa.types.is_string(f.type) or pa.types.is_large_string(f.type):
                pieces = by_bytes(pieces, f.name, size)
        for p in pieces:
            for at in range(0, p.num_rows, rows):
                yield p.slice(at, rows).to_pydict()


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds at most ``most`` bytes a piece (one row may be longer)."""
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield b.slice(at, i - at)
                at, held = i, 0
            held += int(n)
        yield b.slice(at)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: later steps start
    from files every executor can reach, not from recomputed lineage."""
    spark = df.sparkSession
    path = new_work_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(*frames: DataFrame) -> None:
    """Remove what ``staged`` wrote for these frames, once nothing reads it any more."""
    for df in frames:
        fs, p = hadoop_fs(df.sparkSession, df._staged_at)
        fs.delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps now: it does so once nothing in the
    driver refers to their plans, which otherwise waits for its next collection. Python's
    references go first (they reach the JVM a moment later); the last query's plan is let go
    by the next one, so a query without work follows."""
    gc.collect()
    time.sleep(0.5)
    spark.range(1).count()
    gc.collect()
    time.sleep(0.5)
    spark.sparkContext._jvm.System.gc()
    time.sleep(0.5)


def give_back() -> None:
    """Memory that this worker has freed goes back to the system. Spark keeps workers for later
    tasks, and what one holds from a large block counts while other steps run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def frugal(work: Callable) -> Callable:
    """``work`` on a group's table, or two tables of a cogroup, that gives back its memory after each group."""

    def one(table: pa.Table) -> pa.Table:
        try:
            return work(table)
        finally:
            give_back()

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return work(left, right)
        finally:
            give_back()

    return one if work.__code__.co_argcount == 1 else two


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
