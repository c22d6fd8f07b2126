"""Incremental intake of landed files (ST1) and per-batch change apply (ST2).

A file-source stream with a checkpoint replaces the job bookmark: each run with
``trigger(availableNow=True)`` takes exactly the files that landed since the
last run, then stops. Sinks are written so a replayed micro-batch (possible
after a failure between the data write and the checkpoint commit) does not
change the result.
"""

from __future__ import annotations

import hashlib
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession

from lakeshift.operators.cdc import METADATA_COLUMNS, OP_COLUMN, apply_changes, apply_latest, op_counts
from lakeshift.session import hadoop_fs, path_exists, touch
from lakeshift.sinks.buckets import BucketedTable
from lakeshift.sinks.merge import merge_changes, merge_latest
from lakeshift.sinks.snapshot import VersionedTable


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Streaming read of the files under ``path`` (a folder or glob; with
    ``recursive`` also every sub-folder)."""
    r = spark.readStream.format(fmt).schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def run_available(writer) -> None:
    """Start a stream writer with availableNow, wait for it to drain and stop."""
    q = writer.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_available(
    spark: SparkSession,
    source: str,
    schema,
    sink: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    batch_column: str | None = "intake_batch",
    max_files_per_trigger: int | None = None,
) -> None:
    """ST1: copy every not-yet-seen file's rows to ``sink``.

    With ``batch_column`` each micro-batch lands in ``sink/<batch_column>=<id>``
    (overwritten on replay, so idempotent) and the id is readable as a column;
    without it the exactly-once parquet file sink is used.
    """
    stream = file_stream(spark, source, schema, fmt, max_files_per_trigger=max_files_per_trigger)
    if batch_column is None:
        writer = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    else:

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{sink}/{batch_column}={batch_id}")

        writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    run_available(writer)


def cdc_batch_applier(
    table: VersionedTable | BucketedTable,
    key: str | Iterable[str],
    order_by: Iterable[str | Column] | None = None,
    *,
    stream_id: str,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    on_batch: Callable[[int, dict], None] | None = None,
    keep_versions: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """ST2: a ``foreachBatch`` function applying each batch to ``table``.

    With ``order_by`` the batch is applied with J4 (last change per key wins);
    without, with J3 (all upserts, then all deletes - the source jobs' order). A
    ``VersionedTable`` is written whole per batch, of a ``BucketedTable`` only the
    buckets that the batch touches.

    Each applied batch leaves a marker ``<table root>/_applied/<stream_id>/<batch_id>``
    written after the new version is committed; a replayed batch with a marker
    is skipped. A crash between commit and marker re-applies the batch on top
    of its own result, which both J3 and J4 leave unchanged (apply is idempotent).
    Versions older than the newest ``keep_versions`` are removed after each
    batch (None, the default, keeps all); readers of the current one are not affected.
    ``on_batch`` receives the batch id, its per-op row counts and the table's
    row count after the apply.
    """
    order_by = list(order_by) if order_by is not None else None

    def apply(batch: DataFrame, batch_id: int) -> None:
        marker = f"{table.root}/_applied/{stream_id}/{batch_id:012d}"
        if path_exists(table.spark, marker):
            return
        feed = prepare(batch) if prepare else batch
        cur = table.current_version()
        stage = f"{table.root}/_staging/{stream_id}/{batch_id:012d}"
        if isinstance(table, BucketedTable):
            done = table.apply(feed, order_by, op_col=op_col, drop_cols=drop_cols, stage_dir=stage)
            touch(table.spark, marker)
            if keep_versions is not None:
                table.vacuum(keep_versions)
            if on_batch is not None:
                counts = {r["Op"]: r["n"] for r in op_counts(batch, op_col).collect()}
                on_batch(batch_id, {**done, "ops": counts, "rows_after": table.read().count()})
            return
        current = table.read()
        if order_by is None:
            new = apply_changes(current, feed, key, op_col=op_col, drop_cols=drop_cols, stage_dir=stage)
        else:
            new = apply_latest(current, feed, key, order_by, op_col=op_col, drop_cols=drop_cols, stage_dir=stage)
        table.commit(new, cur + 1)
        touch(table.spark, marker)
        fs, p = hadoop_fs(table.spark, stage)
        fs.delete(p, True)  # the new version no longer needs the staged changes
        if keep_versions is not None:
            table.vacuum(keep_versions)
        if on_batch is not None:
            counts = {r["Op"]: r["n"] for r in op_counts(batch, op_col).collect()}
            rows_after = table.read().count()  # parquet: answered from file footers
            on_batch(batch_id, {"version": cur + 1, "ops": counts, "rows_after": rows_after})

    return apply


def merge_batch_applier(
    spark: SparkSession,
    table: str,
    key: str | Iterable[str],
    order_by: Iterable[str | Column] | None = None,
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    on_batch: Callable[[int, dict], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """ST2 for tables with row-level writes: each batch is one or two MERGE
    statements, which rewrite only the files that hold changed keys. A replayed
    batch changes nothing."""
    order_by = list(order_by) if order_by is not None else None

    def apply(batch: DataFrame, batch_id: int) -> None:
        feed = prepare(batch) if prepare else batch
        if order_by is None:
            merge_changes(spark, table, feed, key, op_col=op_col, drop_cols=drop_cols)
        else:
            merge_latest(spark, table, feed, key, order_by, op_col=op_col)
        if on_batch is not None:
            on_batch(batch_id, {"ops": {r["Op"]: r["n"] for r in op_counts(batch, op_col).collect()}})

    return apply


def stream_id_for(checkpoint: str) -> str:
    return hashlib.sha1(checkpoint.encode()).hexdigest()[:16]


def apply_available(
    spark: SparkSession,
    source: str,
    schema,
    table: VersionedTable | BucketedTable | str,
    key: str | Iterable[str],
    order_by: Iterable[str | Column] | None,
    checkpoint: str,
    *,
    recursive: bool = False,
    max_files_per_trigger: int | None = None,
    **kw,
) -> None:
    """ST2: apply every newly landed change file to ``table``, batch by batch: a
    snapshot table, a bucketed one, or the name of a table with row-level writes.

    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog
    (first run, or after an outage) is applied as several bounded batches in
    landing order instead of one huge one.
    """
    stream = file_stream(spark, source, schema, recursive=recursive, max_files_per_trigger=max_files_per_trigger)
    if isinstance(table, str):
        applier = merge_batch_applier(spark, table, key, order_by, **kw)
    else:
        applier = cdc_batch_applier(table, key, order_by, stream_id=stream_id_for(checkpoint), **kw)
    writer = stream.writeStream.foreachBatch(applier).option("checkpointLocation", checkpoint)
    run_available(writer)
