"""Migration jobs (M1, M2, M4, M5).

``migrate_tables`` runs one Spark job per table: read (typed projection at the
source), repair, write a snapshot, register it. Each table is isolated - a
failure becomes a status row, not an aborted run - and several tables can run
at once from a small driver thread pool so small tables do not leave the
cluster idle. Row and repair counts come from an ``Observation`` on the write
itself: no second scan.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.proof import Proof, differing_columns, observe_proof, observed_proof, proof_of
from lakeshift.functions.repair import repair_observed
from lakeshift.operators.cdc import drop_metadata, stamp_changes
from lakeshift.operators.projection import repairs_needed
from lakeshift.sinks.snapshot import create_partitioned_table, refresh_table
from lakeshift.sources.catalog import ColumnClasses

STATUS_SCHEMA = "database string, table_name string, status string, rows_written bigint, values_nulled bigint, error string"

Reader = Callable[[str, str, ColumnClasses], DataFrame]


@dataclass
class TableStatus:
    database: str
    table_name: str
    status: str
    rows_written: int | None
    values_nulled: int | None
    error: str | None

    def row(self) -> tuple:
        return (self.database, self.table_name, self.status, self.rows_written, self.values_nulled, self.error)


def migrate_table(
    spark: SparkSession,
    database: str,
    table: str,
    classes: ColumnClasses,
    reader: Reader,
    target_root: str,
    *,
    target_database: str | None = None,
    num_files: int | None = None,
    rebalance: bool = False,
    merge_schema: bool = True,
    skip_empty: bool = False,
    keep_fraction: bool = True,
    prove: bool = False,
    attempts: int = 2,
) -> TableStatus:
    """M4: one table end to end; never raises, reports instead (M2).

    ``prove`` hashes every column as it is read, in the pass that writes it, and then the
    columns of what was written: a column whose values differ fails the table by name
    (one more scan, of the target). Repaired columns are hashed as repaired.
    A table that fails is tried ``attempts`` times in all; each try writes the version
    anew. The error reported names that of every try.

    ``rebalance`` inserts a REBALANCE right after the read, for sources whose
    partitions are known to be uneven (a non-unique or badly skewed key read in
    equal-width ranges): AQE then splits the big ones and merges the small ones.
    It shuffles the table, so it is off by default; balanced key ranges and file
    scans are even already.
    ``num_files`` instead forces an exact partition (file) count.
    ``merge_schema`` (default, as the source jobs' overwrite) keeps columns that
    the source no longer has, as nulls, instead of dropping them.
    ``skip_empty`` leaves an empty source table unwritten and unregistered
    (status ``empty``), as the source jobs did; by default an empty snapshot is
    written so the table and its schema exist downstream.
    ``keep_fraction`` (default) keeps fractions of a second; without it, a
    datetime with one becomes null and is counted, as in the source jobs.
    """
    errors: list[str] = []
    for _ in range(max(1, attempts)):
        try:
            df = reader(database, table, classes)
            if skip_empty and df.isEmpty():
                return TableStatus(database, table, "empty", 0, 0, None)
            if num_files:
                df = df.repartition(num_files)
            elif rebalance:
                df = df.hint("rebalance")
            tag = f"{database}_{table}_{uuid.uuid4().hex[:8]}"
            obs, proof = Observation(f"migrate_{tag}"), Observation(f"proof_{tag}")
            repaired = repair_observed(df, obs, **repairs_needed(df, classes), keep_fraction=keep_fraction)
            columns = repaired.columns
            if prove:
                repaired = observe_proof(repaired, proof)
            name = refresh_table(spark, repaired, f"{target_root}/{database}/{table}", target_database or database, table,
                                 merge_schema=merge_schema)
            m = obs.get
            if prove:
                wrong = unproven_columns(spark.table(name), observed_proof(proof, columns))
                if wrong:
                    raise ValueError(f"values written differ from those read in columns {', '.join(wrong)}")
            return TableStatus(database, table, "ok", int(m["rows"]), int(m["nulled"]), None)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            text = f"{type(e).__name__}: {e}"
            if text not in errors:
                errors.append(text)
    return TableStatus(database, table, "failed", None, None, "; then ".join(errors))


def unproven_columns(written: DataFrame, proof: Proof) -> list[str]:
    """Columns of a written table that do not hold the values of ``proof``."""
    return differing_columns(proof, proof_of(written, [c for c in proof if c in written.columns]))


def migrate_tables(
    spark: SparkSession,
    tables: list[tuple[str, str]],
    classes: dict[tuple[str, str], ColumnClasses],
    reader: Reader,
    target_root: str,
    *,
    target_database: str | None = None,
    parallel_tables: int = 4,
    num_files: int | None = None,
    rebalance: bool = False,
    skip_empty: bool = False,
    keep_fraction: bool = True,
    prove: bool = False,
) -> DataFrame:
    """M1 + M2: migrate every listed table; returns one status row per table.

    A table missing from the catalogue fails alone with a clear message, and so
    do tables of several databases that would become one table of
    ``target_database``: the second would replace the first.
    """
    clash = {t for t in {t for _, t in tables} if target_database and len({d for d, n in tables if n == t}) > 1}

    def one(dt: tuple[str, str]) -> TableStatus:
        db, tb = dt
        cls = classes.get((db, tb))
        if tb in clash:
            return TableStatus(db, tb, "failed", None, None, f"several source databases have a table {tb} for {target_database}.{tb}")
        if cls is None:
            return TableStatus(db, tb, "failed", None, None, f"no catalogue entry for {db}.{tb}")
        return migrate_table(
            spark, db, tb, cls, reader, target_root,
            target_database=target_database, num_files=num_files, rebalance=rebalance, skip_empty=skip_empty,
            keep_fraction=keep_fraction, prove=prove,
        )

    # inheritable_thread_target carries the caller's job group, scheduler pool
    # and other local properties into the pool threads (so cancelling or
    # accounting for the migration covers every per-table job)
    with ThreadPoolExecutor(max_workers=max(1, parallel_tables)) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(one), tables))
    return spark.createDataFrame([r.row() for r in results], STATUS_SCHEMA)


def full_load(
    spark: SparkSession,
    raw: DataFrame,
    database: str,
    table: str,
    partition_by: list[str],
    run_ts,
    *,
    location: str | None = None,
) -> bool:
    """M5: drop feed metadata, parse change time, stamp run time, create the
    partitioned table if it is absent. Returns True when it was created."""
    prepared = stamp_changes(drop_metadata(raw), run_ts)
    return create_partitioned_table(spark, prepared, database, table, partition_by, location=location)


def status_summary(status: DataFrame) -> DataFrame:
    """The error count the source jobs printed, as a one-row frame."""
    return status.agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).alias("failed"),
    )
