"""Change apply on tables with row-level operations (Delta, Iceberg).

When the target format supports ``MERGE INTO``, the change batch is applied in
place instead of writing a new snapshot. Same semantics as the DataFrame
operators in :mod:`lakeshift.operators.cdc`:

* ``merge_changes`` - J3: one upsert MERGE, then one delete MERGE.
* ``merge_latest``  - J4: the batch reduced to the last change per key, then a
  single MERGE that deletes, updates or inserts.

Both reduce the batch once, into a staged copy that all statements read. Rows
without a full key match nothing by key: a statement of their own compares whole
rows null-safely and inserts what is not there, so that none is lost and a
replayed batch adds none.

Column lists are spelled out (no ``SET *``) so the feed's op column never
reaches the table. Neither format's jar is in this environment: the SQL text is
unit-tested, execution is not (see README).
"""

from __future__ import annotations

import uuid
from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.functions.ddl import quote_ident as q
from lakeshift.operators.cdc import METADATA_COLUMNS, OP_COLUMN, OP_DELETE, batch_per_key, reduced_changes, require_unique
from lakeshift.session import hadoop_fs, new_work_dir

ROW_LEVEL_PROVIDERS = ("delta", "iceberg")


def table_provider(spark: SparkSession, name: str) -> str | None:
    """The table's data source (``parquet``, ``delta``, ``iceberg``...), from catalog metadata."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if (r[0] or "").strip().lower() == "provider":
            return (r[1] or "").strip().lower()
    return None


def _on(key: list[str]) -> str:
    return " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in key)


def upsert_merge_sql(table: str, source: str, key: list[str], cols: list[str]) -> str:
    sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in cols if c not in key)
    ins_cols = ", ".join(q(c) for c in cols)
    ins_vals = ", ".join(f"s.{q(c)}" for c in cols)
    return (
        f"MERGE INTO {table} t USING {source} s ON {_on(key)} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})"
    )


def delete_merge_sql(table: str, source: str, key: list[str]) -> str:
    return f"MERGE INTO {table} t USING {source} s ON {_on(key)} WHEN MATCHED THEN DELETE"


def latest_merge_sql(table: str, source: str, key: list[str], cols: list[str], op_col: str = OP_COLUMN) -> str:
    op = f"s.{q(op_col)}"
    sets = ", ".join(f"{q(c)} = s.{q(c)}" for c in cols if c not in key)
    ins_cols = ", ".join(q(c) for c in cols)
    ins_vals = ", ".join(f"s.{q(c)}" for c in cols)
    return (
        f"MERGE INTO {table} t USING {source} s ON {_on(key)} "
        f"WHEN MATCHED AND {op} = '{OP_DELETE}' THEN DELETE "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED AND {op} <> '{OP_DELETE}' THEN INSERT ({ins_cols}) VALUES ({ins_vals})"
    )


def insert_new_sql(table: str, source: str, key: list[str], cols: list[str]) -> str:
    """Insert rows without a full key unless the table holds them already."""
    same = " AND ".join(f"t.{q(c)} <=> s.{q(c)}" for c in cols)
    without = " OR ".join(f"t.{q(k)} IS NULL" for k in key)
    names = ", ".join(q(c) for c in cols)
    values = ", ".join(f"s.{q(c)}" for c in cols)
    return f"MERGE INTO {table} t USING {source} s ON ({without}) AND {same} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"


def latest_sources(feed: DataFrame, key: list[str], order_by: Iterable[str | Column], cols: list[str], op_col: str = OP_COLUMN) -> DataFrame:
    """What the J4 statements read: ``cols`` and the op of the last change per key
    (``__keyed``), and of each distinct upsert without a full key (not ``__keyed``)."""
    last = reduced_changes(feed, key, order_by, cols, op_col=op_col)
    shown = [(F.col(c) if c in key else F.col("__last")[c]).alias(c) for c in [*cols, op_col]]
    return last.select(*shown, F.col("__content").isNull().alias("__keyed"))


def change_sources(feed: DataFrame, key: list[str], cols: list[str], op_col: str = OP_COLUMN, drop_cols: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """What the J3 statements read: per key its row and how many upserts and deletes it
    has; the distinct upserts without a full key are not ``__keyed``."""
    per_key = batch_per_key(feed, key, cols, op_col=op_col, drop_cols=drop_cols)
    shown = [(F.col(c) if c in key else F.col("__row")[c]).alias(c) for c in cols]
    return per_key.select(*shown, "__ups", "__dels", "__content", F.col("__content").isNull().alias("__keyed"))


def _staged_sources(df: DataFrame) -> tuple[DataFrame, str]:
    path = new_work_dir(df.sparkSession, "merge-batch")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _run(spark: SparkSession, rows: DataFrame, statement) -> None:
    """One statement over ``rows`` as a view; none if there are no rows (the staged copy tells)."""
    if rows.isEmpty():
        return
    view = f"changes_{uuid.uuid4().hex[:8]}"
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(statement(view))
    finally:
        spark.catalog.dropTempView(view)


def _require_row_level(spark: SparkSession, table: str) -> None:
    p = table_provider(spark, table)
    if p not in ROW_LEVEL_PROVIDERS:
        raise ValueError(f"{table} is a {p} table; use the snapshot path (operators.cdc + VersionedTable)")


def merge_changes(
    spark: SparkSession,
    table: str,
    feed: DataFrame,
    key: str | Iterable[str],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
) -> None:
    """J3 in place: upsert MERGE, delete MERGE, insert of rows without a key (each skipped when it has no rows)."""
    _require_row_level(spark, table)
    key = [key] if isinstance(key, str) else list(key)
    cols = spark.table(table).columns
    rows, path = _staged_sources(change_sources(feed, key, cols, op_col, drop_cols))
    require_unique(rows, key)
    keyed = rows.filter("__keyed")
    _run(spark, keyed.filter("__ups = 1").select(*cols), lambda v: upsert_merge_sql(table, v, key, cols))
    _run(spark, keyed.filter("__dels > 0").select(*key), lambda v: delete_merge_sql(table, v, key))
    _run(spark, rows.filter("NOT __keyed").select(*cols), lambda v: insert_new_sql(table, v, key, cols))
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def merge_latest(
    spark: SparkSession,
    table: str,
    feed: DataFrame,
    key: str | Iterable[str],
    order_by: Iterable[str | Column],
    *,
    op_col: str = OP_COLUMN,
) -> None:
    """J4 in place: one MERGE of the last change per key, and an insert of new rows without a key."""
    _require_row_level(spark, table)
    key = [key] if isinstance(key, str) else list(key)
    cols = spark.table(table).columns
    rows, path = _staged_sources(latest_sources(feed, key, order_by, cols, op_col))
    _run(spark, rows.filter("__keyed").select(*cols, op_col), lambda v: latest_merge_sql(table, v, key, cols, op_col))
    _run(spark, rows.filter("NOT __keyed").select(*cols), lambda v: insert_new_sql(table, v, key, cols))
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)
