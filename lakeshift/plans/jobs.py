"""Runnable jobs with the source jobs' parameters (M1, M5, ST2, K13).

Each job is a function taking a SparkSession plus keyword arguments, and the
module has a command line (``python -m lakeshift.plans.jobs <job> --help``).
JDBC settings always come from arguments or the environment of the caller,
never from code.

* ``full-load``  raw landed files -> keyed, partitioned table (version 0)
* ``cdc``        newly landed change files -> applied batch by batch
* ``migrate``    table list + column catalogue + JDBC source -> snapshots + status
* ``marts``      the four marts, refreshed in order
* ``daily``      catalogue extract -> migrate -> marts (marts only if every table migrated)
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeshift.operators.cdc import METADATA_COLUMNS, drop_metadata, stamp_changes
from lakeshift.plans import marts as M
from lakeshift.plans.migrate import Reader, migrate_tables, status_summary
from lakeshift.sinks.buckets import BucketedTable
from lakeshift.sinks.merge import ROW_LEVEL_PROVIDERS, table_provider
from lakeshift.sinks.snapshot import VersionedTable, export_single_file, table_exists, table_report
from lakeshift.sources.catalog import column_classes, read_column_catalog, read_table_list
from lakeshift.sources.files import read_recursive
from lakeshift.sources.jdbc import JdbcSource, read_table_typed
from lakeshift.streaming.ingest import apply_available


# --- Fixed values: the marts' business day is the calendar day in Seoul. -------
MART_TIME_ZONE = "Asia/Seoul"
# ------------------------------------------------------------------------------


def business_midnight(now: datetime | None = None, tz: str = MART_TIME_ZONE) -> str:
    """Midnight of the current day in the marts' time zone, as text (the mart
    refresh parameter)."""
    from zoneinfo import ZoneInfo

    now = now.astimezone(ZoneInfo(tz)) if now else datetime.now(ZoneInfo(tz))
    return now.strftime("%Y-%m-%d 00:00:00")


class TableMissing(RuntimeError):
    """The change target has not been loaded yet."""


def _now() -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def keyed_table(
    spark: SparkSession,
    warehouse: str,
    database: str,
    table_name: str,
    partition_key: str | None,
    primary_key: str | None = None,
    buckets: int | None = None,
    touched_buckets: int | None = None,
) -> VersionedTable | BucketedTable:
    """The keyed table's snapshot store; with ``buckets`` bucketed by the primary
    key, so change batches too big to broadcast never shuffle the table; with
    ``touched_buckets`` of so many buckets, of which a batch rewrites those it touches."""
    if touched_buckets:
        if not primary_key or partition_key or buckets:
            raise ValueError("a table of touched buckets needs a primary key, and is neither partitioned nor bucketed otherwise")
        return BucketedTable(spark, f"{warehouse.rstrip('/')}/{database}/{table_name}", database, table_name, primary_key, touched_buckets)
    return VersionedTable(
        spark, f"{warehouse.rstrip('/')}/{database}/{table_name}", database, table_name,
        partition_by=[partition_key] if partition_key else None,
        bucket_by=[primary_key] if buckets and primary_key else None,
        buckets=buckets if buckets and primary_key else None,
    )


def _landed_schema(spark: SparkSession, raw_path: str):
    """Schema of the landed files (footers only); None while nothing has landed."""
    from pyspark.errors import AnalysisException

    from lakeshift.session import path_exists

    if not path_exists(spark, raw_path):
        return None
    try:
        return read_recursive(spark, raw_path).schema
    except AnalysisException:  # folder exists but holds no data files yet
        return None


def full_load_job(
    spark: SparkSession,
    *,
    raw_path: str,
    warehouse: str,
    database: str,
    table_name: str,
    partition_key: str | None = None,
    run_ts: str | None = None,
    primary_key: str | None = None,
    buckets: int | None = None,
    touched_buckets: int | None = None,
) -> dict:
    """M5: create the table from the full-load files unless it exists already."""
    t = keyed_table(spark, warehouse, database, table_name, partition_key, primary_key, buckets, touched_buckets)
    if t.current_version() is not None:
        return {"status": "exists", "table": t.name()}
    schema = _landed_schema(spark, raw_path)
    raw = read_recursive(spark, raw_path, schema=schema) if schema is not None else None
    if raw is None or raw.isEmpty():
        return {"status": "no data", "table": t.name()}
    rows = stamp_changes(drop_metadata(raw), run_ts or _now())
    if isinstance(t, BucketedTable):
        t.create(rows)
    else:
        t.commit(rows, 0)
    return {"status": "created", "version": 0, **table_report(spark, t.name())}


def cdc_job(
    spark: SparkSession,
    *,
    raw_path: str,
    warehouse: str,
    database: str,
    table_name: str,
    primary_key: str,
    partition_key: str | None = None,
    checkpoint: str | None = None,
    order_by: list[str] | None = None,
    run_ts: str | None = None,
    max_files_per_trigger: int | None = None,
    buckets: int | None = None,
    touched_buckets: int | None = None,
    keep_versions: int = 3,
) -> list[dict]:
    """ST1 + ST2: apply every change file landed since the last run.

    Without ``order_by`` each batch is applied as the source job did (all
    upserts, then all deletes; repeated keys are an error); with it, the last
    change per key wins. Versions older than the newest ``keep_versions`` are
    removed. Returns one report per applied batch.
    """
    t = keyed_table(spark, warehouse, database, table_name, partition_key, primary_key, buckets, touched_buckets)
    by_merge = table_exists(spark, database, table_name) and table_provider(spark, t.name()) in ROW_LEVEL_PROVIDERS
    if not by_merge and t.current_version() is None:
        raise TableMissing(f"{t.name()} has no snapshot yet; run full-load first")
    schema = _landed_schema(spark, raw_path)
    if schema is None:
        return []
    have = (spark.table(t.name()) if by_merge else t.read()).columns
    unknown = [c for c in schema.names if c not in have and c not in METADATA_COLUMNS and c not in (order_by or [])]
    if unknown:
        raise ValueError(f"landed files have columns {unknown} that {t.name()} lacks; add them to the table first")
    reports: list[dict] = []
    stamp_at = run_ts or _now()
    apply_available(
        spark,
        raw_path,
        schema,
        t.name() if by_merge else t,
        primary_key,
        order_by,
        checkpoint or f"{t.root}/_checkpoint",
        recursive=True,
        max_files_per_trigger=max_files_per_trigger,
        prepare=lambda b: stamp_changes(b, stamp_at),
        on_batch=lambda bid, info: reports.append({"batch": bid, **info}),
        **({} if by_merge else {"keep_versions": keep_versions}),
    )
    return reports


def catalog_extract_job(spark: SparkSession, *, jdbc: JdbcSource, schema_name: str, out_path: str) -> int:
    """S8 + K3: extract the source schema's column catalogue as one parquet file."""
    from lakeshift.sources.jdbc import read_catalog

    return export_single_file(read_catalog(spark, jdbc, schema_name), out_path)


def jdbc_reader(spark: SparkSession, src: JdbcSource, keys: dict[tuple[str, str], str | None], *,
                num_partitions: int | None = None, stride: int | None = None) -> Reader:
    """Reader for :func:`migrate_tables`: typed projection pushed to the source,
    split into key ranges. The key is the table list's, or else the table's
    integer primary key as the catalogue has it; ranges are as many as the
    cluster has cores unless ``num_partitions`` is given."""
    parts = num_partitions or spark.sparkContext.defaultParallelism

    def read(database: str, table: str, classes) -> DataFrame:
        key = keys.get((database, table)) or classes.integer_key
        return read_table_typed(spark, src, database, table, classes, key=key, num_partitions=parts, stride=stride)

    return read


def migrate_job(
    spark: SparkSession,
    *,
    table_list: str,
    column_catalog: str,
    warehouse: str,
    status_path: str,
    reader: Reader | None = None,
    jdbc: JdbcSource | None = None,
    catalog_format: str = "csv",
    parallel_tables: int = 4,
    num_partitions: int | None = None,
    stride: int | None = None,
    skip_empty: bool = False,
    prove: bool = False,
) -> DataFrame:
    """M1 + M2 + K3: migrate every listed table; write the status report as one file."""
    tables = [(r["database"], r["table"], r["key"]) for r in read_table_list(spark, table_list).collect()]
    classes = column_classes(read_column_catalog(spark, column_catalog, catalog_format))
    if reader is None:
        if jdbc is None:
            raise ValueError("migrate_job needs a JDBC source or a reader")
        reader = jdbc_reader(spark, jdbc, {(d, t): k for d, t, k in tables}, num_partitions=num_partitions, stride=stride)
    status = migrate_tables(spark, [(d, t) for d, t, _ in tables], classes, reader, warehouse,
                            parallel_tables=parallel_tables, skip_empty=skip_empty, prove=prove)
    export_single_file(status, status_path)
    return spark.read.parquet(status_path)


class CatalogTables:
    """Mart inputs from catalog tables: ``t.orders`` is ``spark.table('<db>.orders')``."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.table(f"{self.database}.{name}")


def marts_job(spark: SparkSession, *, tables, warehouse: str, database: str, today: str,
              only: list[str] | None = None) -> dict[str, str]:
    """Refresh the marts in their fixed order; returns mart -> table name."""
    out = {}
    for name in M.REFRESH_ORDER:
        if only and name not in only:
            continue
        fn: Callable = M.MARTS[name]
        df = fn(tables, today) if name == "reservation_information" else fn(tables)
        M.refresh_mart(spark, df, f"{warehouse.rstrip('/')}/marts", database, name)
        out[name] = f"{database}.{M.MART_TABLE_PREFIX}{name}"
    return out


def daily_flow(
    spark: SparkSession,
    *,
    table_list: str,
    column_catalog: str,
    warehouse: str,
    mart_database: str,
    today: str | None = None,
    jdbc: JdbcSource | None = None,
    schema_name: str | None = None,
    reader: Reader | None = None,
    parallel_tables: int = 4,
    num_partitions: int | None = None,
) -> dict:
    """The daily sequence: (catalogue extract) -> migrate -> refresh marts.

    With ``jdbc`` and ``schema_name`` the catalogue is extracted first into
    ``column_catalog`` (parquet). Marts are built from the migrated catalog
    tables of the first database in the table list, and only when every table
    migrated - a failed table leaves yesterday's marts in place.
    """
    catalog_format = "csv"
    if jdbc is not None and schema_name:
        catalog_extract_job(spark, jdbc=jdbc, schema_name=schema_name, out_path=column_catalog)
        catalog_format = "parquet"
    status = migrate_job(
        spark, table_list=table_list, column_catalog=column_catalog, warehouse=warehouse,
        status_path=f"{warehouse.rstrip('/')}/_status/{datetime.now():%Y%m%d%H%M%S}",
        reader=reader, jdbc=jdbc, catalog_format=catalog_format,
        parallel_tables=parallel_tables, num_partitions=num_partitions,
    )
    summary = status_summary(status).first().asDict()
    if summary["failed"]:
        return {"migration": summary, "marts": "skipped: migration had failures"}
    source_db = status.select("database").first()["database"]
    marts = marts_job(spark, tables=CatalogTables(spark, source_db), warehouse=warehouse,
                      database=mart_database, today=today or business_midnight())
    return {"migration": summary, "marts": marts}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lakeshift.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("full-load", "cdc"):
        s = sub.add_parser(name)
        s.add_argument("--raw-path", required=True)
        s.add_argument("--warehouse", required=True)
        s.add_argument("--database", required=True)
        s.add_argument("--table-name", required=True)
        s.add_argument("--partition-key")
        s.add_argument("--run-ts")
        s.add_argument("--buckets", type=int, help="bucket the table by the primary key into N buckets")
        s.add_argument("--touched-buckets", type=int, help="keep the table in N buckets by primary key; a batch rewrites only those it touches")
        s.add_argument("--primary-key", required=(name == "cdc"))
        if name == "cdc":
            s.add_argument("--checkpoint")
            s.add_argument("--order-by", help="comma-separated change-order columns (enables latest-wins)")
            s.add_argument("--max-files-per-batch", type=int)
    m = sub.add_parser("migrate")
    for a in ("--table-list", "--column-catalog", "--warehouse", "--status-path", "--jdbc-url"):
        m.add_argument(a, required=True)
    m.add_argument("--jdbc-user")
    m.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
    m.add_argument("--catalog-format", default="csv")
    m.add_argument("--parallel-tables", type=int, default=4)
    m.add_argument("--num-partitions", type=int, help="key ranges per table (default: one per core)")
    m.add_argument("--stride", type=int)
    m.add_argument("--prove", action="store_true", help="compare the values written with those read, column by column")
    m.add_argument("--skip-empty", action="store_true", help="leave empty source tables unwritten")
    d = sub.add_parser("daily")
    for a in ("--table-list", "--column-catalog", "--warehouse", "--mart-database", "--jdbc-url", "--schema-name"):
        d.add_argument(a, required=True)
    d.add_argument("--jdbc-user")
    d.add_argument("--jdbc-password-env")
    d.add_argument("--today")
    d.add_argument("--parallel-tables", type=int, default=4)
    d.add_argument("--num-partitions", type=int, help="key ranges per table (default: one per core)")
    k = sub.add_parser("marts")
    k.add_argument("--source-database", required=True)
    k.add_argument("--warehouse", required=True)
    k.add_argument("--database", required=True)
    k.add_argument("--today", help="cutoff, default: midnight today in the marts' time zone")
    args = p.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    if args.job == "full-load":
        res = full_load_job(spark, raw_path=args.raw_path, warehouse=args.warehouse, database=args.database,
                            table_name=args.table_name, partition_key=args.partition_key, run_ts=args.run_ts,
                            primary_key=args.primary_key, buckets=args.buckets, touched_buckets=args.touched_buckets)
    elif args.job == "cdc":
        res = cdc_job(spark, raw_path=args.raw_path, warehouse=args.warehouse, database=args.database,
                      table_name=args.table_name, primary_key=args.primary_key, partition_key=args.partition_key,
                      checkpoint=args.checkpoint, run_ts=args.run_ts,
                      order_by=args.order_by.split(",") if args.order_by else None,
                      max_files_per_trigger=args.max_files_per_batch, buckets=args.buckets,
                      touched_buckets=args.touched_buckets)
    elif args.job == "daily":
        import os

        src = JdbcSource(url=args.jdbc_url, user=args.jdbc_user,
                         password=os.environ.get(args.jdbc_password_env) if args.jdbc_password_env else None)
        res = daily_flow(spark, table_list=args.table_list, column_catalog=args.column_catalog,
                         warehouse=args.warehouse, mart_database=args.mart_database, today=args.today,
                         jdbc=src, schema_name=args.schema_name, parallel_tables=args.parallel_tables,
                         num_partitions=args.num_partitions)
    elif args.job == "migrate":
        import os

        src = JdbcSource(url=args.jdbc_url, user=args.jdbc_user,
                         password=os.environ.get(args.jdbc_password_env) if args.jdbc_password_env else None)
        status = migrate_job(spark, table_list=args.table_list, column_catalog=args.column_catalog,
                             warehouse=args.warehouse, status_path=args.status_path, jdbc=src,
                             catalog_format=args.catalog_format, parallel_tables=args.parallel_tables,
                             num_partitions=args.num_partitions, stride=args.stride, skip_empty=args.skip_empty,
                             prove=args.prove)
        res = status_summary(status).first().asDict()
    else:
        res = marts_job(spark, tables=CatalogTables(spark, args.source_database), warehouse=args.warehouse,
                        database=args.database, today=args.today or business_midnight())
    print(json.dumps(res, default=str))


if __name__ == "__main__":  # pragma: no cover
    main()
