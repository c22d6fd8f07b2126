"""Snapshot writers and catalog registration.

A *snapshot* is a folder holding the complete table as parquet (or Delta when
its jar is present). Parquet tables cannot be rewritten while they are read, so
keyed tables are kept as numbered versions (``v=000001``...) and the catalog
table is repointed to the newest complete version: readers see either the old
or the new snapshot, never an empty or half-written one.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakeshift.functions.ddl import quote_ident, schema_ddl
from lakeshift.session import hadoop_fs, list_dirs, list_files, path_exists, read_small, write_small

SUCCESS_MARKER = "_SUCCESS"
SCHEMA_FILE = "_schema.json"
_VERSION_RE = re.compile(r"^v=(\d+)$")


def sql_string(value: str) -> str:
    """A single-quoted SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def qualified(database: str | None, table: str) -> str:
    return f"{quote_ident(database)}.{quote_ident(table)}" if database else quote_ident(table)


def clustered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of one partition value together before a partitioned write, so that it
    makes few files; AQE splits a value that holds too much for one task."""
    return df.hint("rebalance", *(F.col(f"`{c}`") for c in partition_by))


def write_snapshot(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    num_files: int | None = None,
    merge_schema: bool = False,
) -> None:
    """K1/M3: replace whatever is at ``path`` with ``df``.

    ``num_files`` repartitions first (a full shuffle; use it to bound the file
    count of a table written from few large source partitions).
    """
    if num_files:
        df = df.repartition(num_files)
    elif partition_by:
        df = clustered(df, partition_by)
    w = df.write.format(fmt).mode("overwrite")
    if merge_schema:
        w = w.option("mergeSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_merge_schema(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K2: overwrite rows, keep the union of old and new columns.

    Delta does this natively (``mergeSchema``). For parquet the new rows are
    aligned to old-columns-then-new-columns, old-only columns as null. Only the
    old *schema* is read (footer metadata), so overwriting the path is safe.
    """
    if fmt == "delta":
        write_snapshot(df, path, fmt="delta", merge_schema=True)
        return
    if path_exists(spark, f"{path}/{SUCCESS_MARKER}") or list_files(spark, path):
        df = align_to_schema(df, spark.read.format(fmt).load(path).schema)
    write_snapshot(df, path, fmt=fmt)


def align_to_schema(df: DataFrame, old) -> DataFrame:
    """Old columns first (missing ones as typed nulls), then new columns: the
    column set a schema-merging overwrite leaves behind. Pure projection."""
    from pyspark.sql import functions as F

    have = dict(df.dtypes)
    cols = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in old.fields
    ]
    old_names = {f.name for f in old.fields}
    return df.select(*cols, *[c for c in df.columns if c not in old_names])


def export_single_file(df: DataFrame, path: str, *, files: int = 1, fmt: str = "parquet") -> int:
    """K3: write ``df`` as one file (reports, catalogues) and return its rows.

    The result is computed once, in parallel, into a staging folder, and the
    staged copy is then copied into ``files`` files, so the upstream plan never
    runs inside a single task. For results that grow with the data, ask for more
    files: each is written by one task. The staging folder is removed either way.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}__staging"
    try:
        df.write.format(fmt).mode("overwrite").save(staging)
        staged = spark.read.schema(df.schema).format(fmt).load(staging)
        n = staged.count()
        staged.repartition(files).write.format(fmt).mode("overwrite").save(path)
    finally:
        fs, p = hadoop_fs(spark, staging)
        fs.delete(p, True)
    return n


def ensure_database(spark: SparkSession, database: str) -> None:
    """K7."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(database)}")


def table_exists(spark: SparkSession, database: str | None, table: str) -> bool:
    """Catalog lookup, no listing collected by hand."""
    return spark.catalog.tableExists(f"{quote_ident(database)}.{quote_ident(table)}" if database else table)


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    *,
    fmt: str = "parquet",
    schema=None,
    partition_by: list[str] | None = None,
    bucket_by: list[str] | None = None,
    buckets: int | None = None,
) -> str:
    """K6 + K7 + K8: (re)register an external table over ``path`` with generated DDL.

    Drop-then-create, so a changed schema never stays stale. Returns the
    qualified name.
    """
    ensure_database(spark, database)
    name = qualified(database, table)
    if schema is None and bucket_by:
        schema = spark.read.format(fmt).load(path).schema  # bucketing needs an explicit column list
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ""
    if schema is not None:
        cols = f" ({schema_ddl(schema)})"
    parts = ""
    if partition_by:
        parts = " PARTITIONED BY (" + ", ".join(quote_ident(c) for c in partition_by) + ")"
    if bucket_by and buckets:
        keys = ", ".join(quote_ident(c) for c in bucket_by)
        parts += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE {name}{cols} USING {fmt}{parts} LOCATION {sql_string(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def table_location(spark: SparkSession, name: str) -> str | None:
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if (r[0] or "").strip() == "Location":
            return (r[1] or "").strip()
    return None


def repoint_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    *,
    fmt: str = "parquet",
    schema=None,
    bucket_by: list[str] | None = None,
    buckets: int | None = None,
) -> str:
    """Swap an existing table to a new snapshot folder in one catalog update
    (``ALTER TABLE .. SET LOCATION``), so readers never find the table missing.
    Falls back to drop-and-create when the table is absent or its schema changed."""
    name = qualified(database, table)
    if table_exists(spark, database, table):
        new_schema = schema if schema is not None else spark.read.format(fmt).load(path).schema
        if spark.table(name).schema == new_schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_string(path)}")
            spark.sql(f"REFRESH TABLE {name}")
            return name
    return register_table(spark, database, table, path, fmt=fmt, schema=schema, bucket_by=bucket_by, buckets=buckets)


def create_partitioned_table(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    table: str,
    partition_by: list[str],
    *,
    location: str | None = None,
    fmt: str = "parquet",
) -> bool:
    """K4: create-as-select a partitioned table if it does not exist yet.

    Returns True when created, False when it was already there (left as is).
    """
    ensure_database(spark, database)
    if table_exists(spark, database, table):
        return False
    w = clustered(df, partition_by).write.format(fmt).partitionBy(*partition_by).mode("errorifexists")
    if location:
        w = w.option("path", location)
    w.saveAsTable(qualified(database, table))
    return True


def write_manifest(spark: SparkSession, data_path: str, manifest_path: str, fmt: str = "parquet") -> int:
    """K5: list the data files of a snapshot in a text manifest for external readers.

    Delta writes its own symlink manifest. For parquet the entries are gathered and
    written by the executors: ``entries`` (parquet) and ``symlink`` (text, one name a
    line), both in parts. Returns the number of files.
    """
    if fmt == "delta":  # pragma: no cover - needs the Delta jar
        from delta.tables import DeltaTable  # type: ignore

        DeltaTable.forPath(spark, data_path).generate("symlink_format_manifest")
        return -1
    entries = manifest_entries(spark, data_path, fmt)
    # executors write their own files' entries, as parts of the manifest
    entries.write.mode("overwrite").parquet(f"{manifest_path}/entries")
    kept = spark.read.parquet(f"{manifest_path}/entries")
    kept.select("file").write.mode("overwrite").text(f"{manifest_path}/symlink")
    write_small(spark, f"{manifest_path}/_source", data_path)
    return kept.count()


def manifest_entries(spark: SparkSession, data_path: str, fmt: str = "parquet") -> DataFrame:
    """One row per data file that holds rows: its name, size, time and number of rows. The
    scan reads no column of the data; for parquet the counts come from the footers."""
    m = F.col("_metadata")
    rows = spark.read.format(fmt).load(data_path).select(m.file_path.alias("file"), m.file_size.alias("bytes"), m.file_modification_time.alias("written_at"))
    return rows.groupBy("file", "bytes", "written_at").agg(F.count(F.lit(1)).alias("rows"))


def read_manifest(spark: SparkSession, manifest_path: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the files that a manifest lists; the list stays a
    DataFrame (files that came later are read and left out: a manifest is for readers elsewhere)."""
    listed = spark.read.parquet(f"{manifest_path}/entries").select(F.col("file").alias("__listed"))
    rows = spark.read.format(fmt).load(read_small(spark, f"{manifest_path}/_source"))
    return rows.withColumn("__file", F.col("_metadata.file_path")).join(listed, F.col("__file") == F.col("__listed"), "left_semi").drop("__file")


class VersionedTable:
    """A keyed table kept as numbered snapshot folders plus a catalog pointer.

    ``commit(df, version)`` writes ``root/v=<version>`` and repoints the catalog
    table (one ``ALTER TABLE .. SET LOCATION``; partitioned tables are
    re-registered instead). The version's schema is written first, then its data:
    a version is complete with its ``_SUCCESS``, and then has both. Replaying a
    complete version writes nothing but points the catalog at it if a crash left
    the catalog behind, so replaying a stream batch is harmless.

    With ``bucket_by``/``buckets`` every version is written bucketed by the key
    and read through the catalog (which holds the bucket spec). A key join
    against the table - the change apply's anti-join when the change set is too
    big to broadcast - then scans the target by bucket and shuffles only the
    change side. The bucketed write clusters the rows first: one file a bucket.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        database: str,
        table: str,
        fmt: str = "parquet",
        partition_by: list[str] | None = None,
        bucket_by: list[str] | None = None,
        buckets: int | None = None,
    ):
        self.spark, self.root, self.database, self.table, self.fmt = spark, root.rstrip("/"), database, table, fmt
        self.partition_by = list(partition_by or [])
        self.bucket_by = list(bucket_by or [])
        self.buckets = int(buckets) if buckets else None
        if bool(self.bucket_by) != bool(self.buckets):
            raise ValueError("give both bucket_by and buckets, or neither")

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:09d}"

    def _numbered(self) -> list[int]:
        nums = (_VERSION_RE.match(n) for n in list_dirs(self.spark, self.root))
        return sorted(int(m.group(1)) for m in nums if m)

    def versions(self) -> list[int]:
        """All complete versions, oldest first."""
        return [v for v in self._numbered() if self.has(v)]

    def current_version(self) -> int | None:
        """The newest complete version (checks newest first; one listing)."""
        for v in reversed(self._numbered()):
            if self.has(v):
                return v
        return None

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` complete versions (and any
        incomplete folder older than them). Returns the versions removed.
        Readers still scanning a removed version will fail, so keep >= 2."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        done = self.versions()
        if len(done) <= keep:
            return []
        cutoff = done[-keep]
        removed = [v for v in self._numbered() if v < cutoff]
        for v in removed:
            for path in (self.path(v), self._schema_path(v), self._index_path(v)):
                fs, p = hadoop_fs(self.spark, path)
                fs.delete(p, True)
        return removed

    def has(self, version: int) -> bool:
        return path_exists(self.spark, f"{self.path(version)}/{SUCCESS_MARKER}")

    def read(self) -> DataFrame:
        v = self.current_version()
        if v is None:
            raise FileNotFoundError(f"no complete snapshot under {self.root}")
        if not self.bucket_by:
            schema = self._schema(v)
            rows = self.spark.read.format(self.fmt)
            if schema is None:
                return rows.load(self.path(v))
            return rows.schema(schema).load(self.path(v)).select([F.col(f"`{c}`") for c in schema.names])
        # bucketed: read through the catalog, after making sure it points at
        # the newest complete version (a crash may have left it one behind)
        self._catch_up(v)
        return self.spark.table(self.name())

    def _catch_up(self, version: int) -> None:
        """Point the catalog at ``version`` unless it is there."""
        loc = table_location(self.spark, self.name()) if table_exists(self.spark, self.database, self.table) else None
        if loc is None or loc.rstrip("/").rsplit("/", 1)[-1] != self.path(version).rsplit("/", 1)[-1]:
            self._point(self.path(version))

    def _index_path(self, version: int) -> str:
        return f"{self.root}/_index/v={version:09d}"

    def key_index(self, key: str) -> str:
        """Where the newest version's index of files by key lies (see
        :mod:`lakeshift.sinks.keyindex`); made on first use, removed with the version."""
        from lakeshift.sinks.keyindex import FILTERS, write_key_index

        version = self.current_version()
        path = f"{self._index_path(version)}/{key}"
        if not path_exists(self.spark, f"{path}/{FILTERS}/{SUCCESS_MARKER}"):
            write_key_index(self.spark, self.path(version), path, key)
        return path

    def _schema_path(self, version: int) -> str:
        return f"{self.root}/_schemas/v={version:09d}.json"

    def _schema(self, version: int):
        """The schema version ``version`` was committed with. Folder names cannot
        tell the type of a partition value (text "001" would come back as 1)."""
        text = read_small(self.spark, self._schema_path(version)) or read_small(self.spark, f"{self.path(version)}/{SCHEMA_FILE}")
        return StructType.fromJson(json.loads(text)) if text else None

    def _save_schema(self, schema, version: int) -> None:
        write_small(self.spark, self._schema_path(version), schema.json())

    def _point(self, path: str, schema=None) -> None:
        """Point the catalog table at ``path``, with the schema it was committed with."""
        if schema is None:
            schema = self._schema(int(path.rsplit("=", 1)[-1])) or self.spark.read.format(self.fmt).load(path).schema
        if self.partition_by:
            register_table(self.spark, self.database, self.table, path, fmt=self.fmt, schema=schema,
                           partition_by=self.partition_by, bucket_by=self.bucket_by, buckets=self.buckets)
        else:
            repoint_table(self.spark, self.database, self.table, path, fmt=self.fmt, schema=schema,
                          bucket_by=self.bucket_by, buckets=self.buckets)

    def _write(self, df: DataFrame, version: int) -> None:
        if not self.bucket_by:
            write_snapshot(df, self.path(version), fmt=self.fmt, partition_by=self.partition_by or None)
            return
        # bucketed files can only be written through saveAsTable; write via a
        # throw-away external table over the version folder, then drop it
        # (external: the files stay)
        ensure_database(self.spark, self.database)
        staging = f"{self.table}__v{version}"
        df = df.repartition(self.buckets, *(F.col(f"`{c}`") for c in self.bucket_by))  # one file a bucket
        w = df.write.format(self.fmt).bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by)
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        self.spark.sql(f"DROP TABLE IF EXISTS {qualified(self.database, staging)}")
        w.option("path", self.path(version)).mode("overwrite").saveAsTable(qualified(self.database, staging))
        self.spark.sql(f"DROP TABLE IF EXISTS {qualified(self.database, staging)}")

    def commit(self, df: DataFrame, version: int) -> bool:
        """Write version ``version``; False if it already exists (replay)."""
        cur = self.current_version()
        if self.has(version):
            if version == cur:
                self._catch_up(version)
            return False
        if cur is not None and version <= cur:
            raise ValueError(f"version {version} is not after current version {cur}")
        self._save_schema(StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema]), version)
        self._write(df, version)
        self._point(self.path(version))
        return True

    def name(self) -> str:
        return qualified(self.database, self.table)


def refresh_table(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    database: str,
    table: str,
    fmt: str = "parquet",
    *,
    merge_schema: bool = False,
) -> str:
    """Full refresh as a swap. The new snapshot is written completely, then
    the catalog table is repointed; a failed refresh leaves the old one in place.
    ``merge_schema`` keeps columns of the previous version that the new rows
    lack (as nulls), like a schema-merging overwrite (K2)."""
    t = VersionedTable(spark, root, database, table, fmt)
    cur = t.current_version()
    if merge_schema and cur is not None:
        df = align_to_schema(df, spark.read.format(fmt).load(t.path(cur)).schema)
    t.commit(df, 1 if cur is None else cur + 1)
    return t.name()


def table_report(spark: SparkSession, name: str, preview_rows: int = 5) -> dict:
    """K12 as data: DDL, row count and a few rows of a registered table (any rows, as
    the source jobs showed; ordering a whole table for them would read it all)."""
    df = spark.table(name)
    return {
        "table": name,
        "ddl": schema_ddl(df.schema),
        "rows": df.count(),
        "preview": [r.asDict() for r in df.limit(preview_rows).collect()],
    }


__all__ = [
    "write_snapshot",
    "overwrite_merge_schema",
    "align_to_schema",
    "export_single_file",
    "ensure_database",
    "table_exists",
    "register_table",
    "repoint_table",
    "create_partitioned_table",
    "write_manifest",
    "read_manifest",
    "VersionedTable",
    "refresh_table",
    "table_report",
]
