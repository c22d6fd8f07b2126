"""ST2/J3/J4 on a keyed table whose versions share what a batch does not touch.

The rows are dealt into buckets by a hash of their key. A version writes only the
buckets that its batch touches and takes the others by reference from the versions
before, so a small batch rewrites a small part of the table. Which version holds
which bucket is one small state file per version, written after the data: a version
is complete with it.

Layout under ``root``::

    data/v=000000003/__bucket=17/part-...   buckets written by version 3
    _state/000000003.json                   schema, and the version of each bucket
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lakeshift.functions.ddl import schema_ddl
from lakeshift.operators.cdc import METADATA_COLUMNS, OP_COLUMN, apply_changes, apply_reduced, reduced_changes
from lakeshift.session import hadoop_fs, list_dirs, list_files, read_small, write_small
from lakeshift.sinks.snapshot import ensure_database, qualified, sql_string, table_exists

BUCKET = "__bucket"


class BucketedTable:
    """A keyed table of ``buckets`` buckets under ``root``, registered as ``database.table``.

    A row without a full key goes to a bucket by its whole content, so that such rows
    spread and equal ones meet. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, database: str, table: str, key: str | Iterable[str], buckets: int):
        self.spark, self.root, self.database, self.table = spark, root.rstrip("/"), database, table
        self.key = [key] if isinstance(key, str) else list(key)
        self.buckets = int(buckets)

    # -- state ------------------------------------------------------------------

    def _state_path(self, version: int) -> str:
        return f"{self.root}/_state/{version:09d}.json"

    def versions(self) -> list[int]:
        """All complete versions, oldest first."""
        names = (p.rsplit("/", 1)[-1] for p in list_files(self.spark, f"{self.root}/_state"))
        return sorted(int(n[:9]) for n in names if n.endswith(".json"))

    def current_version(self) -> int | None:
        return max(self.versions(), default=None)

    def _state(self, version: int) -> tuple[StructType, dict[int, int]]:
        state = json.loads(read_small(self.spark, self._state_path(version)))
        return StructType.fromJson(state["schema"]), {int(b): v for b, v in state["buckets"].items()}

    def _save_state(self, version: int, schema: StructType, held: dict[int, int]) -> None:
        """Under another name first: the state appears whole or not at all."""
        text = json.dumps({"schema": schema.jsonValue(), "buckets": {str(b): v for b, v in sorted(held.items())}})
        write_small(self.spark, f"{self._state_path(version)}.new", text)
        fs, new = hadoop_fs(self.spark, f"{self._state_path(version)}.new")
        fs.rename(new, hadoop_fs(self.spark, self._state_path(version))[1])

    def folder(self, bucket: int, version: int) -> str:
        return f"{self.root}/data/v={version:09d}/{BUCKET}={bucket}"

    # -- rows -------------------------------------------------------------------

    def bucket(self, columns: list[str]) -> Column:
        """The bucket of a row that has these columns."""
        without = F.lit(False)
        for k in self.key:
            without = without | F.col(f"`{k}`").isNull()
        of_key = F.xxhash64(*(F.col(f"`{k}`") for k in self.key))
        content = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)), {"ignoreNullFields": "false"}))
        return F.pmod(F.when(without, content).otherwise(of_key), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (default: the newest complete one), or of some of its buckets."""
        version = self.current_version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no complete version under {self.root}")
        schema, held = self._state(version)
        wanted = held if buckets is None else {b: held[b] for b in buckets if b in held}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self.folder(b, v) for b, v in sorted(wanted.items())))

    def _write(self, df: DataFrame, version: int) -> set[int]:
        """Write the rows as buckets of ``version``; which buckets there are now."""
        path = f"{self.root}/data/v={version:09d}"
        dealt = df.withColumn(BUCKET, self.bucket(df.columns))
        # a bucket's rows come together; AQE splits one that is too large for a task
        dealt.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).mode("overwrite").parquet(path)
        return {int(n.split("=")[1]) for n in list_dirs(self.spark, path) if n.startswith(f"{BUCKET}=")}

    def create(self, df: DataFrame, version: int = 0) -> None:
        """The first version: all rows."""
        schema = StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
        self._save_state(version, schema, dict.fromkeys(self._write(df, version), version))
        self.register()

    def apply(
        self,
        feed: DataFrame,
        order_by: Iterable[str | Column] | None = None,
        *,
        op_col: str = OP_COLUMN,
        drop_cols: Iterable[str] = METADATA_COLUMNS,
        stage_dir: str | None = None,
    ) -> dict:
        """Apply a batch (J4 with ``order_by``, else J3) as the next version.

        The batch is reduced and staged once. Its buckets, at most as many as the table
        has, are all that is read of the table and all that is written; returns how many
        were ``rewritten`` and how many ``carried``.
        """
        cur = self.current_version()
        schema, held = self._state(cur)
        columns, version = schema.names, cur + 1
        # a bucket is a hash of typed values: the feed's must have the table's types
        feed = feed.withColumns({f.name: F.col(f"`{f.name}`").cast(f.dataType) for f in schema.fields if f.name in feed.columns})
        stage = stage_dir or f"{self.root}/_staging/{version:09d}"
        if order_by is not None:
            last = reduced_changes(feed, self.key, order_by, columns, op_col=op_col, drop_cols=drop_cols)
        else:
            last = feed.select(*self.key, *[c for c in feed.columns if c not in self.key])
        row = last.select("*", *(F.col("__last")[c].alias(c) for c in columns if c not in self.key)) if order_by is not None else last
        row.withColumn(BUCKET, self.bucket(columns)).select(*last.columns, BUCKET).write.mode("overwrite").parquet(stage)
        staged = self.spark.read.schema(StructType([*last.schema.fields, StructField(BUCKET, IntegerType())])).parquet(stage)
        touched = [r[0] for r in staged.select(BUCKET).distinct().collect()]
        current, batch = self.read(cur, touched), staged.drop(BUCKET)
        if order_by is not None:
            new = apply_reduced(current, batch, self.key, op_col=op_col)
        else:
            new = apply_changes(current, batch, self.key, op_col=op_col, drop_cols=drop_cols)
        there = self._write(new, version) if touched else set()
        after = {b: v for b, v in held.items() if b not in set(touched)} | dict.fromkeys(there, version)
        self._save_state(version, schema, after)
        fs, p = hadoop_fs(self.spark, stage)
        fs.delete(p, True)
        self.register()
        return {"version": version, "rewritten": len(touched), "carried": len(after) - len(there)}

    # -- housekeeping -----------------------------------------------------------

    def name(self) -> str:
        return qualified(self.database, self.table)

    def register(self) -> str:
        """Point the catalog table's partitions at the folders of the newest version: only
        those that moved. Readers by path (:meth:`read`) see a version whole; a query of
        the catalog table that starts meanwhile may see some buckets of each."""
        schema, held = self._state(self.current_version())
        ensure_database(self.spark, self.database)
        name = self.name()
        if not table_exists(self.spark, self.database, self.table):
            whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
            self.spark.sql(
                f"CREATE TABLE {name} ({schema_ddl(whole)}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION {sql_string(f'{self.root}/data/none')}"
            )
        known = {}
        for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect():
            b = int(r[0].split("=")[1])
            known[b] = None
        where = {b: self.folder(b, v) for b, v in held.items()}
        pointed = self._pointed()
        for b in known:
            if b not in where:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({BUCKET}={b})")
            elif pointed.get(b) != held[b]:
                self.spark.sql(f"ALTER TABLE {name} PARTITION ({BUCKET}={b}) SET LOCATION {sql_string(where[b])}")
        new = [f"PARTITION ({BUCKET}={b}) LOCATION {sql_string(p)}" for b, p in sorted(where.items()) if b not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new)}")
        write_small(self.spark, f"{self.root}/_catalog.json", json.dumps({str(b): v for b, v in held.items()}))
        self.spark.sql(f"REFRESH TABLE {name}")
        return name

    def _pointed(self) -> dict[int, int]:
        """What the catalog was last pointed at."""
        text = read_small(self.spark, f"{self.root}/_catalog.json")
        return {int(b): v for b, v in json.loads(text).items()} if text else {}

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the bucket folders that none of the newest ``keep`` versions refers to."""
        if keep < 1:
            raise ValueError("keep at least the current version")
        done = self.versions()
        used = {self.folder(b, v) for version in done[-keep:] for b, v in self._state(version)[1].items()}
        removed = []
        for v in list_dirs(self.spark, f"{self.root}/data"):
            for b in list_dirs(self.spark, f"{self.root}/data/{v}"):
                path = f"{self.root}/data/{v}/{b}"
                if b.startswith(f"{BUCKET}=") and path not in used and int(v.split("=")[1]) <= done[-1]:
                    fs, p = hadoop_fs(self.spark, path)
                    fs.delete(p, True)
                    removed.append(path)
        for version in done[:-keep]:
            fs, p = hadoop_fs(self.spark, self._state_path(version))
            fs.delete(p, True)
        return removed
