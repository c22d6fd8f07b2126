"""M1/M2: a migration by key ranges that a rerun continues.

The ranges are planned once and kept beside the target. Each is read and written as a
folder of its own, whose success marker is its entry in the ledger: a folder without
one is written anew, one with it is not read again. A source change between the runs
shows in the ranges read later, as it would in one long read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeshift.session import path_exists, read_small, write_small
from lakeshift.sinks.snapshot import SUCCESS_MARKER

RangeReader = Callable[[str], DataFrame]


class RangesFailed(RuntimeError):
    """Some ranges could not be read or written; those that could are kept. ``failed`` maps a range to its error."""

    def __init__(self, failed: dict[int, str]):
        super().__init__("; ".join(f"range {i}: {e}" for i, e in sorted(failed.items())))
        self.failed = failed


class RangeLedger:
    """Which ranges of one table are done. The plan does not change once it is written."""

    def __init__(self, spark: SparkSession, root: str, plan: Callable[[], list[str]]):
        self.spark, self.root = spark, root.rstrip("/")
        kept = read_small(spark, f"{self.root}/_plan.json")
        if kept is None:
            self.predicates = plan()
            write_small(spark, f"{self.root}/_plan.json", json.dumps(self.predicates))
        else:
            self.predicates = json.loads(kept)

    def folder(self, i: int) -> str:
        return f"{self.root}/range={i:06d}"

    def missing(self) -> list[int]:
        return [i for i in range(len(self.predicates)) if not path_exists(self.spark, f"{self.folder(i)}/{SUCCESS_MARKER}")]

    def read(self) -> DataFrame:
        """The whole table; all ranges must be done."""
        left = self.missing()
        if left:
            raise FileNotFoundError(f"{len(left)} of {len(self.predicates)} ranges are missing, e.g. {left[:5]}")
        schema = StructType.fromJson(json.loads(read_small(self.spark, f"{self.root}/_schema.json")))
        return self.spark.read.schema(schema).parquet(*(self.folder(i) for i in range(len(self.predicates))))


def migrate_ranges(
    spark: SparkSession,
    read_range: RangeReader,
    plan: Callable[[], list[str]],
    root: str,
    *,
    parallel_ranges: int = 4,
) -> tuple[RangeLedger, list[int]]:
    """Read and write the ranges that are not done yet; returns the ledger and which ranges
    this run read. Every range is tried; :class:`RangesFailed` tells which failed."""
    ledger = RangeLedger(spark, root, plan)
    todo, failed = ledger.missing(), {}

    def one(i: int) -> None:
        try:
            df = read_range(ledger.predicates[i])
            if not path_exists(spark, f"{root}/_schema.json"):
                write_small(spark, f"{root}/_schema.json", df.schema.json())
            df.write.mode("overwrite").parquet(ledger.folder(i))
        except Exception as e:  # noqa: BLE001 - the other ranges go on
            failed[i] = f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max_workers=max(1, parallel_ranges)) as pool:
        list(pool.map(inheritable_thread_target(spark)(one), todo))
    if failed:
        raise RangesFailed(failed)
    return ledger, todo
