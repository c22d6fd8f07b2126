"""JDBC sources.

Settings always come from arguments (``JdbcSource``); nothing here holds a
host, user or password.

The chunked read of the source jobs (a serial loop of key windows, each its own
Spark job) becomes ONE read whose partitions are disjoint half-open key ranges,
read in parallel by the executors. The same range plan serves file sources via
:func:`read_key_ranges`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.projection import typed_select_sql
from lakeshift.sources.catalog import CATALOG_SCHEMA, ColumnClasses, catalog_query_sql

# --- Fixed values: the source jobs' JDBC read settings. -----------------------
DEFAULT_FETCH_SIZE = 4000  # rows per round trip
DEFAULT_QUERY_TIMEOUT = 300  # seconds
SOURCE_CHUNK_STRIDE = 100000  # key width of one chunk in the source jobs' serial loop
# ------------------------------------------------------------------------------

#: Ranges a fixed stride makes at most: each is a partition of the read, planned on the driver.
#: Over a wider span a range takes several strides.
MAX_RANGES = 100_000


@dataclass
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetchsize: int = DEFAULT_FETCH_SIZE
    query_timeout: int = DEFAULT_QUERY_TIMEOUT
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        o = {"url": self.url, "fetchsize": str(self.fetchsize), "queryTimeout": str(self.query_timeout)}
        if self.user is not None:
            o["user"] = self.user
        if self.password is not None:
            o["password"] = self.password
        if self.driver:
            o["driver"] = self.driver
        o.update({k: str(v) for k, v in self.extra.items()})
        return o


def query_options(src: JdbcSource, query: str) -> dict[str, str]:
    """Options for a pushed query, single partition."""
    return {**src.options(), "query": query}


def read_query(spark: SparkSession, src: JdbcSource, query: str) -> DataFrame:
    """Lazy read of a pushed query. Filters applied afterwards are pushed
    to the database by Spark (P8)."""
    return spark.read.format("jdbc").options(**query_options(src, query)).load()


def quoted(name: str, quote: str = "`") -> str:
    return f"{quote}{name.replace(quote, quote * 2)}{quote}"


def bounds_query(table_sql: str, key: str) -> str:
    """Min and max of the key, computed by the source."""
    return f"SELECT MIN({quoted(key)}) AS lo, MAX({quoted(key)}) AS hi FROM {table_sql}"


def key_bounds(df: DataFrame, key: str) -> tuple | None:
    """S5 for any DataFrame: (lo, hi) of ``key`` in one aggregate; None if empty."""
    r = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if r is None or r["lo"] is None:
        return None
    return r["lo"], r["hi"]


def plan_key_ranges(lo: int, hi: int, *, num_partitions: int | None = None, stride: int | None = None) -> list[tuple[int, int]]:
    """Disjoint half-open ranges ``[start, end)`` covering ``lo..hi`` (inclusive).

    Give either a partition count or a stride. Gaps in the keys only leave some
    ranges empty; no boundary row is read twice and the plan always ends.
    """
    if not isinstance(lo, int) or not isinstance(hi, int):
        raise TypeError(f"key range needs integer bounds, got {lo!r}..{hi!r}")
    if hi < lo:
        return []
    span = hi - lo + 1
    if stride is None:
        n = max(1, int(num_partitions or 1))
        stride = max(1, math.ceil(span / n))
    if stride <= 0:
        raise ValueError("stride must be positive")
    if span > stride * MAX_RANGES:
        stride *= math.ceil(span / (stride * MAX_RANGES))  # several strides to a range
    return [(s, min(s + stride, hi + 1)) for s in range(lo, hi + 1, stride)]


def bucket_width(lo: int, hi: int, buckets: int) -> int:
    return max(1, math.ceil((hi - lo + 1) / max(1, buckets)))


def histogram_sql(table_sql: str, key: str, lo: int, width: int, hi_excl: int | None = None) -> str:
    """Rows per fixed-width key bucket, counted by the source (one row per bucket)."""
    k = quoted(key)
    b = f"FLOOR(({k} - {lo}) / {width})"
    where = f"{k} IS NOT NULL" if hi_excl is None else f"{k} >= {lo} AND {k} < {hi_excl}"
    return f"SELECT {b} AS bucket, COUNT(*) AS n FROM {table_sql} WHERE {where} GROUP BY {b}"


def key_histogram(df: DataFrame, key: str, lo: int, width: int, hi_excl: int | None = None) -> DataFrame:
    """The same histogram for a DataFrame source (partially aggregated; one row per bucket)."""
    k = F.col(key)
    cond = k.isNotNull() if hi_excl is None else (k >= lo) & (k < hi_excl)
    # exact integer division (keys are >= lo here); floating division would
    # misplace large bigint keys
    bucket = F.expr(f"(`{key}` - {lo}) div {width}")
    return df.filter(cond).groupBy(bucket.cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


Segment = tuple  # (start, end_exclusive, rows)
Histogram = "Callable[[int, int, int], dict[int, int]]"  # (lo, hi_excl, width) -> {bucket: rows}


def _segments(lo: int, hi_excl: int, width: int, counts: dict[int, int]) -> list[Segment]:
    return sorted((lo + b * width, min(lo + (b + 1) * width, hi_excl), n) for b, n in counts.items() if n > 0)


def balanced_segments(lo: int, hi: int, histogram, num_partitions: int, buckets: int = 1024) -> list[Segment]:
    """Non-empty key segments with row counts: one histogram over ``lo..hi`` with
    at least four buckets for each partition, then one finer histogram inside
    each bucket that alone holds more than a partition's share - none where keys
    are even, whatever the number of partitions."""
    width = bucket_width(lo, hi, max(buckets, 4 * num_partitions))
    segs = _segments(lo, hi + 1, width, histogram(lo, hi + 1, width))
    share = sum(n for _, _, n in segs) / max(1, num_partitions)
    out: list[Segment] = []
    for a, b, n in segs:
        if n > share and b - a > 1:
            sub_w = bucket_width(a, b - 1, buckets)
            out.extend(_segments(a, b, sub_w, histogram(a, b, sub_w)))
        else:
            out.append((a, b, n))
    return out


def ranges_from_segments(lo: int, hi: int, segments: list[Segment], num_partitions: int) -> list[tuple[int, int]]:
    """Half-open ranges covering ``lo..hi`` with about equal row counts.

    Segments are merged in key order and a range is closed once it holds its
    share, so empty key stretches cost nothing and dense ones get more ranges.
    """
    if hi < lo:
        return []
    parts = max(1, int(num_partitions))
    total = sum(n for _, _, n in segments)
    if total == 0 or parts == 1:
        return [(lo, hi + 1)]
    share = total / parts
    ranges, start, acc, cuts = [], lo, 0, 0
    for _, end, n in sorted(segments):
        acc += n
        if acc >= share * (cuts + 1) and cuts < parts - 1 and start < end <= hi:
            ranges.append((start, end))
            start, cuts = end, cuts + 1
    ranges.append((start, hi + 1))
    return ranges


def balanced_ranges(lo: int, hi: int, width: int, counts: dict[int, int], num_partitions: int) -> list[tuple[int, int]]:
    """Balanced ranges from one bucket histogram (``counts``: bucket -> rows)."""
    return ranges_from_segments(lo, hi, _segments(lo, hi + 1, width, counts), num_partitions)


def plan_balanced(df: DataFrame, key: str, lo: int, hi: int, num_partitions: int, buckets: int = 1024) -> list[tuple[int, int]]:
    """Balanced ranges for a DataFrame source: histograms by Spark, plan on the driver."""

    def histogram(a: int, b: int, width: int) -> dict[int, int]:
        return {int(r["bucket"]): int(r["n"]) for r in key_histogram(df, key, a, width, b).collect()}

    segs = balanced_segments(lo, hi, histogram, num_partitions, buckets)
    return ranges_from_segments(lo, hi, segs, num_partitions)


def integer_bounds(key: str, lo, hi) -> tuple[int, int]:
    """Key bounds as integers; a non-numeric key is rejected with a clear message."""
    import decimal

    for v in (lo, hi):
        if isinstance(v, bool) or not isinstance(v, (int, decimal.Decimal)) or int(v) != v:
            raise TypeError(f"range reads need an integer key; {key!r} has bound {v!r}")
    return int(lo), int(hi)


def range_predicates(key: str, ranges: list[tuple[int, int]]) -> list[str]:
    """One WHERE clause per range, for ``spark.read.jdbc(predicates=...)``.

    Together they admit every row: the first range is open below and takes the
    rows without a key, the last is open above, so that rows which arrive after
    the bounds were read are not lost.
    """
    k, last = quoted(key), len(ranges) - 1
    out = []
    for i, (a, b) in enumerate(ranges):
        parts = ([f"{k} >= {a}"] if i else []) + ([f"{k} < {b}"] if i < last else [])
        clause = " AND ".join(parts) or "1 = 1"
        out.append(f"({clause} OR {k} IS NULL)" if i == 0 and last else clause)
    return out


def partitioned_options(src: JdbcSource, query: str, key: str, lo: int, hi: int, num_partitions: int) -> dict[str, str]:
    """Spark's own range partitioning of a pushed query (``dbtable='(q) t'``;
    the ``query`` option cannot be combined with ``partitionColumn``)."""
    return {
        **src.options(),
        "dbtable": f"({query}) q",
        "partitionColumn": key,
        "lowerBound": str(lo),
        "upperBound": str(hi + 1),
        "numPartitions": str(max(1, num_partitions)),
    }


def read_partitioned(
    spark: SparkSession,
    src: JdbcSource,
    query: str,
    key: str,
    *,
    num_partitions: int,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """S5 + S7: bounds probe, then one parallel read (Spark's first partition takes
    null keys and its last is open above). Without any key value: one plain read."""
    if bounds is None:
        b = read_query(spark, src, bounds_query(f"({query}) b", key)).first()
        if b is None or b["lo"] is None:
            return read_query(spark, src, query)
        bounds = integer_bounds(key, b["lo"], b["hi"])
    lo, hi = bounds
    return spark.read.format("jdbc").options(**partitioned_options(src, query, key, lo, hi, num_partitions)).load()


def read_by_ranges(
    spark: SparkSession,
    src: JdbcSource,
    query: str,
    key: str,
    ranges: list[tuple[int, int]],
) -> DataFrame:
    """S7 with explicit ranges (e.g. a fixed stride): one partition per
    half-open range, all read in parallel by the executors. Without any range
    (no key value seen): one plain read, which also finds rows without a key."""
    if not ranges:
        return read_query(spark, src, query)
    props = {k: v for k, v in src.options().items() if k != "url"}
    return spark.read.jdbc(src.url, f"({query}) q", predicates=range_predicates(key, ranges), properties=props)


def read_balanced(
    spark: SparkSession,
    src: JdbcSource,
    query: str,
    key: str,
    *,
    num_partitions: int,
    buckets: int = 1024,
) -> DataFrame:
    """S7 for skewed or gappy keys: bounds, then bucket histograms computed by
    the source (aggregates pushed down; at most ~``buckets`` rows come back per
    histogram), then ``num_partitions`` ranges of about equal row counts.

    Ranges cannot split one key value: range on a unique key (the primary key).
    On a non-unique key, a single value holding a large share stays one read
    task; the migration's REBALANCE still evens out everything after the read.
    """
    b = read_query(spark, src, bounds_query(f"({query}) b", key)).first()
    if b is None or b["lo"] is None:
        return read_query(spark, src, query)
    lo, hi = integer_bounds(key, b["lo"], b["hi"])

    def histogram(a: int, b_excl: int, width: int) -> dict[int, int]:
        rows = read_query(spark, src, histogram_sql(f"({query}) h", key, a, width, b_excl)).collect()
        return {int(r["bucket"]): int(r["n"]) for r in rows}

    segs = balanced_segments(lo, hi, histogram, num_partitions, buckets)
    return read_by_ranges(spark, src, query, key, ranges_from_segments(lo, hi, segs, num_partitions))


def read_table_typed(
    spark: SparkSession,
    src: JdbcSource,
    database: str,
    table: str,
    classes: ColumnClasses,
    *,
    key: str | None = None,
    num_partitions: int = 1,
    stride: int | None = None,
    balanced: bool = True,
) -> DataFrame:
    """P1 + S3/S7: read one table with its typed projection, in parallel when a key is given.

    ``stride`` reads fixed-width key windows (the source jobs used ``SOURCE_CHUNK_STRIDE``);
    otherwise ``num_partitions`` ranges between the key bounds, balanced by a
    source-side histogram (default) or of equal width.
    """
    query = typed_select_sql(database, table, classes)
    if key and not stride and balanced and num_partitions > 1:
        return read_balanced(spark, src, query, key, num_partitions=num_partitions)
    if key and stride:
        b = read_query(spark, src, bounds_query(f"({query}) b", key)).first()
        if b is None or b["lo"] is None:
            return read_query(spark, src, query)
        lo, hi = integer_bounds(key, b["lo"], b["hi"])
        return read_by_ranges(spark, src, query, key, plan_key_ranges(lo, hi, stride=stride))
    if key and num_partitions > 1:
        return read_partitioned(spark, src, query, key, num_partitions=num_partitions)
    return read_query(spark, src, query)


def read_catalog(spark: SparkSession, src: JdbcSource, schema_name: str) -> DataFrame:
    """The column catalogue of one schema."""
    df = read_query(spark, src, catalog_query_sql(schema_name))
    return df.select([F.col(c.split()[0]).cast(c.split()[1]) for c in CATALOG_SCHEMA.split(", ")])


def read_key_ranges(df: DataFrame, key: str, num_partitions: int) -> DataFrame:
    """The parallel range read for a non-JDBC frame: one scan, dealt into key
    ranges of about equal size by Spark's own sampling; rows without a key come
    first. A file scan is parallel already, so there is nothing to gain from one
    scan per range."""
    return df.repartitionByRange(num_partitions, F.col(f"`{key}`"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name (by position only invites silent column swaps)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
