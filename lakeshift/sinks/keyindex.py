"""Which files of a snapshot a batch can touch.

Beside a snapshot lies an index with one row per data file: its rows, the least and
greatest key, and a Bloom filter of its keys. A batch is matched to files by key
range first - both are dealt into slices of the key's range, so that a key meets only
the files of its slice - and then by the filter. A file that is not chosen holds none
of the keys; a chosen one may hold none either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeshift.operators.cdc import conform

#: Bits of a filter for each key, and bits set for each: about 1 key in 100 passes by chance.
BITS_PER_KEY, HASHES = 10, 5
#: A filter's bits are a multiple of this; a row of it holds the bits of one word.
FILTER_BITS, WORD = 32768, 64
#: Slices that the keys' range is cut into, to match batch and files.
SLICES = 256
#: Folder of the filters; it comes last, and an index without it is made again.
FILTERS = "words"


def _bit(key: str, k: int, bits: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(k), F.col(f"`{key}`")), bits)


def write_key_index(spark: SparkSession, data_path: str, index_path: str, key: str) -> None:
    """Two passes over the key column of all files: counts and bounds, then the filters
    (partially aggregated; a filter is one row per ``WORD`` bits)."""
    rows = spark.read.parquet(data_path).select(F.col("_metadata.file_path").alias("file"), F.col(f"`{key}`"))
    files = rows.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"), F.count_if(F.col(key).isNull()).alias("without")
    )
    bits = F.ceil(F.greatest(F.col("rows") * BITS_PER_KEY, F.lit(1)) / FILTER_BITS) * FILTER_BITS
    numbered = files.withColumn("bits", bits.cast("long")).withColumn("id", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(f"{index_path}/files")
    _filters(rows, spark.read.parquet(f"{index_path}/files"), key).write.mode("overwrite").parquet(f"{index_path}/{FILTERS}")


def _filters(rows: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """The words of each file's filter that have a bit set. Words are numbers, so they are put together
    in hash tables as large as the filters; the bits of all keys are never sorted."""
    dealt = rows.where(F.col(f"`{key}`").isNotNull()).join(files.select(F.col("file").alias("of"), "id", "bits"), F.col("file") == F.col("of"))
    bit = F.explode(F.array(*(_bit(key, k, F.col("bits")) for k in range(HASHES)))).alias("bit")
    words = dealt.select("id", bit).groupBy("id", _word("bit").alias("word"))
    return words.agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(bit % {WORD} AS INT))")).alias("set"))


def _word(bit: str) -> Column:
    return F.floor(F.col(bit) / WORD)


def _slices(files: DataFrame) -> list:
    """Bounds between slices: keys at which files begin, evenly spread, and at most ``SLICES`` of them."""
    cuts = files.where("lo IS NOT NULL").select("lo").distinct().orderBy("lo")
    n = cuts.count()
    if n <= SLICES:
        return [r["lo"] for r in cuts.collect()]
    ranged = cuts.repartitionByRange(SLICES, "lo").groupBy(F.spark_partition_id().alias("t")).agg(F.min("lo").alias("lo"))
    return [r["lo"] for r in ranged.orderBy("lo").collect()]


def _slice_of(value: Column, cuts: list) -> Column:
    """The number of bounds that are not above ``value``."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= value))


def touched_files(spark: SparkSession, index_path: str, keys: DataFrame, key: str) -> DataFrame:
    """The files (one column, ``file``) that may hold one of ``keys``; with a null among
    the keys also those that hold rows without a key."""
    files = spark.read.parquet(f"{index_path}/files")
    cuts = _slices(files)
    wanted = keys.select(F.col(f"`{key}`").alias("k")).distinct()
    ranged = files.where("lo IS NOT NULL").withColumn("slice", F.explode(F.sequence(_slice_of(F.col("lo"), cuts), _slice_of(F.col("hi"), cuts))))
    placed = wanted.where("k IS NOT NULL").withColumn("slice", _slice_of(F.col("k"), cuts))
    near = placed.join(ranged, "slice").where((F.col("k") >= F.col("lo")) & (F.col("k") <= F.col("hi"))).select("id", "bits", "k")
    near = near.withColumn("bit", F.explode(F.array(*(_bit("k", h, F.col("bits")) for h in range(HASHES)))))
    near = near.withColumn("word", _word("bit"))
    tested = near.join(spark.read.parquet(f"{index_path}/{FILTERS}"), ["id", "word"]).where(F.getbit("set", F.col("bit") % WORD) == 1)
    met = tested.groupBy("id", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == HASHES).select("id").distinct()
    hit = files.join(met, "id", "left_semi").select("file")
    if not wanted.where("k IS NULL").isEmpty():
        hit = hit.unionByName(files.where("without > 0").select("file"))
    return hit.distinct()


def read_touched(spark: SparkSession, index_path: str, keys: DataFrame, key: str, schema: StructType) -> tuple[DataFrame, list[str]]:
    """The rows of the files a batch can touch, and these files (bounded by what the batch touches)."""
    files = sorted(r["file"] for r in touched_files(spark, index_path, keys, key).collect())
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return rows, files


def upsert_touched(spark: SparkSession, index_path: str, upserts: DataFrame, key: str, schema: StructType) -> tuple[DataFrame, list[str]]:
    """J1 on the touched files only: what replaces them, and their names. All other files stay as they are."""
    rows, files = read_touched(spark, index_path, upserts, key, schema)
    new = conform(upserts, rows)
    return rows.join(upserts.select(key), key, "left_anti").unionByName(new), files


def delete_touched(spark: SparkSession, index_path: str, deletes: DataFrame, key: str, schema: StructType) -> tuple[DataFrame, list[str]]:
    """J2 on the touched files only: what replaces them, and their names."""
    rows, files = read_touched(spark, index_path, deletes, key, schema)
    return rows.join(deletes.select(key), key, "left_anti"), files

