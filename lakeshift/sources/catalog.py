"""Control inputs: table list, column catalogue, and per-table column classes
(S1, S2, S8, A6, P5).

The catalogue is one row per source column, shaped like MySQL's
``information_schema.COLUMNS``. Unlike a filter on table name alone, lookups
here match schema *and* table, and columns keep their ordinal position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_LIST_SCHEMA = "database string, table string, key string"

# The column names of MySQL's information_schema.COLUMNS.
CATALOG_COLUMNS = [
    "table_schema",
    "TABLE_NAME",
    "COLUMN_NAME",
    "ORDINAL_POSITION",
    "IS_NULLABLE",
    "DATA_TYPE",
    "COLUMN_TYPE",
    "COLUMN_KEY",
    "EXTRA",
]
CATALOG_SCHEMA = (
    "table_schema string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, "
    "IS_NULLABLE string, DATA_TYPE string, COLUMN_TYPE string, COLUMN_KEY string, EXTRA string"
)

# --- Fixed values: MySQL DATA_TYPE names that need special handling. ----------
DATETIME_TYPES = ("datetime",)
DATE_TYPES = ("date",)
TIME_TYPES = ("time",)
TINYINT_TYPES = ("tinyint",)
INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "integer", "bigint")
PRIMARY_KEY = "PRI"
# ------------------------------------------------------------------------------


def read_table_list(spark: SparkSession, path: str) -> DataFrame:
    """``database,table[,key]`` CSV with a header, read with a fixed schema."""
    return spark.read.option("header", "true").schema(TABLE_LIST_SCHEMA).csv(path)


def read_column_catalog(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The extracted catalogue, CSV or parquet, with a fixed schema.

    Files written without ``ORDINAL_POSITION`` get it from file order.
    """
    if fmt == "csv":
        raw = spark.read.option("header", "true").csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    if "ORDINAL_POSITION" not in raw.columns:
        # the catalogue is small; ids grow in file order within and across its files
        raw = raw.withColumn("_at", F.monotonically_increasing_id())
        order = Window.partitionBy("table_schema", "TABLE_NAME").orderBy("_at")
        raw = raw.withColumn("ORDINAL_POSITION", F.row_number().over(order))
    cols = []
    for name, typ in [(c.split()[0], c.split()[1]) for c in CATALOG_SCHEMA.split(", ")]:
        if name in raw.columns:
            cols.append(F.col(name).cast(typ).alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    return raw.select(*cols)


def catalog_query_sql(schema_name: str) -> str:
    """The catalogue query pushed to MySQL (schema name bound as a literal)."""
    safe = schema_name.replace("'", "''")
    return (
        "SELECT table_schema, TABLE_NAME, COLUMN_NAME, ORDINAL_POSITION, IS_NULLABLE, "
        "DATA_TYPE, COLUMN_TYPE, COLUMN_KEY, EXTRA FROM information_schema.COLUMNS "
        f"WHERE table_schema = '{safe}'"
    )


def mysql_type_name(dt: T.DataType) -> tuple[str, str]:
    """(DATA_TYPE, COLUMN_TYPE) a MySQL column would report for a Spark type."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime", "datetime"
    if isinstance(dt, T.DateType):
        return "date", "date"
    if isinstance(dt, T.BooleanType):
        return "tinyint", "tinyint(1)"
    if isinstance(dt, T.ByteType):
        return "tinyint", "tinyint(4)"
    if isinstance(dt, T.ShortType):
        return "smallint", "smallint(6)"
    if isinstance(dt, T.IntegerType):
        return "int", "int(11)"
    if isinstance(dt, T.LongType):
        return "bigint", "bigint(20)"
    if isinstance(dt, T.FloatType):
        return "float", "float"
    if isinstance(dt, T.DoubleType):
        return "double", "double"
    if isinstance(dt, T.DecimalType):
        return "decimal", f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, T.StringType):
        return "varchar", "varchar(255)"
    if isinstance(dt, T.BinaryType):
        return "blob", "blob"
    return "json", "json"


def catalog_from_schema(spark: SparkSession, schema_name: str, table: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """S8 for file tables: catalogue rows derived from a DataFrame schema."""
    rows = []
    for i, f in enumerate(schema.fields, start=1):
        data_type, column_type = mysql_type_name(f.dataType)
        rows.append(
            (
                schema_name,
                table,
                f.name,
                i,
                "YES" if f.nullable else "NO",
                data_type,
                column_type,
                "PRI" if key and f.name == key else "",
                "",
            )
        )
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


@dataclass
class ColumnClasses:
    """A6 result for one table: all columns in order, and those needing repair."""

    table_schema: str
    table: str
    all: list[str] = field(default_factory=list)
    datetime: list[str] = field(default_factory=list)
    date: list[str] = field(default_factory=list)
    time: list[str] = field(default_factory=list)
    tinyint: list[str] = field(default_factory=list)
    integer_key: str | None = None  # the primary key, if it is one integer column


def column_classes_frame(catalog: DataFrame) -> DataFrame:
    """One row per (schema, table) with ordered column lists per type class.

    One aggregate over the whole catalogue instead of five filter-and-collect
    jobs per table.
    """
    ordered = F.struct(F.coalesce(F.col("ORDINAL_POSITION"), F.lit(0)).alias("pos"), F.col("COLUMN_NAME").alias("name"))
    dt = F.lower(F.col("DATA_TYPE"))

    def names(cond):
        items = F.collect_list(F.when(cond, ordered)) if cond is not None else F.collect_list(ordered)
        return F.transform(F.array_sort(items), lambda s: s["name"])

    return catalog.groupBy("table_schema", "TABLE_NAME").agg(
        names(None).alias("all_cols"),
        names(dt.isin(*DATETIME_TYPES)).alias("datetime_cols"),
        names(dt.isin(*DATE_TYPES)).alias("date_cols"),
        names(dt.isin(*TIME_TYPES)).alias("time_cols"),
        names(dt.isin(*TINYINT_TYPES)).alias("tinyint_cols"),
        names(F.col("COLUMN_KEY") == PRIMARY_KEY).alias("key_cols"),
        names((F.col("COLUMN_KEY") == PRIMARY_KEY) & dt.isin(*INTEGER_TYPES)).alias("integer_key_cols"),
    )


def column_classes(catalog: DataFrame) -> dict[tuple[str, str], ColumnClasses]:
    """A6 collected: {(schema, table): ColumnClasses}. The catalogue is metadata
    (one row per source column), so collecting it to the driver is bounded."""
    out = {}
    for r in column_classes_frame(catalog).collect():
        out[(r["table_schema"], r["TABLE_NAME"])] = ColumnClasses(
            r["table_schema"],
            r["TABLE_NAME"],
            list(r["all_cols"]),
            list(r["datetime_cols"]),
            list(r["date_cols"]),
            list(r["time_cols"]),
            list(r["tinyint_cols"]),
            r["key_cols"][0] if len(r["key_cols"]) == 1 and r["integer_key_cols"] else None,
        )
    return out


def classes_from_schema(schema_name: str, table: str, schema: T.StructType, key: str | None = None) -> ColumnClasses:
    """A6 for a table whose catalogue is its own DataFrame schema: the same
    classes :func:`column_classes` would give for :func:`catalog_from_schema`,
    computed on the driver because no data is involved."""
    cls = ColumnClasses(schema_name, table, [f.name for f in schema.fields])
    for f in schema.fields:
        data_type, _ = mysql_type_name(f.dataType)
        if data_type in DATETIME_TYPES:
            cls.datetime.append(f.name)
        elif data_type in DATE_TYPES:
            cls.date.append(f.name)
        elif data_type in TIME_TYPES:
            cls.time.append(f.name)
        elif data_type in TINYINT_TYPES:
            cls.tinyint.append(f.name)
        if f.name == key and data_type in INTEGER_TYPES:
            cls.integer_key = key
    return cls
