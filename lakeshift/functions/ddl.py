"""F8: schema -> column DDL text for table registration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def schema_ddl(schema: StructType | DataFrame) -> str:
    """Column list as DDL (``a BIGINT, b ARRAY<FLOAT>, ...``).

    ``StructType.toDDL`` quotes odd names and renders nested and decimal types
    correctly; upper-casing JSON type names by hand breaks on nested types,
    whose JSON form is an object.
    """
    if isinstance(schema, DataFrame):
        schema = schema.schema
    return schema.toDDL()
