"""Typed projection.

One rule table drives two outputs: the SQL text pushed to the source database
(so its JDBC driver never has to decode zero dates or tinyint(1) flags), and
the equivalent ``select`` on a DataFrame that already holds typed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions import repair as R
from lakeshift.sources.catalog import ColumnClasses


def _q(name: str, quote: str) -> str:
    return f"{quote}{name.replace(quote, quote * 2)}{quote}"


def typed_select_sql(database: str, table: str, classes: ColumnClasses, quote: str = "`") -> str:
    """P1, source side: ``SELECT CONVERT(c, CHAR) AS c, CAST(t AS DECIMAL) AS t, x FROM db.tbl``.

    datetime/date/time columns travel as text, tinyint as decimal, the rest as is.
    Names are quoted, so reserved words and odd characters survive.
    """
    as_text = set(classes.datetime) | set(classes.date) | set(classes.time)
    as_decimal = set(classes.tinyint)
    cols = []
    for c in classes.all:
        qc = _q(c, quote)
        if c in as_text:
            cols.append(f"CONVERT({qc}, CHAR) AS {qc}")
        elif c in as_decimal:
            cols.append(f"CAST({qc} AS DECIMAL) AS {qc}")
        else:
            cols.append(qc)
    if not cols:
        raise ValueError(f"no columns known for {database}.{table}")
    return f"SELECT {', '.join(cols)} FROM {_q(database, quote)}.{_q(table, quote)}"


def typed_projection(df: DataFrame, classes: ColumnClasses) -> DataFrame:
    """P1, DataFrame side: the values the source query above would hand over.

    datetime -> ``yyyy-MM-dd HH:mm:ss[.fraction]`` text, date -> ``yyyy-MM-dd``, time ->
    ``HH:mm:ss[.fraction]``, tinyint -> decimal(10,0); other columns unchanged, order kept.
    """
    types = dict(df.dtypes)
    conv: dict[str, Column] = {}
    for c in classes.datetime:
        conv[c] = F.col(c) if types.get(c) == "string" else R.datetime_text(c, types.get(c, "timestamp_ntz"))
    for c in classes.date:
        conv[c] = F.col(c) if types.get(c) == "string" else R.date_text(c, types.get(c, "date"))
    for c in classes.time:
        conv[c] = R.time_text(c, types.get(c, "timestamp_ntz"))
    for c in classes.tinyint:
        conv[c] = R.tinyint_transfer(c)
    cols = classes.all or df.columns
    return df.select([conv[c].alias(c) if c in conv else F.col(c) for c in cols])


def repairs_needed(df: DataFrame, classes: ColumnClasses) -> dict[str, list[str]]:
    """The columns whose transfer encoding the repairs (F1-F3) undo: those that
    arrive as text (dates) or decimal/boolean (tinyint). Time columns stay text,
    as in the source jobs."""
    types = dict(df.dtypes)
    return {
        "date_cols": [c for c in classes.date if types.get(c) == "string"],
        "datetime_cols": [c for c in classes.datetime if types.get(c) == "string"],
        "tinyint_cols": [c for c in classes.tinyint if c in types],
    }


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """P2."""
    return df.select(*cols)


def empty_like(df: DataFrame) -> DataFrame:
    """An empty frame with ``df``'s schema (no 'limit 1' probe query needed)."""
    return df.limit(0)


def filter_equal(df: DataFrame, **equals) -> DataFrame:
    """Equality predicates as plain filters; Spark pushes them into the
    source (parquet ``PushedFilters``, JDBC ``WHERE``)."""
    out = df
    for c, v in equals.items():
        out = out.filter(F.col(c) == F.lit(v))
    return out
