"""M1/M2: proof that the values written are the values read.

Each column has an order-independent hash of its multiset of values: two sums of 26
bits of every value's 64-bit hash, and the number of nulls. It is gathered by the write
itself (an ``Observation``), and by one aggregate over any other copy of the rows. Equal
multisets have equal hashes; a changed value shows in its column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Bits of a hash that go into each of the two sums: 2^37 rows fit 63 bits.
BITS = 26

Proof = dict[str, tuple[int, int, int]]  # column -> nulls, both sums


def _value(name: str, kind: str) -> Column:
    c = F.col(f"`{name}`")
    if "map<" in kind or "variant" in kind:
        return F.to_json(F.struct(c.alias("v")))  # neither can be hashed
    if kind in ("float", "double"):
        return F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c)  # 0.0 and -0.0 are equal
    return c


def proof_aggregates(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Three aggregates per column, named ``n<i>``, ``a<i>`` and ``b<i>``."""
    kinds = dict(df.dtypes)
    out = []
    for i, name in enumerate(df.columns if columns is None else columns):
        value = _value(name, kinds[name])
        h = F.xxhash64(value)
        mask = F.lit((1 << BITS) - 1)
        shown = F.col(f"`{name}`").isNotNull()
        out += [
            F.count_if(~shown).alias(f"n{i}"),
            F.coalesce(F.sum(F.when(shown, h.bitwiseAND(mask))), F.lit(0)).alias(f"a{i}"),
            F.coalesce(F.sum(F.when(shown, F.shiftright(h, BITS).bitwiseAND(mask))), F.lit(0)).alias(f"b{i}"),
        ]
    return out


def _proof(columns: list[str], row: dict) -> Proof:
    return {c: (int(row[f"n{i}"]), int(row[f"a{i}"]), int(row[f"b{i}"])) for i, c in enumerate(columns)}


def proof_of(df: DataFrame, columns: list[str] | None = None) -> Proof:
    """The proof of a frame's columns, in one aggregate."""
    columns = df.columns if columns is None else columns
    return _proof(columns, df.agg(*proof_aggregates(df, columns)).first().asDict()) if columns else {}


def observe_proof(df: DataFrame, observation: Observation, columns: list[str] | None = None) -> DataFrame:
    """``df`` with its proof gathered by the next action on it; read it by :func:`observed_proof`."""
    return df.observe(observation, *(proof_aggregates(df, columns) or [F.count(F.lit(1)).alias("rows")]))


def observed_proof(observation: Observation, columns: list[str]) -> Proof:
    return _proof(columns, observation.get)


def differing_columns(a: Proof, b: Proof) -> list[str]:
    """Columns that do not hold the same values, or are in one of the two only."""
    return [c for c in [*a, *(c for c in b if c not in a)] if a.get(c) != b.get(c)]
