"""Change-feed operators: split, count, stamp, and apply by key.

The target is any DataFrame (usually the current snapshot); every apply returns
the new table contents as a DataFrame, which the caller writes as a new
snapshot (parquet tables cannot be rewritten in place while being read).

Keys
----
A row whose key has a null part is identified by its whole content: it matches
no other row, an upsert adds it unless it is there already, and a delete finds
nothing. So no such row is lost, and applying a batch twice equals applying it
once. Single and composite keys follow the same rule.

Scale notes
-----------
* Each apply is one anti-join of the target with the changed keys. Whether the
  keys are broadcast is left to the planner and AQE, which know their measured
  size (``spark.sql.autoBroadcastJoinThreshold``).
* A batch is reduced to one row per key by an aggregate, not a window: Spark
  pre-aggregates it on the map side, so one key that carries a third of all
  changes still leaves each map task as a single row. Changes without a full key
  go through the same aggregate, one row per content.
* The feed is read once: both uses of the reduced batch (the keys that leave the
  target, the rows that enter it) need all its columns, so their plans share one
  exchange. With ``stage_dir`` the reduced batch is written once and read back.
  ``apply_latest`` runs no job of its own; ``apply_changes`` runs one, which looks
  for repeated keys.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: change-feed conventions of the replication tool. -----------
OP_COLUMN = "Op"
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"
METADATA_COLUMNS = ("Op", "schema_name", "table_name")
CHANGE_TS_COLUMN = "update_ts_dms"
APPLIED_TS_COLUMN = "last_applied_date"
# ------------------------------------------------------------------------------


class DuplicateKeyError(ValueError):
    """An upsert batch holds a key more than once (a MERGE would reject it)."""


def _keys(key: str | Iterable[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def drop_metadata(feed: DataFrame, cols: Iterable[str] = METADATA_COLUMNS) -> DataFrame:
    """Drop the feed's bookkeeping columns; names not present are ignored."""
    return feed.drop(*cols)


def split_changes(feed: DataFrame, op_col: str = OP_COLUMN) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes). A null op goes to neither side (SQL three-valued logic)."""
    op = F.col(op_col)
    return feed.filter(op != OP_DELETE), feed.filter(op == OP_DELETE)


def op_counts(feed: DataFrame, op_col: str = OP_COLUMN) -> DataFrame:
    """A2: rows per change op in one aggregate (null ops get their own row)."""
    return feed.groupBy(F.col(op_col).alias("Op")).agg(F.count(F.lit(1)).alias("n"))


def stamp_changes(
    feed: DataFrame,
    run_ts,
    ts_col: str = CHANGE_TS_COLUMN,
    applied_col: str = APPLIED_TS_COLUMN,
) -> DataFrame:
    """F4 + F5: parse the change-time text and stamp the run time, in one projection."""
    from lakeshift.functions.repair import change_timestamp, run_timestamp

    cols = {applied_col: run_timestamp(run_ts)}
    if ts_col in feed.columns:
        cols[ts_col] = change_timestamp(ts_col)
    return feed.withColumns(cols)


def conform(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Rows in the target's column order and types (what ``INSERT *`` / ``SET *`` need)."""
    missing = [c for c in target.columns if c not in rows.columns]
    if missing:
        raise ValueError(f"change rows lack target columns {missing}")
    return rows.select([F.col(c).cast(t).alias(c) for c, t in target.dtypes])


def _keyless(rows: DataFrame, key: list[str]) -> Column:
    """Whether any part of a row's key is null."""
    out = F.col(key[0]).isNull()
    for k in key[1:]:
        out = out | F.col(k).isNull()
    return out


def _content(cols: list[str], types: dict[str, str]) -> Column:
    """A row's content as one comparable value (maps are not comparable, their JSON is)."""
    row = F.struct(*(F.col(f"`{c}`") for c in cols))
    return F.to_json(row, {"ignoreNullFields": "false"}) if any("map<" in types[c] for c in cols) else row


def _with_new_keyless(out: DataFrame, target: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """``out`` plus the rows (without a full key, each content once) that the target does not hold yet."""
    held = target.filter(_keyless(target, key))
    types = dict(target.dtypes)
    held = held.select(_content(target.columns, types).alias("__held"))
    new = conform(rows, target).withColumn("__content", _content(target.columns, types))
    new = new.join(held, F.col("__content").eqNullSafe(F.col("__held")), "left_anti").drop("__content")
    return out.unionByName(new)


def _per_key(feed: DataFrame, key: list[str], content: list[str], aggregates: list[Column]) -> DataFrame:
    """One row per key, and one per content (``__content``) of the rows without a full key."""
    missing = [c for c in content if c not in feed.columns]
    if missing:
        raise ValueError(f"change rows lack target columns {missing}")
    types = dict(feed.dtypes)
    own = F.when(_keyless(feed, key), _content(content, types)).alias("__content")
    return feed.groupBy(*(F.col(f"`{k}`") for k in key), own).agg(*aggregates)


def upsert(target: DataFrame, upserts: DataFrame, key: str | Iterable[str]) -> DataFrame:
    """Matched keys take the new row whole, unmatched keys are inserted.

    ``upserts`` must hold each key at most once (see :func:`apply_changes`).
    """
    key = _keys(key)
    rows = conform(upserts.filter(~_keyless(upserts, key)), target)
    out = target.join(rows.select(*key), on=key, how="left_anti").unionByName(rows)
    types = dict(target.dtypes)
    # one row per content, with what map columns hold
    without = conform(upserts.filter(_keyless(upserts, key)), target)
    once = without.groupBy(_content(target.columns, types).alias("__c")).agg(F.first(F.struct(*target.columns)).alias("__row"))
    return _with_new_keyless(out, target, once.select("__row.*"), key)


def delete(target: DataFrame, deletes: DataFrame, key: str | Iterable[str]) -> DataFrame:
    """Remove target rows whose key appears in ``deletes``."""
    key = _keys(key)
    return target.join(deletes.select(*key), on=key, how="left_anti")


def _staged(df: DataFrame, stage_dir: str | None) -> DataFrame:
    if not stage_dir:
        return df
    df.write.mode("overwrite").parquet(stage_dir)
    return df.sparkSession.read.schema(df.schema).parquet(stage_dir)


def apply_changes(
    target: DataFrame,
    feed: DataFrame,
    key: str | Iterable[str],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
    stage_dir: str | None = None,
) -> DataFrame:
    """All upserts (op != D) merged first, then all deletes.

    Same outcome as the two MERGE statements it replaces, including their order:
    a key deleted and re-inserted in one batch ends deleted. Several upserts for
    one key raise :class:`DuplicateKeyError`, as MERGE would.

    The batch becomes one row per key (its upsert, if any, and whether a delete
    occurs); the target is then joined once, with all changed keys.
    """
    key = _keys(key)
    per_key = _staged(batch_per_key(feed, key, target.columns, op_col=op_col, drop_cols=drop_cols), stage_dir)
    require_unique(per_key, key)
    keyed, row = F.col("__content").isNull(), F.col("__row")
    shown = [*key, *(row[c].alias(c) for c in target.columns if c not in key)]
    changed = per_key.filter(keyed & (row.isNotNull() | (F.col("__dels") > 0)))  # all of them: see the notes above
    rows = per_key.filter(keyed & (F.col("__ups") == 1) & (F.col("__dels") == 0)).select(*shown)
    out = target.join(changed.select(*key), on=key, how="left_anti").unionByName(conform(rows, target))
    return _with_new_keyless(out, target, per_key.filter(~keyed).select(*shown), key)


def batch_per_key(
    feed: DataFrame,
    key: str | Iterable[str],
    columns: list[str],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
) -> DataFrame:
    """A feed reduced for J3: ``key``, ``__content`` (null; for an upsert without a full key
    what its ``columns`` hold), how many upserts and deletes it has, and an upsert's row."""
    key = _keys(key)
    is_up = F.col(op_col) != OP_DELETE  # null for a null op
    payload = [c for c in feed.columns if c not in key and c not in set(drop_cols)]
    known = feed.filter(F.col(op_col).isNotNull() & (is_up | ~_keyless(feed, key)))  # a delete without a key finds nothing
    return _per_key(known, key, columns, [
        F.count_if(is_up).alias("__ups"),
        F.count_if(~is_up).alias("__dels"),
        F.any_value(F.when(is_up, F.struct(*payload) if payload else F.struct(F.lit(1))), True).alias("__row"),
    ])


def require_unique(per_key: DataFrame, key: list[str]) -> None:
    """Raise if a batch holds several upserts of one key (rows without a full key are no repetition)."""
    repeated = per_key.filter(F.col("__content").isNull() & (F.col("__ups") > 1)).select(*key, "__ups").limit(5).collect()
    if repeated:
        raise DuplicateKeyError(f"upsert batch repeats keys, e.g. {repeated}; use apply_latest to resolve several changes per key")


def latest_changes(
    feed: DataFrame,
    key: str | Iterable[str],
    order_by: Iterable[str | Column],
) -> DataFrame:
    """One row per key: the change that sorts last by ``order_by``.

    ``order_by`` must make the order total within a key (change time, then a
    sequence or id as tie-break); with a tie the pick is arbitrary.
    Implemented as ``max_by`` so it is partially aggregated before the shuffle.
    """
    key = _keys(key)
    return feed.groupBy(*key).agg(_last(feed, key, order_by)).select(*key, "__last.*")


def _last(feed: DataFrame, key: list[str], order_by: Iterable[str | Column]) -> Column:
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    payload = [c for c in feed.columns if c not in key]
    return F.max_by(F.struct(*payload), F.struct(*order)).alias("__last")


def reduced_changes(
    feed: DataFrame,
    key: str | Iterable[str],
    order_by: Iterable[str | Column],
    columns: list[str],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
) -> DataFrame:
    """A feed reduced for J4: ``key``, ``__content`` (null; for an upsert without a full
    key what its ``columns`` hold) and ``__last``, the change that counts, as a struct.
    Changes of unknown kind and deletes without a key are left out."""
    key, order_by = _keys(key), list(order_by)
    known = feed.filter(F.col(op_col).isNotNull() & ((F.col(op_col) != OP_DELETE) | ~_keyless(feed, key)))
    if all(isinstance(c, str) for c in order_by):
        # bookkeeping columns need not travel through the shuffle
        early = [c for c in drop_cols if c != op_col and c not in order_by and c not in key and c not in columns]
        known = known.drop(*early)
    return _per_key(known, key, columns, [_last(known, key, order_by)])


def apply_latest(
    target: DataFrame,
    feed: DataFrame,
    key: str | Iterable[str],
    order_by: Iterable[str | Column],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
    stage_dir: str | None = None,
) -> DataFrame:
    """Reduce the batch to the last change per key, then apply it once.

    A key whose last change is a delete is removed; any other last change
    replaces (or inserts) the row. Unlike :func:`apply_changes`, order within
    the batch decides, and repeated keys are fine.

    With ``stage_dir`` (a folder in shared storage) the reduced changes are
    written there once and read back: the reduction - a shuffle of the whole
    batch - runs once, and the lineage of the result starts at the staged copy.
    The caller removes the folder once the result is written.

    Order counts within a batch only: a change that arrives in a later batch
    replaces the row whatever its change time.
    """
    key = _keys(key)
    last = _staged(reduced_changes(feed, key, order_by, target.columns, op_col=op_col, drop_cols=drop_cols), stage_dir)
    return apply_reduced(target, last, key, op_col=op_col)


def apply_reduced(target: DataFrame, last: DataFrame, key: str | Iterable[str], *, op_col: str = OP_COLUMN) -> DataFrame:
    """J4 with what :func:`reduced_changes` made of the feed."""
    key = _keys(key)
    keyed, change = F.col("__content").isNull(), F.col("__last")
    inside = last.schema["__last"].dataType.names
    rows = last.select("__content", *key, *(change[c].alias(c) for c in inside))
    upserts = rows.filter(keyed & (F.col(op_col) != OP_DELETE))
    changed = last.filter(keyed & change.isNotNull())  # always so; it keeps this side's plan equal to the other's
    out = target.join(changed.select(*key), on=key, how="left_anti").unionByName(conform(upserts, target))
    return _with_new_keyless(out, target, rows.filter(~keyed), key)


# -- J4 across batches ---------------------------------------------------------
ORDER_COLUMN = "__order"
DELETED_COLUMN = "__deleted"


def with_order(rows: DataFrame, order_by: Iterable[str], types: dict[str, str]) -> DataFrame:
    """Rows of a plain table as the first state of an ordered one: older than any change.
    ``types`` are those of the feed's ``order_by`` columns."""
    order = ", ".join(f"`{c}`: {types[c]}" for c in order_by)
    return rows.withColumns({ORDER_COLUMN: F.lit(None).cast(f"struct<{order}>"), DELETED_COLUMN: F.lit(False)})


def visible(state: DataFrame) -> DataFrame:
    """The table an ordered state stands for: no tombstones, no bookkeeping."""
    return state.filter(~F.col(DELETED_COLUMN)).drop(ORDER_COLUMN, DELETED_COLUMN)


def apply_ordered(
    state: DataFrame,
    feed: DataFrame,
    key: str | Iterable[str],
    order_by: Iterable[str],
    *,
    op_col: str = OP_COLUMN,
    drop_cols: Iterable[str] = METADATA_COLUMNS,
    stage_dir: str | None = None,
) -> DataFrame:
    """J4 where the order of changes counts across batches, whatever batch they come in.

    Each row of the state carries the place of its last change (``__order``), and a
    deleted key stays as a tombstone (``__deleted``, with nulls beside the key). A
    change that is not later than what the key has loses, so a late older change does
    nothing, a deleted key does not come back, and a replayed batch changes nothing.
    Rows without a full key are added unless there, as in :func:`apply_latest`.

    The state is read twice: only key and order of the changed keys to find the
    changes that win, then once for the result. ``drop_tombstones`` bounds their number.
    """
    key, order_by = _keys(key), list(order_by)
    columns = [c for c in state.columns if c not in (ORDER_COLUMN, DELETED_COLUMN)]
    last = _staged(reduced_changes(feed, key, order_by, columns, op_col=op_col, drop_cols=drop_cols), stage_dir)
    keyed, change = F.col("__content").isNull(), F.col("__last")
    gone = change[op_col] == OP_DELETE
    place = F.struct(*((F.col(c) if c in key else change[c]).alias(c) for c in order_by))
    rows = last.select(
        "__content",
        *key,
        *(F.when(~gone, change[c]).alias(c) for c in columns if c not in key),
        place.alias(ORDER_COLUMN),
        gone.alias(DELETED_COLUMN),
    )
    keyless, rows = rows.filter(~keyed).drop("__content"), rows.filter(keyed).drop("__content")
    held = state.join(rows.select(*key), key, "left_semi").select(*key, F.col(ORDER_COLUMN).alias("__held"))
    winners = rows.join(held, key, "left").filter(F.col("__held").isNull() | (F.col("__held") < F.col(ORDER_COLUMN))).drop("__held")
    out = state.join(winners.select(*key), key, "left_anti").unionByName(conform(winners, state))
    new = _with_new_keyless(visible(state).limit(0), visible(state), visible(keyless), key)
    return out.unionByName(conform(with_order(new, order_by, dict(feed.dtypes)), state))


def drop_tombstones(state: DataFrame, before: Column) -> DataFrame:
    """The state without tombstones for which ``before`` (over ``__order``) holds: no change as old as these can still come."""
    return state.filter(~(F.col(DELETED_COLUMN) & before))
