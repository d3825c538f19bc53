"""Watermark-incremental extraction, first-copy dedupe and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit_ts(value) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp_ntz")


def changed_at(df: DataFrame, cols: Sequence[str]) -> Column:
    """Change time of a row: GREATEST over the given timestamp columns."""
    if len(cols) == 1:
        return F.col(cols[0])
    return F.greatest(*[F.col(c) for c in cols])


def incremental(df: DataFrame, since, cols: Sequence[str] = ("created_at",),
                lookback: str | None = None) -> DataFrame:
    """Rows changed strictly after the watermark ``since``.

    One scan with a pushed-down predicate; no batch loop, so ties at the
    watermark can never be split between runs.  ``lookback`` (an interval
    string such as ``'10 minutes'``) re-reads a margin for late commits;
    the insert-if-absent sink removes the re-read copies.
    """
    bound = _lit_ts(since)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    if len(cols) == 1:
        return df.where(F.col(cols[0]) > bound)
    # GREATEST(a, b) > w  <=>  a > w OR b > w (NULLs skipped); the OR form
    # keeps each side pushable to the Parquet reader.
    cond = None
    for c in cols:
        term = F.col(c) > bound
        cond = term if cond is None else (cond | term)
    return df.where(cond)


def next_watermark(df: DataFrame, current, cols: Sequence[str] = ("created_at",)) -> Column:
    """``COALESCE(MAX(change time), current)`` as an aggregate column."""
    return F.coalesce(F.max(changed_at(df, cols)), _lit_ts(current))


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (then all other columns).

    Expressed as ``min(struct(order..., rest...))`` per key: an aggregate
    with map-side partial aggregation (a sort aggregate, as the buffer is a
    struct), so a key with millions of copies is reduced inside each map task
    before the shuffle instead of being gathered into one window partition.
    All columns of ``df`` travel through it: select the needed ones first.
    Map columns can't be compared, see ``json_columns``.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.min(F.struct(*[F.col(c) for c in order_by + rest])).alias("_first")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest]) \
              .select(*df.columns)


def insert_if_absent(new: DataFrame, target: DataFrame, keys: Sequence[str],
                     order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``new`` to append: first copy per key, not already in ``target``."""
    keys = list(keys)
    batch = dedupe_first(new, keys, order_by or []) if order_by is not None else new
    return batch.join(target.select(*keys), on=keys, how="left_anti")


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind.fields)


def json_columns(df: DataFrame) -> DataFrame:
    """Columns that are or hold maps become JSON text; null stays null."""
    return df.select(*[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if _has_map(f.dataType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def same_columns(batch: DataFrame, stored: DataFrame, table: str) -> None:
    """Raise if an append would bring unknown columns or lack stored ones."""
    new, old = set(batch.columns), set(stored.columns)
    if new != old:
        raise ValueError(f"{table}: unknown columns {sorted(new - old)}, missing {sorted(old - new)}")
