"""Table state from a change log.

A change carries its log position ``(_partition, _offset)``, its operation
``op`` (``c``/``u``/``r``: the row as it is now, ``d``: the row is gone) and the
row.  The state of a key is its change with the highest position, so changes
may come in any order and any number of times: the state after a set of
changes doesn't depend on how they were dealt into batches.  Deleted keys stay
in the state as tombstones, which keep older changes that come late from
bringing the row back.

A key's changes are reduced by ``max(struct(position, ...))``, which
aggregates before the shuffle, so a key with very many changes is not
gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POSITION = ["_partition", "_offset"]


def last_changes(changes: DataFrame, key: str) -> DataFrame:
    """One row per key: its change with the highest log position."""
    rest = [c for c in changes.columns if c not in (key, *POSITION)]
    last = F.max(F.struct(*POSITION, *rest)).alias("_last")
    return changes.groupBy(key).agg(last).select(
        key, *[F.col(f"_last.{c}").alias(c) for c in [*POSITION, *rest]]).select(*changes.columns)


def merge_changes(state: DataFrame | None, changes: DataFrame, key: str) -> DataFrame:
    """The state after ``changes``; ``state`` has the same columns (tombstones included)."""
    return last_changes(changes if state is None else state.select(*changes.columns).unionByName(changes), key)


def live_rows(state: DataFrame) -> DataFrame:
    """The rows that exist, without the log's columns."""
    return state.where(F.col("op") != "d").drop("op", *POSITION)
