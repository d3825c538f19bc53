"""Keys with very many rows.

A window per key is one shuffle and one sort, but it gathers a key's rows in
one task.  Windows per key and time slice don't, at the price of summaries
that stitch the slices.  Most keys have few rows: they are handled whole, and
only those counted here go by slices.  Where a key goes changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnlake.session import reliable_checkpoint

#: A key with more rows than this is cut into time slices.
HOT_ROWS = 200_000


def hot_keys(rows: DataFrame, key: str, most: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than ``most`` rows, stored; None if there are none.

    Every row is counted.  There are at most (rows / ``most``) such keys, so
    the table may be broadcast.
    """
    hot = reliable_checkpoint(rows.groupBy(key).count().where(f"count > {most}").select(key))
    return None if hot.isEmpty() else hot
