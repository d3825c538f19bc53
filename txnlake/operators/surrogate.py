"""Dense surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY ...)`` moves every row into one task.  Here
rows are range-partitioned on the order key and sorted inside each range;
``monotonically_increasing_id`` then numbers rows locally, per-range counts
(one row per partition, a proven-small table) give each range its offset,
and ``offset + local rank`` is the global dense rank.  The ranged data is
checkpointed first so range bounds and counts come from the same rows even
when a stage is recomputed after an executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlake.session import ensure_checkpoint_dir, reliable_checkpoint

#: Rows that are worth a range of their own.
RANGE_ROWS = 20_000


def dense_rank_keys(df: DataFrame, order_by: Sequence[str], out_col: str = "sk",
                    start_after: Column | int = 0, partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = start_after + 1..N following ``order_by`` (must be unique)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # the range-bound sampling job and the shuffle both read the input: store
    # it so its plan runs once
    src = reliable_checkpoint(df)
    n = partitions or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                 -(-src.count() // RANGE_ROWS)))
    ranged = reliable_checkpoint(src.repartitionByRange(n, *order_by)
                                    .sortWithinPartitions(*order_by)
                                    .withColumn("_pid", F.spark_partition_id())
                                    .withColumn("_mid", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is tiny by construction
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33) + 1
    start = start_after if isinstance(start_after, Column) else F.lit(start_after)
    out = ranged.join(F.broadcast(offsets), "_pid") \
                .withColumn(out_col, (start + F.coalesce(F.col("_off"), F.lit(0)) + local)
                            .cast("bigint"))
    return out.drop("_pid", "_mid", "_off")
