"""Operator 5, sharding: minimax contiguous partition of atomic groups.

Equal texts form one atomic group.  Groups are ordered by their first doc_id
and cut into contiguous runs, one per shard, so that the largest run is as
small as possible.  The smallest feasible capacity is found by binary search
with a greedy check; the cuts are then made within that capacity, each as
near to an even share of the rest as feasibility allows.

Only DataFrame functions touch rows.  The ordered groups are range
partitioned and stored once with their partition number; running sums within
partitions plus partition offsets give every group's border (the bytes up to
its end).  The driver never sees the groups: the search runs on a summary of
at most ``summary_rows`` buckets of borders (count, least, greatest border).
Greedy steps on it are bounded from both sides, and as long as the two sides
disagree on the capacity, the buckets that matter are split finer and read
again.  Exact borders are looked up by small aggregates.

Defined cases: a null text has one byte (its end) and forms the group of null
texts; empty texts likewise.  Rows equal in doc_id and text are counted
apart; null doc_ids sort first.  An empty table gives no row.  Extra columns
are ignored.  More shards than groups leave some shards empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.llm.common import read_table, ready, store, text_digest


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` range-partitioned by ``by``, stored with the partition number ``pid``."""
    n = _partitions(df.sparkSession)
    return store(df.repartitionByRange(n, *by).withColumn("pid", F.spark_partition_id()), name)


def with_border(groups: DataFrame, by: list[str], value: str) -> DataFrame:
    """Add ``border``: the running sum of ``value`` in the order of ``by`` over all partitions."""
    totals = groups.groupBy("pid").agg(F.sum(value).alias("part"))
    # one row per range partition: this window and broadcast are small by construction
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pid", F.coalesce(F.sum("part").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("pid").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    return (groups.join(F.broadcast(offsets), "pid")
            .withColumn("border", F.col("before") + F.sum(value).over(within)).drop("before"))


class Borders:
    """Bounded view of the stored borders: buckets refined where it matters."""

    def __init__(self, table: DataFrame, total: int, summary_rows: int):
        self.table, self.total, self.rows = table, total, summary_rows
        self.exact: dict[tuple[int, bool], int] = {}
        self.width = total
        self.read([(0, total)])

    def read(self, spans: list[tuple[int, int]]) -> None:
        """Summarise the borders in ``spans`` (sorted, apart) in about ``summary_rows`` buckets.

        Buckets are at most half as wide as before, so reading on comes to an end.
        """
        width = self.width = max(1, min(-(-sum(b - a + 1 for a, b in spans) // self.rows),
                                        self.width // 2))
        near = F.lit(False)
        for a, b in spans:
            near = near | F.col("border").between(a, b)
        found = (self.table.where(near).groupBy(F.expr(f"border div {width}").alias("k"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min("border").alias("lo"),
                      F.max("border").alias("hi")).orderBy("k").collect())
        edges = {0, self.total} | {x for a, b in spans for x in (self.lookup(a, True),
                                                                 self.lookup(b, False))}
        marks = sorted({(r.lo, r.hi, r.n) for r in found} | {
            (e, e, 1) for e in edges if not any(r.lo <= e <= r.hi for r in found)})
        self.lo, self.hi = [m[0] for m in marks], [m[1] for m in marks]
        self.fine = [m[2] <= 2 for m in marks]

    def lookup(self, at: int, below: bool) -> int:
        """Exactly the last border <= ``at`` or the first >= ``at``."""
        if at <= 0 or at >= self.total:
            return 0 if at <= 0 else self.total
        key = (at, below)
        if key not in self.exact:
            side = F.max("border") if below else F.min("border")
            test = F.col("border") <= at if below else F.col("border") >= at
            self.exact[key] = self.table.where(test).agg(side).first()[0] or 0
        return self.exact[key]

    def last(self, at: int) -> tuple[int, int]:
        """Bounds on the last border <= ``at``."""
        k = bisect_right(self.lo, at) - 1
        if at >= self.hi[k]:
            return self.hi[k], self.hi[k]
        if self.fine[k]:
            return self.lo[k], self.lo[k]
        return self.lo[k], min(at, self.hi[k])


def _greedy(borders: Borders, capacity: int, shards: int, side: int) -> list[int]:
    """Cuts of the greedy check on one side of the bounds; stops where no group fits."""
    cuts = [0]
    for _ in range(shards):
        step = borders.last(cuts[-1] + capacity)[side]
        if step <= cuts[-1]:
            break
        cuts.append(step)
    return cuts


def least_capacity(borders: Borders, largest: int, shards: int) -> int:
    """Smallest capacity for which the greedy check needs at most ``shards`` runs."""
    total = borders.total
    low, high = max(largest, -(-total // shards)), total

    def search(side: int, a: int, b: int) -> int:
        while a < b:
            mid = (a + b) // 2
            if _greedy(borders, mid, shards, side)[-1] >= total:
                b = mid
            else:
                a = mid + 1
        return a

    while low < high:
        high = search(0, low, high)  # surely feasible from here on
        low = search(1, low, high)   # surely infeasible below
        if low >= high:
            break
        early, late = _greedy(borders, low, shards, 0), _greedy(borders, high, shards, 1)
        late += [total] * (len(early) - len(late))
        early += early[-1:] * (len(late) - len(early))  # where no step was sure
        spans: list[tuple[int, int]] = []
        for a, b in zip(early, late):
            a, b = min(a, b), max(a, b)
            if spans and a <= spans[-1][1] + 1:
                spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
            else:
                spans.append((a, b))
        borders.read(spans)
    return high


def balanced_cuts(borders: Borders, capacity: int, shards: int) -> list[int]:
    """Ends of the runs: no run over ``capacity``, each near an even share of the rest."""
    total = borders.total
    least = [total]  # the earliest end of each run that leaves a feasible rest
    for _ in range(shards - 1):
        least.append(borders.lookup(max(0, least[-1] - capacity), False))
    least.reverse()
    cuts, start = [], 0
    for k in range(shards):
        target = start + (total - start) // (shards - k)
        below, above = borders.lookup(target, True), borders.lookup(target, False)
        cut = below if target - below <= above - target else above
        most = borders.lookup(start + capacity, True)
        start = min(max(cut, least[k], start), most)
        cuts.append(start)
    return cuts


def shard_by_bytes(docs: DataFrame, shards: int = 16, summary_rows: int = 50_000) -> DataFrame:
    """``docs(doc_id, text)`` -> doc_id, size, text_crc32, th, shard, slot."""
    rows = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.coalesce(text_digest(F.col("text")), F.lit(b"")).alias("th"))
    rows = store(rows.withColumn("size", F.col("bytes") + 1).drop("bytes"), "op5-rows")
    groups = rows.groupBy("th").agg(F.min("doc_id").alias("first"), F.sum("size").alias("bytes"))
    order = ["first", "th"]
    table = store(with_border(ranked(groups, order, "op5-groups"), order, "bytes"), "op5-borders")
    total, largest = table.agg(F.max("border"), F.max("bytes")).first()
    if total is None:
        cuts = [0] * shards
    else:
        borders = Borders(table.select("border"), total, summary_rows)
        cuts = balanced_cuts(borders, least_capacity(borders, largest, shards), shards)
    shard = sum((F.col("border") > c).cast("int") for c in cuts[:-1]) if shards > 1 else F.lit(0)
    placed = rows.join(table.select("th", shard.alias("shard")), "th")
    by = ["shard", "doc_id", "th", "seq"]
    # the row number in the file only tells apart rows that are equal in all else
    spread = ranked(placed.withColumn("seq", F.monotonically_increasing_id()), by, "op5-placed")
    counts = spread.groupBy("shard", "pid").agg(F.count(F.lit(1)).alias("n"))
    # at most shards x partitions rows
    before = (Window.partitionBy("shard").orderBy("pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    local = F.row_number().over(Window.partitionBy("shard", "pid").orderBy("doc_id", "th", "seq"))
    return (spread.join(F.broadcast(offsets), ["shard", "pid"])
            .select("doc_id", "size", "text_crc32", "th", "shard",
                    (F.col("off") + local - 1).cast("long").alias("slot")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 by the ``bytes`` law."""
    ready(spark)
    out = shard_by_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
