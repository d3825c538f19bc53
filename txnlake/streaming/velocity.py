"""Velocity rule as a checkpointed stateful stream.

The window of an account is defined by arrival: after event k (time t_k) the
entries that arrived earlier and are older than ``t_k - W`` leave from the
front, up to the first entry that is not; k's count and sum are over the
entries still held whose time is ``t_k - W`` or later (later-dated ones count,
too).  So event k looks at an index range [front_k, k], whose left end only
moves on, and at the times from a cutoff up.

Input in time order, the normal case, needs no inner look-up: the range is
exactly the window, and its sum is a difference of two running totals.  For
input out of time order the held entries are kept in a Fenwick tree over the
ranks of their times: an arrival adds, a departure subtracts, and the total
from a cutoff up is read in O(log n).  Either way a micro-batch costs time in
proportion to its events, whatever the window holds.

State per account lies in the RocksDB state store (checkpointed, survives
restarts and executor loss) on two levels: the held entries in chunks of
consecutive arrivals, and a summary per chunk (count, total, earliest and
latest time).  A micro-batch reads the summaries.  A chunk whose earliest time
is inside the window of every new event counts as a whole, for each of them,
and is neither read nor written; only chunks in which some entry may leave or
not count are opened.  So a batch's state traffic follows what arrives and what
leaves, not what the window holds.  Accounts that are idle for a time to live
(optional) lose their state by a timer.  With ``lateness_seconds``
the stream keeps an event-time watermark: events older than it count nowhere
and go to the side table ``late``, and a timer per account clears its state
once the watermark has passed everything that its entries can count for.  Rule, bucket labels and
flag ids are the batch functions applied to the operator's output; flags are
written insert-if-absent per micro-batch and alerts per batch id, so a
replayed batch rewrites the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from itertools import accumulate, takewhile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from txnlake import config
from txnlake.functions.scalar import micros_to_ts
from txnlake.session import ship_package
from txnlake.operators import velocity as batch_velocity
from txnlake.sources import cdc
from txnlake.sources.tables import VersionedTable, path_exists

CHUNK_KEY = "chunk LONG"
SUMMARY_SCHEMA = "n LONG, total STRING, low LONG, high LONG"
ENTRIES_SCHEMA = "ts_us ARRAY<LONG>, amounts ARRAY<STRING>"
#: Entries per chunk: what a batch reads and writes beyond its own rows is a few chunks.
CHUNK = 512
OUTPUT_SCHEMA = ("seq LONG, id STRING, account_id STRING, currency STRING, amount DECIMAL(20,6), "
                 "ts_us LONG, count_5m LONG, sum_5m DECIMAL(38,6)")
OUTPUT_COLUMNS = ["seq", "id", "account_id", "currency", "amount", "ts_us"]
LATE_COLUMNS = ["seq", "id", "account_id", "currency", "amount", "created_at"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RankedTotals:
    """Fenwick tree: count and amount of held entries by the rank of their time."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.counts = [0] * (size + 1)
        self.totals = [0] * (size + 1)
        self.held = 0
        self.amount = 0

    def change(self, rank: int, count: int, amount: int) -> None:
        self.held += count
        self.amount += amount
        node = rank + 1
        while node <= self.size:
            self.counts[node] += count
            self.totals[node] += amount
            node += node & -node

    def from_rank(self, rank: int) -> tuple[int, int]:
        """Count and amount of the entries at ``rank`` or above."""
        n, total, node = self.held, self.amount, rank
        while node > 0:
            n -= self.counts[node]
            total -= self.totals[node]
            node -= node & -node
        return n, total


def window_totals(times: Sequence[int], amounts: Sequence[int], known: int,
                  width: int, barrier: int | None = None) -> tuple[list[int], list[int], int]:
    """Counts and amounts for the entries from index ``known`` on, and the final front.

    ``times`` and ``amounts`` are in arrival order, the first ``known`` held from before.
    Entries from index ``barrier`` on can't leave: one that stays stands before them.
    """
    t = np.asarray(times, dtype=np.int64)
    cut = t[known:] - width
    if len(t) < 2 or bool((t[1:] >= t[:-1]).all()):
        front = np.searchsorted(t, cut, "left")
        running = [0, *accumulate(amounts)]
        last = range(known + 1, len(t) + 1)
        return ([e - f for e, f in zip(last, front.tolist())],
                [running[e] - running[f] for e, f in zip(last, front.tolist())],
                min(int(front[-1]) if len(front) else 0, len(t) if barrier is None else barrier))
    order = np.unique(t)
    rank = np.searchsorted(order, t).tolist()
    floor = np.searchsorted(order, cut, "left").tolist()
    tree = RankedTotals(len(order))
    for k in range(known):
        tree.change(rank[k], 1, amounts[k])
    counts, sums, front = [], [], 0
    for k, low in enumerate(floor, known):
        tree.change(rank[k], 1, amounts[k])
        for gone in takewhile(lambda i, low=low: rank[i] < low,
                              range(front, k if barrier is None else min(k, barrier))):
            tree.change(rank[gone], -1, -amounts[gone])
            front = gone + 1
        n, total = tree.from_rank(low)
        counts.append(n)
        sums.append(total)
    return counts, sums, front


class TrailingWindowProcessor(StatefulProcessor):
    """Keyed trailing window (count, sum)."""

    def __init__(self, window_seconds: int, idle_ttl_seconds: int | None = None, chunk: int = CHUNK) -> None:
        self.width = window_seconds * 1_000_000
        self.ttl_ms = idle_ttl_seconds * 1000 if idle_ttl_seconds else None
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.summaries = handle.getMapState("window", CHUNK_KEY, SUMMARY_SCHEMA)
        self.entries = handle.getMapState("entries", CHUNK_KEY, ENTRIES_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield self._advance(_together(rows))[0]
        if self.ttl_ms:
            self._only_timer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.summaries.clear()
        self.entries.clear()
        return iter(())

    def _only_timer(self, at_ms: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at_ms)

    def _advance(self, batch: pd.DataFrame) -> tuple[pd.DataFrame, int | None, int]:
        """The batch with its windows, and the latest time held before and after it.

        Chunks that it can't change stay closed.  Every call to the state store is
        a message, so what is in memory is not asked for again.
        """
        if not batch["seq"].is_monotonic_increasing:
            batch = batch.sort_values("seq", kind="stable", ignore_index=True)
        new_times = batch["ts_us"].tolist()
        new_amounts = [_micros(a) for a in batch["amount"].tolist()]
        summaries = {int(k[0]): v for k, v in self.summaries.iterator()}
        last_cut = max(new_times) - self.width
        opened = [c for c in sorted(summaries) if summaries[c][2] < last_cut]
        closed = sorted(set(summaries) - set(opened))
        times, amounts, ends = [], [], []
        barrier = None
        for c in opened:
            if barrier is None and closed and c > closed[0]:
                barrier = len(times)
            t, x = self.entries.getValue((c,))
            times += [int(v) for v in t]
            amounts += [int(v) for v in x]
            ends.append(len(times))
        known = len(times)
        if barrier is None and closed:
            barrier = known
        counts, sums, front = window_totals(times + new_times, amounts + new_amounts, known, self.width, barrier)
        whole = sum(summaries[c][0] for c in closed)
        total = sum(int(summaries[c][1]) for c in closed)
        gone = max(0, front - known)
        last = max(summaries, default=-1)
        tail, start = None, 0
        for c, end in zip(opened, ends):
            left = max(start, front)
            # new entries fill the last chunk up, if it is still there
            if c == last and end > front and gone < len(new_times) and end - left < self.chunk:
                tail = times[left:end], amounts[left:end]
            elif end <= front:
                self.summaries.removeKey((c,))
                self.entries.removeKey((c,))
            elif start < front:
                self._store(c, times[front:end], amounts[front:end])
            start = end
        if tail is None and last in closed and gone < len(new_times) and summaries[last][0] < self.chunk:
            t, x = self.entries.getValue((last,))
            tail = [int(v) for v in t], [int(v) for v in x]
        self._append(last + 1 if tail is None else last, *(tail or ([], [])), new_times[gone:], new_amounts[gone:])
        before = max((int(v[3]) for v in summaries.values()), default=None)
        out = batch[OUTPUT_COLUMNS].assign(
            count_5m=np.array([whole + n for n in counts], dtype=np.int64),
            sum_5m=[_decimal(total + x) for x in sums])
        return out, before, max(new_times) if before is None else max(before, *new_times)

    def _append(self, number: int, times: list[int], amounts: list[int],
                new_times: list[int], new_amounts: list[int]) -> None:
        """Store new entries from chunk ``number`` on, after those that it holds."""
        times, amounts = times + new_times, amounts + new_amounts
        for c, at in enumerate(range(0, len(times), self.chunk), number):
            self._store(c, times[at:at + self.chunk], amounts[at:at + self.chunk])

    def _store(self, chunk: int, times: list[int], amounts: list[int]) -> None:
        self.summaries.updateValue((chunk,), (len(times), str(sum(amounts)), min(times), max(times)))
        self.entries.updateValue((chunk,), (times, [str(x) for x in amounts]))

    def close(self) -> None:
        pass


class WatermarkedWindowProcessor(TrailingWindowProcessor):
    """The window over events that are not behind the watermark; late ones pass through, marked.

    The one timer of an account lies where the watermark has left the window
    of its latest entry: no event that is still on time can count any of them.
    The latest entry never leaves, so the timer follows from the summaries.
    """

    def _timer(self, latest: int) -> int:
        return (latest + self.width) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _together(rows)
        # 0 until a batch has set the watermark
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        late = batch["ts_us"].to_numpy() < mark if mark > 0 else np.zeros(len(batch), dtype=bool)
        if late.any():
            yield batch[late].assign(count_5m=None, sum_5m=None, late=True)
            batch = batch[~late].reset_index(drop=True)
        if len(batch):
            out, before, after = self._advance(batch)
            yield out.assign(late=False)
            if before != after:
                if before is not None:
                    self.handle.deleteTimer(self._timer(before))
                self.handle.registerTimer(self._timer(after))


def _together(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = list(rows)
    return frames[0].reset_index(drop=True) if len(frames) == 1 else pd.concat(frames, ignore_index=True)


def _micros(amount: Decimal) -> int:
    """An amount with at most six decimals as a whole number of millionths."""
    return int(amount.scaleb(6))


def _decimal(micros: int) -> Decimal:
    return Decimal(micros).scaleb(-6)


def trailing_window_stream(events: DataFrame, cfg: config.VelocityConfig = config.VelocityConfig()
                           ) -> DataFrame:
    """Decoded events (stream or batch) -> events with ``count_5m``/``sum_5m``.

    With ``lateness_seconds`` every row says in ``late`` whether it came behind the watermark.
    """
    prepared, names = cdc.with_event_micros(events), ["seq", "id", "account_id", "currency", "amount", "ts_us"]
    if cfg.lateness_seconds is not None:
        # the watermark's own column isn't kept: Spark would drop late rows before the processor sees them
        marked = prepared.withColumn("_event_time", F.timestamp_micros("ts_us")).withWatermark(
            "_event_time", f"{cfg.lateness_seconds} seconds")
        out = marked.select(*names).groupBy("account_id").transformWithStateInPandas(
            statefulProcessor=WatermarkedWindowProcessor(cfg.window_seconds),
            outputStructType=OUTPUT_SCHEMA + ", late BOOLEAN", outputMode="Append", timeMode="EventTime")
        return out.withColumn("created_at", micros_to_ts(F.col("ts_us"))).drop("ts_us")
    prepared = prepared.select(*names)
    out = prepared.groupBy("account_id").transformWithStateInPandas(
        statefulProcessor=TrailingWindowProcessor(cfg.window_seconds, cfg.idle_ttl_seconds),
        outputStructType=OUTPUT_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime" if cfg.idle_ttl_seconds else "None")
    return out.withColumn("created_at", micros_to_ts(F.col("ts_us"))).drop("ts_us")


def split_known(flags: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(flags of known accounts, flags that must wait for theirs)."""
    known = accounts.select(F.col("id").alias("account_id")).distinct()
    return flags.join(known, "account_id", "left_semi"), flags.join(known, "account_id", "left_anti")


def store_flags(spark: SparkSession, sink: str, new_flags: DataFrame, accounts: DataFrame | None = None) -> None:
    """Insert-if-absent on event_id.  With ``accounts`` a flag needs a known account.

    Flags of unknown accounts wait in ``flags_orphans`` and are tried again
    with every batch.  Known ones are stored before they leave that table, so
    a crash in between only tries them once more.  ``stored_at`` is the time of
    the batch that stored a flag.
    """
    parked = VersionedTable(spark, f"{sink}/flags_orphans")
    left = None
    if accounts is not None:
        waiting = parked.read()
        if waiting is not None:
            new_flags = waiting.select(*new_flags.columns).unionByName(new_flags).dropDuplicates(["event_id"])
        new_flags, left = split_known(new_flags, accounts)
    flags_path = f"{sink}/flags"
    if path_exists(spark, flags_path):
        # the flag id contains window_end, so only the dates this batch touches can
        # hold a duplicate: the date in the join key prunes the stored partitions
        stored = spark.read.parquet(flags_path).select("window_date", "event_id")
        new_flags = new_flags.join(stored, ["window_date", "event_id"], "left_anti")
    new_flags = new_flags.withColumn("stored_at", F.current_timestamp().cast("timestamp_ntz"))
    new_flags.write.mode("append").partitionBy("window_date").parquet(flags_path)
    if left is not None:
        parked.overwrite(left)


def _write_batch(sink: str, cfg: config.VelocityConfig,
                 accounts: Callable[[SparkSession], DataFrame] | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        whole = batch
        try:
            if "late" in batch.columns:
                batch.where("late").select(*LATE_COLUMNS).write.mode("overwrite").parquet(
                    f"{sink}/late/batch_id={batch_id}")
                batch = batch.where("NOT late").drop("late")
            hits = batch_velocity.alerts(batch, cfg)
            hits.write.mode("overwrite").parquet(f"{sink}/alerts/batch_id={batch_id}")
            batch_velocity.alert_messages(hits).write.mode("overwrite").parquet(
                f"{sink}/messages/batch_id={batch_id}")
            new_flags = batch_velocity.flags(hits).withColumn("batch_id", F.lit(batch_id)) \
                                                  .withColumn("window_date", F.to_date("window_end"))
            store_flags(spark, sink, new_flags, accounts(spark) if accounts else None)
        finally:
            whole.unpersist()
    return write


def start_velocity_stream(spark: SparkSession, source: str | DataFrame, sink_dir: str, checkpoint: str,
                          cfg: config.VelocityConfig = config.VelocityConfig(),
                          available_now: bool = True, max_files_per_trigger: int | None = None,
                          max_bytes_per_trigger: int = 4 << 30,
                          accounts: Callable[[SparkSession], DataFrame] | None = None):
    """Start the CDC -> velocity -> alerts/flags stream; returns the query.

    ``source`` is a folder of JSON record files, or any streaming DataFrame with
    the record columns (for Kafka: ``value`` and header values cast to
    string).  A folder's backlog is taken in micro-batches of at most
    ``max_files_per_trigger`` files or, without that, ``max_bytes_per_trigger``;
    a DataFrame brings its own limits.  ``accounts`` gives the accounts as they are when a batch is
    processed; flags of unknown ones are parked.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if isinstance(source, str):
        reader = spark.readStream.schema(cdc.RECORD_SCHEMA)
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger)) if max_files_per_trigger \
            else reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
        source = reader.json(source)
    windowed = trailing_window_stream(cdc.decode(source), cfg)
    writer = windowed.writeStream.foreachBatch(_write_batch(sink_dir, cfg, accounts)) \
                     .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="5 seconds")
    return writer.start()


def read_orphans(spark: SparkSession, sink_dir: str) -> DataFrame | None:
    """Flags that wait for their account."""
    return VersionedTable(spark, f"{sink_dir}/flags_orphans").read()


def read_late(spark: SparkSession, sink_dir: str) -> DataFrame:
    """Events that came behind the watermark."""
    return spark.read.parquet(f"{sink_dir}/late").select(*LATE_COLUMNS)


def read_alerts(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sink_dir}/alerts")


def read_messages(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The alert topic's records: key (account) and JSON value."""
    return spark.read.parquet(f"{sink_dir}/messages")


def read_flags(spark: SparkSession, sink_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sink_dir}/flags")
