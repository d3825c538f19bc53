"""Velocity risk rule in batch: trailing-window count/sum per account.

Window semantics: for an event at time ``t`` of account ``a`` the window
holds the events of ``a`` with time in ``[t - W, t]`` that arrived no later
than it (events with the same time but a larger ``seq`` have not arrived
yet).  For input whose arrival order agrees with event time per account
this equals the window of the streaming path exactly; the streaming
operator (``txnlake.streaming.velocity``) is the definition for input that
arrives out of time order.

Every event enters the window at its time and leaves it just after ``t + W``,
so count and sum are running totals over entries (+) and departures (-) in
time order: linear work, whatever a window or a group of equal times holds.

Skew: running totals by account alone would put a hot account (say, a third
of all events) into one task.  They are taken within ``(account, time
slice)``; what earlier slices leave over is added from per-slice totals,
whose number per account is bounded by the time span.  No row is dropped or
capped; each is doubled once.

Events without a time are peers, as in SQL: their window holds the account's
events without a time that arrived no later.  They never leave it, and count
in no other window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.scalar import epoch_micros, floor_window, iso_utc, sum_threshold, uuid5

SUM_TYPE = "decimal(38,6)"


def trailing_window(events: DataFrame, cfg: config.VelocityConfig = config.VelocityConfig(),
                    key: str = "account_id", ts: str = "created_at", seq: str = "seq",
                    amount: str = "amount") -> DataFrame:
    """Add ``count_5m`` and ``sum_5m`` (trailing window) to every event."""
    w_us = cfg.window_seconds * 1_000_000
    s_us = cfg.slice_seconds * 1_000_000
    base = events.withColumn("_us", epoch_micros(ts))
    enters = F.struct(F.col("_us").alias("at"), F.lit(1).alias("sign"))
    leaves = F.struct((F.col("_us") + w_us + 1).alias("at"), F.lit(-1).alias("sign"))
    steps = base.withColumn("_step", F.explode(F.when(F.col("_us").isNull(), F.array(enters))
                                               .otherwise(F.array(enters, leaves)))) \
                .withColumn("_slice", F.floor(F.col("_step.at") / F.lit(s_us))) \
                .withColumn("_amount", F.col("_step.sign") * F.col(amount))
    totals = steps.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_of")).agg(
        F.sum("_step.sign").alias("_n"), F.sum("_amount").alias("_s"))
    earlier = Window.partitionBy("_key", F.col("_of").isNull()).orderBy("_of") \
                    .rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_key", "_of", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_cn"),
                            F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_cs"))
    # departures come before entries at the same time; equal times in arrival order
    so_far = Window.partitionBy(key, "_slice").orderBy("_step.at", "_step.sign", seq) \
                   .rowsBetween(Window.unboundedPreceding, 0)
    counted = steps.withColumn("_rn", F.sum("_step.sign").over(so_far)) \
                   .withColumn("_rs", F.sum("_amount").over(so_far)).where(F.col("_step.sign") == 1)
    joined = counted.join(carried, F.col(key).eqNullSafe(F.col("_key"))
                          & F.col("_slice").eqNullSafe(F.col("_of")))
    return joined.select(*events.columns, (F.col("_rn") + F.col("_cn")).alias("count_5m"),
                         (F.col("_rs") + F.col("_cs")).cast(SUM_TYPE).alias("sum_5m"))


def reason(count_col, sum_col, currency_col, cfg: config.VelocityConfig):
    """Count rule first (priority), else the sum rule for the event's currency."""
    return (F.when(count_col >= F.lit(cfg.count_threshold), F.lit(config.REASON_COUNT))
             .when(sum_col >= sum_threshold(currency_col, cfg), F.lit(config.REASON_SUM)))


def flag_id(account_col, window_end_col, reason_col):
    """uuid5 of ``account:window_end(ISO, +00:00):reason`` (deterministic dedupe key)."""
    return uuid5(F.concat_ws(":", account_col.cast("string"), iso_utc(window_end_col), reason_col))


def alerts(windowed: DataFrame, cfg: config.VelocityConfig = config.VelocityConfig()) -> DataFrame:
    """Every triggering event, with its tumbling bucket label and flag id."""
    r = reason(F.col("count_5m"), F.col("sum_5m"), F.col("currency"), cfg)
    start, end = floor_window("created_at", cfg.window_seconds)
    hits = windowed.withColumn("reason", r).where(F.col("reason").isNotNull())
    hits = hits.withColumn("window_start", start).withColumn("window_end", end)
    return hits.withColumn("event_id", flag_id(F.col("account_id"), F.col("window_end"),
                                               F.col("reason")))


def alert_messages(hits: DataFrame) -> DataFrame:
    """Alert topic records: key = account id, value = JSON message."""
    value = F.to_json(F.struct(
        F.col("event_id"), F.col("account_id").cast("string").alias("account_id"),
        F.struct(iso_utc("window_start").alias("start"), iso_utc("window_end").alias("end"))
         .alias("window"),
        F.col("count_5m"), F.col("sum_5m").cast("string").alias("sum_5m"), F.col("reason"),
        F.col("id").cast("string").alias("tx_example")))
    return hits.select(F.col("account_id").cast("string").alias("key"), value.alias("value"),
                       F.col("seq"))


def flags(hits: DataFrame) -> DataFrame:
    """Stored flags: the first hit per flag id (insert-if-absent on event_id).

    ``min(struct(seq, ...))`` per id is a partial aggregate, so a hot
    account/bucket is reduced map-side before the shuffle.
    """
    cols = ["account_id", "window_start", "window_end", "count_5m", "sum_5m", "reason",
            "created_at"]
    first = hits.groupBy("event_id").agg(
        F.min(F.struct(F.col("seq"), *[F.col(c) for c in cols])).alias("_f"))
    return first.select("event_id", *[F.col(f"_f.{c}").alias(c) for c in cols])


def velocity_hits(events: DataFrame, cfg: config.VelocityConfig = config.VelocityConfig()) -> DataFrame:
    """Create events (op absent or ``c``) -> windowed -> triggering hits."""
    creates = events.where(F.col("op").isNull() | (F.col("op") == "c")) if "op" in events.columns \
        else events
    return alerts(trailing_window(creates, cfg), cfg)
