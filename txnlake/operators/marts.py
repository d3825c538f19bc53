"""Marts (materialised aggregates) and the parametrised serving reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.scalar import decimal_text, utc_date

SUM_TYPE = "decimal(38,6)"


def gmv_daily(fact: DataFrame) -> DataFrame:
    """Count and sum per (UTC day, currency); no status or type filter."""
    return fact.groupBy(utc_date("created_at").alias("day_utc"), "currency").agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").cast(SUM_TYPE).alias("total_amount"))


def is_recent(as_of: Column, days: int = config.TOP_MERCHANTS_DAYS) -> Column:
    """``created_at`` lies in the ``days`` before ``as_of`` (or later)."""
    return F.col("created_at") >= as_of - F.make_dt_interval(days=F.lit(days))


def within_days(rows: DataFrame, as_of: Column, days: int = config.TOP_MERCHANTS_DAYS) -> DataFrame:
    return rows.where(is_recent(as_of, days))


def top_merchants(fact: DataFrame, dim_merchant: DataFrame, as_of: Column,
                  days: int = config.TOP_MERCHANTS_DAYS, k: int = config.TOP_MERCHANTS_K,
                  by: str = "current") -> DataFrame:
    """Top-k merchants by amount over the ``days`` before ``as_of``.

    ``by="current"`` joins facts to the *current* merchant version only, so
    spend recorded under a superseded version drops out (compatible
    default).  ``by="name"`` joins any version and groups by currency too.
    The limit is the feature (top-k); ordering adds a name tie-break.
    """
    recent = within_days(fact, as_of, days)
    dims = dim_merchant.select("merchant_sk", "merchant_name_norm", "is_current")
    keys = ["merchant_name_norm"]
    if by == "current":
        dims = dims.where(F.col("is_current"))
    elif by == "name":
        keys.append("currency")
    else:
        raise ValueError("by must be 'current' or 'name'")
    agg = recent.join(dims.drop("is_current"), "merchant_sk").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("tx_count"),
        F.sum("amount").cast(SUM_TYPE).alias("total_amount"))
    return agg.orderBy(F.col("total_amount").desc(), *[F.col(c) for c in keys]).limit(k)


def series_range(gmv: DataFrame) -> DataFrame:
    return gmv.groupBy("currency").agg(F.min("total_amount").alias("min_total"),
                                       F.max("total_amount").alias("max_total"))


def _check_range(name: str, value: int, lo: int, hi: int) -> None:
    if not isinstance(value, int) or isinstance(value, bool) or not lo <= value <= hi:
        raise ValueError(f"{name} must be an integer in [{lo}, {hi}], got {value!r}")


def serve_gmv_daily(gmv: DataFrame, currency: str = "VND", days: int = 30,
                    as_of_date: Column | str | None = None) -> DataFrame:
    """GMV points of one currency for ``days`` back from ``as_of_date`` (inclusive)."""
    if not isinstance(currency, str) or len(currency) != 3:
        raise ValueError("currency must be 3 characters")
    _check_range("days", days, 1, 365)
    if as_of_date is None:
        as_of_date = F.current_date()
    elif isinstance(as_of_date, str):
        as_of_date = F.lit(as_of_date).cast("date")
    return (gmv.where((F.col("currency") == currency) &
                      (F.col("day_utc") >= F.date_sub(as_of_date, days)))
               .select(F.col("day_utc").cast("string").alias("day_utc"), "currency", "tx_count",
                       decimal_text("total_amount").alias("total_amount"))
               .orderBy("day_utc"))


def serve_top_merchants(mart: DataFrame, limit: int = 10) -> DataFrame:
    _check_range("limit", limit, 1, 100)
    return (mart.orderBy(F.col("total_amount").desc(), F.col("merchant_name_norm"))
                .limit(limit)
                .select("merchant_name_norm", "tx_count",
                        decimal_text("total_amount").alias("total_amount")))


def serve_risk_flags(flags: DataFrame, hours: int = 1, as_of: Column | None = None,
                     by: str = "created_at") -> DataFrame:
    """Flags of the ``hours`` before ``as_of``, newest first.

    ``by`` is the time that counts: ``created_at``, the event's, or ``stored_at``, when the stream
    stored the flag (a late or parked event's flag is new by that time only).
    """
    if by not in ("created_at", "stored_at"):
        raise ValueError("by must be created_at or stored_at")
    _check_range("hours", hours, 1, 24)
    if as_of is None:
        as_of = F.current_timestamp().cast("timestamp_ntz")
    return (flags.withColumn("created_at", F.col(by)).where(F.col("created_at") >= as_of - F.make_dt_interval(hours=F.lit(hours)))
                 .select("event_id", "account_id", "window_start", "window_end", "count_5m",
                         decimal_text("sum_5m").alias("sum_5m"), "reason", "created_at")
                 .orderBy(F.col("created_at").desc(), "account_id", "reason"))


def latest_outbox(outbox: DataFrame, limit: int = 10) -> DataFrame:
    _check_range("limit", limit, 1, 100)
    return outbox.orderBy(F.col("created_at").desc(), F.col("aggregate_id").desc()).limit(limit)
