"""Column-level helpers.  All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlake import config


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalise_name(col: Column | str) -> Column:
    """Merchant business key: lower-case, spaces trimmed at both ends."""
    return F.lower(F.trim(_c(col)))


def utc_date(col: Column | str) -> Column:
    """UTC calendar date of a timestamp (session time zone is UTC)."""
    return F.to_date(_c(col))


def month_start(date_col: Column | str) -> Column:
    return F.trunc(_c(date_col), "MM")


def next_month(date_col: Column | str) -> Column:
    return F.add_months(month_start(date_col), 1)


def month_key(date_col: Column | str) -> Column:
    """Partition column value ``yyyy-MM`` of the fact table."""
    return F.date_format(_c(date_col), "yyyy-MM")


def partition_name(date_col: Column | str) -> Column:
    start = month_start(date_col)
    return F.format_string(config.FACT_PARTITION_PREFIX + "%sm%s",
                           F.date_format(start, "yyyy"), F.date_format(start, "MM"))


def empty_if_null(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(""))


def decimal_text(col: Column | str) -> Column:
    """Decimal rendered with its full scale, e.g. ``12.500000``."""
    return _c(col).cast("string")


def full_match(col: Column | str, pattern: str) -> Column:
    """Whole-string regex match (``\\z`` so a trailing newline never passes)."""
    return _c(col).rlike(f"^(?:{pattern})\\z")


def epoch_micros(col: Column | str) -> Column:
    """Microseconds since epoch of a (UTC) timestamp, NTZ or LTZ."""
    return F.unix_micros(_c(col).cast("timestamp"))


def micros_to_ts(col: Column) -> Column:
    return F.timestamp_micros(col).cast("timestamp_ntz")


def floor_window(ts: Column | str, seconds: int) -> tuple[Column, Column]:
    """Tumbling bucket ``[start, start + seconds)`` holding ``ts``."""
    width = seconds * 1_000_000
    start_us = F.floor(epoch_micros(ts) / F.lit(width)) * F.lit(width)
    start = micros_to_ts(start_us.cast("bigint"))
    end = micros_to_ts((start_us + F.lit(width)).cast("bigint"))
    return start, end


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with explicit ``+00:00`` offset (seconds precision)."""
    return F.date_format(_c(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssxxx")


def iso_utc_micros(ts: Column | str) -> Column:
    """ISO-8601 like Python ``datetime.isoformat``: micros only when non-zero."""
    t = _c(ts).cast("timestamp")
    has_micros = (epoch_micros(t) % 1_000_000) != 0
    return F.when(has_micros, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")) \
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx"))


def sum_threshold(currency: Column | str, cfg: config.VelocityConfig) -> Column:
    """Sum threshold of an event's currency: VND has its own, all else the other."""
    return F.when(_c(currency) == F.lit("VND"), F.lit(cfg.sum_threshold_vnd).cast("decimal(20,6)")) \
            .otherwise(F.lit(cfg.sum_threshold_other).cast("decimal(20,6)"))


def uuid5(name: Column | str, namespace: str = config.FLAG_NAMESPACE) -> Column:
    """RFC 4122 version-5 UUID of ``name`` under ``namespace``, natively.

    SHA-1 over namespace bytes + UTF-8 name, first 16 bytes, version nibble
    set to 5 and the variant bits to 10xx.
    """
    ns_hex = namespace.replace("-", "")
    digest = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(_c(name), "UTF-8")))
    variant = F.lower(F.conv(
        (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8))
        .cast("string"), 10, 16))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def in_set(col: Column | str, values: list[str]) -> Column:
    return _c(col).isin(*values)
