"""Fact load: as-of key resolution, derived dates, idempotent month append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions.scalar import month_key, normalise_name, partition_name, month_start, \
    next_month, utc_date
from txnlake.operators.asof import join_histories, lookup, segments
from txnlake.session import reliable_checkpoint

FACT_COLUMNS = ["transaction_bk", "customer_sk", "account_sk", "merchant_sk", "type", "status",
                "amount", "currency", "country", "created_at", "settled_at", "created_date"]
FACT_KEY = ["transaction_bk", "created_date"]


def with_created_date(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """``created_date`` is always derived: the UTC date of ``created_at``."""
    return df.withColumn("created_date", utc_date(ts_col))


def account_history(dim_account: DataFrame, dim_customer: DataFrame, overlapping: bool = False) -> DataFrame:
    """Segments by account with the keys of the account's and its customer's version."""
    return join_histories(
        segments(dim_account, "account_bk", ["account_sk", "customer_bk"], overlapping), "customer_bk",
        segments(dim_customer, "customer_bk", ["customer_sk"], overlapping))


def resolve_keys(txns: DataFrame, dim_account: DataFrame, dim_customer: DataFrame,
                 dim_merchant: DataFrame, overlapping: bool = False) -> DataFrame:
    """Attach account, customer (through the account version) and merchant keys.

    Dimensions carry ``*_sk`` columns.  Unresolvable keys stay NULL.  Account and
    customer histories are joined in dimension space and written once (reliable
    checkpoint), so the facts are looked up twice.  ``overlapping`` says that versions of a key may
    overlap; a dimension's load refuses such versions.  ``txns`` is a stored table: its keys
    are counted ahead of either look-up.
    """
    history = reliable_checkpoint(account_history(dim_account, dim_customer, overlapping))
    t = lookup(txns, F.col("account_id"), "created_at", history, "_h_")
    t = t.withColumnRenamed("_h_account_sk", "account_sk").withColumnRenamed("_h_customer_sk", "customer_sk")
    merchants = segments(dim_merchant, "merchant_name_norm", ["merchant_sk"], overlapping)
    return lookup(t.drop("_h_customer_bk"), normalise_name(F.col("merchant_name")), "created_at", merchants, "",
                  seen=txns)


def build_fact(txns: DataFrame, dim_account: DataFrame, dim_customer: DataFrame,
               dim_merchant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Return ``(fact rows, unresolved rows)``.

    All three keys are required (an unresolved customer would otherwise put
    a NULL into a required column); unresolved rows go to a side output and
    are retried by the next run.
    """
    return split_resolved(with_created_date(
        resolve_keys(txns, dim_account, dim_customer, dim_merchant)), txns.columns)


def split_resolved(resolved: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cut rows with resolved keys into ``(fact rows, unresolved rows with columns)``."""
    ok = (F.col("account_sk").isNotNull() & F.col("customer_sk").isNotNull() &
          F.col("merchant_sk").isNotNull())
    fact = resolved.where(ok).select(
        F.col("id").alias("transaction_bk"), "customer_sk", "account_sk", "merchant_sk",
        "type", "status", "amount", "currency", "country", "created_at", "settled_at",
        "created_date")
    unresolved = resolved.where(~ok).select(*columns)
    return fact, unresolved


def with_month(fact: DataFrame) -> DataFrame:
    """Add the storage partition column ``created_month`` (``yyyy-MM``)."""
    return fact.withColumn("created_month", month_key("created_date"))


def touched_partitions(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """Distinct month partitions (name, start, end) the rows fall into."""
    d = utc_date(ts_col)
    return df.select(partition_name(d).alias("partition_name"),
                     month_start(d).alias("start_date"),
                     next_month(d).alias("end_date")).distinct()


def new_fact_rows(fact: DataFrame, existing: DataFrame) -> DataFrame:
    """Insert-if-absent on ``(transaction_bk, created_date)``.

    The anti-join reads only the months the batch touches: the month
    column is part of the join key, and the existing table is pre-filtered
    to those months with a semi-join on the small distinct-month list.
    """
    batch = with_month(fact)
    months = batch.select("created_month").distinct()
    target = existing.join(months, "created_month", "left_semi") if "created_month" in existing.columns \
        else with_month(existing).join(months, "created_month", "left_semi")
    return batch.join(target.select("created_month", *FACT_KEY), ["created_month", *FACT_KEY],
                      "left_anti")
