"""Driver tables -> ledger-domain DataFrames.

The driver ships TPC-H-like tables.  These adapters re-shape them into the
ledger entities (customers, accounts, account snapshots, transactions, CDC
events and ingest requests) with plain projections and equi-joins, so every
query downstream reads the given tables and grows with them.  The same
definitions exist as portable SQL in ``txnlake.plans.oracle`` for the
DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import prepare

EPOCH_FIXTURE = "1995-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(literal: str) -> Column:
    return F.lit(literal).cast("timestamp_ntz")


def _country_of(nation_key: Column) -> Column:
    m = nation_key % 4
    return (F.when(m == 0, "VN").when(m == 1, "SG").when(m == 2, "US").otherwise("JP"))


def _currency_of(cust_key: Column) -> Column:
    return F.when(cust_key % 2 == 0, "VND").otherwise("USD")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        c.c_custkey.cast("string").alias("id"),
        F.concat(c.c_name, F.lit("@Example.com")).alias("email"),
        _country_of(c.c_nationkey).alias("country"),
        (c.c_custkey % 4).cast("smallint").alias("kyc_level"),
        F.when(c.c_mktsegment.isin("BUILDING", "MACHINERY", "FURNITURE"), "LOW")
         .when(c.c_mktsegment == "HOUSEHOLD", "MEDIUM").otherwise("HIGH").alias("risk_band"),
        _ts(EPOCH_FIXTURE).alias("created_at"),
        (_ts(EPOCH_FIXTURE) + F.make_dt_interval(days=(c.c_custkey % 3).cast("int")))
        .alias("updated_at"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    m10 = c.c_custkey % 10
    return c.select(
        F.concat(F.lit("A"), c.c_custkey.cast("string")).alias("id"),
        c.c_custkey.cast("string").alias("customer_id"),
        _currency_of(c.c_custkey).alias("currency"),
        F.lit("VN").alias("country"),
        F.when(m10 == 8, "SUSPENDED").when(m10 == 9, "CLOSED").otherwise("ACTIVE").alias("status"),
        _ts(EPOCH_FIXTURE).alias("created_at"),
        _ts(EPOCH_FIXTURE).alias("updated_at"),
    )


def account_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("A"), o.o_custkey.cast("string")).alias("id"),
        o.o_custkey.cast("string").alias("customer_id"),
        _currency_of(o.o_custkey).alias("currency"),
        F.lit("VN").alias("country"),
        F.when(o.o_orderstatus == "F", "ACTIVE").when(o.o_orderstatus == "O", "SUSPENDED")
         .otherwise("CLOSED").alias("status"),
        o.o_orderdate.alias("as_of"),
        o.o_orderkey.alias("seq"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (ids repeat; see ``dedupe_first`` for staging)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # orders last: the rows then lie by order, as the copies of a transaction do
    j = (li.join(s, li.l_suppkey == s.s_suppkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(o, li.l_orderkey == o.o_orderkey))
    prio = F.col("o_orderpriority")
    flag = F.col("l_returnflag")
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("id"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("account_id"),
        F.when(prio == "1-URGENT", "PAYMENT").when(prio == "2-HIGH", "TRANSFER_IN")
         .when(prio == "3-MEDIUM", "TRANSFER_OUT").when(prio == "4-NOT SPECIFIED", "REFUND")
         .otherwise("FEE").alias("type"),
        F.when(flag == "A", "SETTLED").when(flag == "R", "REVERSED").otherwise("PENDING").alias("status"),
        F.col("l_extendedprice").cast("decimal(20,6)").alias("amount"),
        _currency_of(F.col("o_custkey")).alias("currency"),
        F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("  "), F.upper("p_name")))
         .otherwise(F.concat(F.col("p_name"), F.lit(" "))).alias("merchant_name"),
        F.when(F.col("p_partkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("merchant_category"),
        _country_of(F.col("s_nationkey")).alias("country"),
        F.col("l_shipdate").alias("created_at"),
        F.when(flag == "A", F.col("l_shipdate") + F.expr("INTERVAL 2 DAYS")).alias("settled_at"),
        "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_orderkey",
    )


# Order that decides which copy of a repeated transaction id is "first".
TRANSACTION_ARRIVAL_ORDER = ["created_at", "l_partkey", "l_suppkey", "l_quantity",
                             "amount", "l_discount", "l_tax"]

TRANSACTION_COLUMNS = ["id", "account_id", "type", "status", "amount", "currency",
                       "merchant_name", "merchant_category", "country", "created_at",
                       "settled_at"]


def cdc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("account_id"),
        F.col("value").cast("decimal(20,6)").alias("amount"),
        _currency_of(F.col("user_id")).alias("currency"),
        F.col("ts").alias("created_at"),
        F.when(F.col("event_type") == "error", "u").otherwise("c").alias("op"),
    )


def account_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of accounts: every snapshot is one, some delete the account."""
    s = account_snapshots(spark, sf_dir)
    return s.select(
        (F.substring("id", 2, 20).cast("bigint") % 3).cast("int").alias("_partition"),
        F.col("seq").alias("_offset"), F.when(F.col("seq") % 11 == 3, "d").otherwise("u").alias("op"),
        "id", "customer_id", "currency", "country", "status",
        _ts(EPOCH_FIXTURE).alias("created_at"), F.col("as_of").alias("updated_at"))


def transaction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of transactions: three events in a row concern one; an error deletes it."""
    e = table(spark, sf_dir, "events")
    turn = F.col("event_id") % 3
    first = F.col("event_id") - turn
    none = F.lit(None).cast("string")
    return e.select(
        (F.floor(first / 3) % 4).cast("int").alias("_partition"), F.col("event_id").alias("_offset"),
        F.when(F.col("event_type") == "error", "d").when(turn == 0, "c").otherwise("u").alias("op"),
        F.concat(F.lit("T"), first.cast("string")).alias("id"),
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("account_id"),
        F.lit("PAYMENT").alias("type"),
        F.when(turn == 0, "PENDING").when(turn == 1, "SETTLED").otherwise("REVERSED").alias("status"),
        F.col("value").cast("decimal(20,6)").alias("amount"), _currency_of(F.col("user_id")).alias("currency"),
        none.alias("merchant_name"), none.alias("merchant_category"), F.lit("VN").alias("country"),
        F.col("ts").alias("created_at"),
        F.when(turn > 0, F.col("ts")).alias("settled_at"))


def transaction_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create-transaction requests with idempotency keys.

    Every fifth request re-sends the body of the request four before it,
    so keys see replays (same body) and conflicts (other body).
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    b = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("b_id"), F.col("user_id").alias("b_user"),
        F.col("event_type").alias("b_type"), F.col("value").alias("b_value"))
    eid = F.col("event_id")
    body_id = F.when(eid % 5 == 4, eid - 4).otherwise(eid)
    j = e.join(b, body_id == b.b_id)
    btype = F.col("b_type")
    return j.select(
        eid.alias("seq"),
        F.when(eid % 50 == 46, F.lit(None).cast("string"))
         .when(eid % 5 >= 3, F.concat(F.lit("k"), (eid - eid % 5).cast("string")))
         .otherwise(F.concat(F.lit("k"), eid.cast("string"))).alias("idem_key"),
        F.concat(F.lit("A"), F.when(F.col("b_id") % 31 == 0, F.lit(999999).cast("bigint"))
                 .otherwise(F.col("b_user")).cast("string")).alias("account_id"),
        F.when(btype == "purchase", "PAYMENT").when(btype == "click", "FEE")
         .when(btype == "view", "REFUND").when(btype == "signup", "TRANSFER_IN")
         .otherwise("BAD").alias("type"),
        F.col("b_value").cast("decimal(20,2)").cast("string").alias("amount"),
        F.when(F.col("b_id") % 17 == 0, "EUR").when(F.col("b_user") % 2 == 0, "VND")
         .otherwise("USD").alias("currency"),
        F.concat(F.lit("Cafe "), (F.col("b_user") % 20).cast("string")).alias("merchant_name"),
        F.when(F.col("b_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("coffee"))
         .alias("merchant_category"),
        F.lit(None).cast("string").alias("description"),
        F.when(F.col("b_id") % 23 == 0, "vn").otherwise("VN").alias("country"),
        F.col("ts").alias("created_at"),
    )


def request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requested transactions as change events; some name an account that doesn't exist."""
    r = transaction_requests(spark, sf_dir)
    return r.select("seq", F.col("seq").cast("string").alias("id"), "account_id",
                    F.col("amount").cast("decimal(20,6)").alias("amount"), "currency", "created_at",
                    F.lit("c").alias("op"))


def customer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    local = F.when(k % 10 == 9, F.concat(F.upper(F.lit("customer")), (k - 9).cast("string"))) \
             .otherwise(F.concat(F.lit("customer"), k.cast("string")))
    return c.select(
        k.alias("seq"),
        F.concat(local, F.lit("@example.com")).alias("email"),
        F.when(k % 19 == 0, "v1").otherwise("VN").alias("country"),
        (k % 6).cast("smallint").alias("kyc_level"),
        F.when(k % 13 == 0, "EXTREME").otherwise("LOW").alias("risk_band"),
    )


def account_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("seq"),
        (F.col("o_custkey") + F.when(k % 40 == 0, 1000000).otherwise(0)).cast("string")
         .alias("customer_id"),
        F.when(k % 3 == 0, "VND").when(k % 3 == 1, "USD")
         .otherwise(F.when(k % 7 == 0, "usd").otherwise("EUR")).alias("currency"),
        F.lit("VN").alias("country"),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change feed: id, attributes, as_of = GREATEST(created, updated)."""
    c = customers(spark, sf_dir)
    return c.select("id", "email", "country", "kyc_level", "risk_band",
                    F.greatest("created_at", "updated_at").alias("as_of"))


SECOND_VERSION_AS_OF = "2000-01-01 00:00:00"  # equals plans.params.SECOND_AS_OF


def customer_second_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-feed of all customers at 2000-01-01 with risk_band changed for id % 5 = 0."""
    c = customers(spark, sf_dir)
    flip = F.when(F.col("risk_band") == "HIGH", "LOW").otherwise("HIGH")
    return c.select(
        "id", "email", "country", "kyc_level",
        F.when(F.col("id").cast("bigint") % 5 == 0, flip).otherwise(F.col("risk_band"))
         .alias("risk_band"),
        _ts(SECOND_VERSION_AS_OF).alias("as_of"),
    )
