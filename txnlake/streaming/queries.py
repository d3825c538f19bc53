"""Registered queries that go through the CDC record format and the stream.

Both derive their input from the driver's ``events`` table: Spark renders
the change events as CDC records (JSON files) in the shared checkpoint
folder, then the batch decoder or the checkpointed stream reads them back.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.scalar import epoch_micros
from txnlake.operators import changelog
from txnlake.plans import params as P
from txnlake.session import prepare, reliable_checkpoint, scratch_path
from txnlake.sources import cdc
from txnlake.sources import fixtures as fx
from txnlake.sources.buckets import BucketedTable
from txnlake.sources.requests import read_requests, write_requests
from txnlake.streaming.ingest import read_outcomes, start_ingest_stream
from txnlake.streaming.velocity import (read_alerts, read_late, read_messages, read_orphans,
                                        start_velocity_stream)


def write_cdc_files(spark: SparkSession, sf: str) -> str:
    """Render the CDC events as JSON record files, with the parallelism of the input."""
    path = scratch_path(spark, "cdc-records")
    cdc.to_records(fx.cdc_events(spark, sf)).write.json(path)
    return path


def q_cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    src = write_cdc_files(spark, sf)
    decoded = cdc.decode(spark.read.schema(cdc.RECORD_SCHEMA).json(src))
    return decoded.select("seq", "account_id", "amount", "currency", "created_at")


def q_cdc_decode_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Records of which half are unusable: no value, no object, cut off, no amount, an amount that is no number.

    Those are skipped; of the others some have no currency and get the default.
    """
    prepare(spark)
    records, turn, value = cdc.to_records(fx.cdc_events(spark, sf)), F.col("offset") % 10, F.col("value")
    bad = (F.when(turn == 0, F.lit(None)).when(turn == 1, F.lit("[1, 2]"))
           .when(turn == 2, F.expr("left(value, length(value) - 3)"))
           .when(turn == 3, F.regexp_replace(value, '"amount"', '"sum"'))
           .when(turn == 4, F.regexp_replace(value, '"amount": *"?[-0-9.]+"?', '"amount":"many"'))
           .when(turn == 5, F.regexp_replace(value, '"currency"', '"money"')).otherwise(value))
    path = scratch_path(spark, "cdc-records")
    records.withColumn("value", bad).write.json(path)
    decoded = cdc.decode(spark.read.schema(cdc.RECORD_SCHEMA).json(path))
    return decoded.select("seq", "account_id", "amount", "currency", "created_at")


def q_cdc_table_state(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts and transactions as their change logs leave them.

    The records are decoded and merged in two batches, the later offsets
    first; the state between the batches is stored in buckets.
    """
    prepare(spark)
    logs = {"accounts": fx.account_log, "transactions": fx.transaction_log}
    states = []
    for name, log in logs.items():
        path, ddl = scratch_path(spark, f"cdc-{name}"), cdc.TABLES[name]
        cdc.to_change_records(log(spark, sf), ddl).write.json(path)
        # decoded once; the bounds, the buckets and the merges of both batches read the stored changes
        changes = reliable_checkpoint(cdc.decode_rows(spark.read.schema(cdc.RECORD_SCHEMA).json(path), ddl))
        table = BucketedTable(spark, scratch_path(spark, f"state-{name}"), "id")
        half = changes.agg(F.max("_offset") / 2).scalar()
        for batch in (changes.where(F.col("_offset") > half), changes.where(F.col("_offset") <= half)):
            buckets = table.touched(batch)
            table.flip(table.write(changelog.merge_changes(table.read(buckets), batch, "id"), buckets))
        state = changelog.live_rows(table.read())
        amount, changed = ("amount", "created_at") if name == "transactions" else (None, "updated_at")
        states.append(state.select(
            F.lit(name).alias("table_name"), "id", "status",
            (F.col(amount) if amount else F.lit(None)).cast("decimal(20,6)").alias("amount"),
            F.col(changed).alias("changed_at")))
    return states[0].unionByName(states[1])


def q_velocity_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Run the stateful stream to completion (availableNow), return its alerts."""
    prepare(spark)
    src = write_cdc_files(spark, sf)
    sink = scratch_path(spark, "velocity-sink")
    query = start_velocity_stream(spark, src, sink, scratch_path(spark, "velocity-ckpt"))
    query.awaitTermination()
    return read_alerts(spark, sink).select("seq", "account_id", "window_start", "window_end",
                                           "count_5m", "sum_5m", "reason")


def q_velocity_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The alert messages of the stream, key and fields of the JSON value."""
    prepare(spark)
    src = write_cdc_files(spark, sf)
    sink = scratch_path(spark, "velocity-sink")
    start_velocity_stream(spark, src, sink, scratch_path(spark, "velocity-ckpt")).awaitTermination()
    body = F.from_json("value", "event_id string, account_id string, window struct<start: string, "
                       "end: string>, count_5m bigint, sum_5m string, reason string, tx_example string")
    return read_messages(spark, sink).select("key", body.alias("b")).select(
        "key", "b.event_id", "b.account_id", F.col("b.window.start").alias("window_start"),
        F.col("b.window.end").alias("window_end"), "b.count_5m", "b.sum_5m", "b.reason",
        "b.tx_example")


def q_flags_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Flags of the requested transactions that wait for an unknown account."""
    prepare(spark)
    src, sink = scratch_path(spark, "cdc-records"), scratch_path(spark, "velocity-sink")
    cdc.to_records(fx.request_events(spark, sf)).write.json(src)
    start_velocity_stream(spark, src, sink, scratch_path(spark, "velocity-ckpt"),
                          accounts=lambda s: fx.accounts(s, sf)).awaitTermination()
    return read_orphans(spark, sink).select("account_id", "window_end", "reason", "count_5m", "sum_5m")


def q_velocity_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events behind the watermark of the velocity stream: three arrivals, every tenth event one too late.

    Each arrival is run from the checkpoint of the last, which holds the watermark.
    """
    prepare(spark)
    src, sink = scratch_path(spark, "cdc-records"), scratch_path(spark, "velocity-sink")
    ckpt, cfg = scratch_path(spark, "velocity-ckpt"), replace(
        config.VelocityConfig(), lateness_seconds=P.LATENESS_SECONDS)
    events = fx.cdc_events(spark, sf).withColumn("us", epoch_micros("created_at"))
    low, high = events.agg(F.min("us"), F.max("us")).first()
    if low is None:
        low = high = 0
    third = F.expr(f"(us - {low}) * 3 div ({high} - {low} + 1)")
    arrival = F.least(F.lit(2), third + F.when(F.col("seq") % 10 == 3, 1).otherwise(0))
    for n in range(3):
        cdc.to_records(events.where(arrival == n).drop("us")).write.mode("append").json(src)
        start_velocity_stream(spark, src, sink, ckpt, cfg).awaitTermination()
    return read_late(spark, sink).select("seq", "account_id", "amount", "created_at")


def q_ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Transaction requests through the stream: three arrivals, each run from the checkpoint of the last."""
    prepare(spark)
    src, sink = scratch_path(spark, "requests"), scratch_path(spark, "ingest-sink")
    ckpt = scratch_path(spark, "ingest-ckpt")
    reqs = fx.transaction_requests(spark, sf)
    last = reqs.agg(F.max("seq")).scalar()
    for n in range(3):
        write_requests(reqs.where((F.col("seq") >= last * n / 3) & (
            (F.col("seq") < last * (n + 1) / 3) | F.lit(n == 2))), src)
        stream = read_requests(spark, src, "transactions", streaming=True)
        start_ingest_stream(stream, lambda s: fx.accounts(s, sf), sink, ckpt).awaitTermination()
    return read_outcomes(spark, sink).select("seq", "idem_key", "outcome", "code")


STREAM_QUERIES = {
    "flags_orphans": q_flags_orphans,
    "ingest_stream": q_ingest_stream,
    "velocity_late_events": q_velocity_late_events,
    "velocity_messages": q_velocity_messages,
    "cdc_decode_guards": q_cdc_decode_guards,
    "cdc_decode": q_cdc_decode,
    "cdc_table_state": q_cdc_table_state,
    "velocity_stream": q_velocity_stream,
}
