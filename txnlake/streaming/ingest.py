"""Create-transaction requests as a checkpointed stream.

Idempotency across micro-batches: the claim of a key (sequence, request hash
and answer of the first fully valid request) is kept in hash buckets on the
shared file system, next to the stream's checkpoint.  A micro-batch reads the
claims of the buckets that its own keys fall into, classifies its requests
with the batch rules (``ingest.classify_requests``), and adds the new claims.

A micro-batch that is replayed after a crash must give the same answers, so a
claim carries the id of the batch that made it, and a batch only sees claims
of earlier batches.  Outcomes, new transactions and outbox events are written
per batch id, and a replay overwrites them.  So the result doesn't depend on how the
requests are dealt into batches, if these follow the arrival order.

A key's claimer is found by a partial aggregate: a key that a third of the
requests use is no large group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import config
from txnlake.operators import ingest
from txnlake.sources.buckets import BucketedTable

#: Hash buckets of the claims, fixed when they are first written.
CLAIM_BUCKETS = 64
CLAIM_COLUMNS = ["endpoint", "idem_key", "request_hash", "response_code", "response_body", "created_at",
                 "batch_id"]


def claims_table(spark: SparkSession, sink: str) -> BucketedTable:
    return BucketedTable(spark, f"{sink}/claims", "idem_key", CLAIM_BUCKETS)


def _classify_batch(sink: str, accounts: Callable[[SparkSession], DataFrame], endpoint: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            table = claims_table(spark, sink)
            buckets = table.touched(batch.where(F.coalesce("idem_key", F.lit("")) != ""), F.col("idem_key"))
            known = table.read(buckets)
            earlier = None if known is None else known.where(F.col("batch_id") < batch_id)
            done = ingest.classify_requests(batch, accounts(spark), endpoint, stored=earlier)
            path = f"{sink}/outcomes/batch_id={batch_id}"
            done.write.mode("overwrite").parquet(path)
            done = spark.read.schema(done.schema).parquet(path)
            new = ingest.new_transactions(done)
            new.write.mode("overwrite").parquet(f"{sink}/transactions/batch_id={batch_id}")
            ingest.outbox_events(new).write.mode("overwrite").parquet(f"{sink}/outbox/batch_id={batch_id}")
            claims = ingest.idempotency_records(done, endpoint).withColumn(
                "batch_id", F.lit(batch_id).cast("long")).select(*CLAIM_COLUMNS)
            fresh = table.touched(claims)
            if fresh:
                kept = claims if earlier is None else earlier.where(
                    table.bucket().isin(fresh)).select(*CLAIM_COLUMNS).unionByName(claims)
                table.flip(table.write(kept, fresh))
        finally:
            batch.unpersist()
    return write


def start_ingest_stream(requests: DataFrame, accounts: Callable[[SparkSession], DataFrame], sink: str,
                        checkpoint: str, endpoint: str = config.TRANSACTION_ENDPOINT,
                        available_now: bool = True):
    """Classify a stream of requests (any streaming DataFrame); returns the query.

    ``accounts`` gives the accounts as they are when a batch is processed.
    """
    writer = requests.writeStream.foreachBatch(_classify_batch(sink, accounts, endpoint)).option(
        "checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="5 seconds")
    return writer.start()


def read_outcomes(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/outcomes")


def read_transactions(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/transactions")


def read_outbox(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/outbox")
