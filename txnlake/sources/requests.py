"""Request-batch source: create requests arriving as JSON lines.

Each line is one request body plus its arrival ``seq`` (and, for
transactions, the ``idem_key`` header value and receive time).  Schemas are
explicit (no inference); every field but ``seq`` is read as text, so field
validation (``txnlake.operators.ingest``) sees exactly what was sent.  A line
that is not JSON has all fields null and its text in ``_corrupt_record``; a
receive time that is not one becomes null in ``created_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()

CUSTOMER_REQUEST = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("email", _S), T.StructField("country", _S),
    T.StructField("kyc_level", _S), T.StructField("risk_band", _S)])

ACCOUNT_REQUEST = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("customer_id", _S),
    T.StructField("currency", _S), T.StructField("country", _S)])

TRANSACTION_REQUEST = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("idem_key", _S),
    T.StructField("account_id", _S), T.StructField("type", _S), T.StructField("amount", _S),
    T.StructField("currency", _S), T.StructField("merchant_name", _S),
    T.StructField("merchant_category", _S), T.StructField("description", _S),
    T.StructField("country", _S), T.StructField("created_at", _S)])

SCHEMAS = {"customers": CUSTOMER_REQUEST, "accounts": ACCOUNT_REQUEST,
           "transactions": TRANSACTION_REQUEST}


def read_requests(spark: SparkSession, path: str, kind: str, streaming: bool = False) -> DataFrame:
    """Read a folder of JSON-lines requests of ``kind`` (batch or stream)."""
    schema = T.StructType([*SCHEMAS[kind].fields, T.StructField("_corrupt_record", _S)])
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(schema).option("mode", "PERMISSIVE").json(path)
    if "created_at" in schema.names:
        rows = rows.withColumn("created_at", F.expr("try_cast(created_at AS TIMESTAMP_NTZ)"))
    return rows


def write_requests(df: DataFrame, path: str) -> None:
    """Write request rows as JSON lines (keeps explicit nulls)."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)
