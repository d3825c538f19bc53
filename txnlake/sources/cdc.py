"""Change-data-capture records: file layout, writer and decoder.

A record mirrors what the Kafka source yields with ``includeHeaders``:
``value`` (the row image as JSON text, either bare or wrapped as
``{"schema": ..., "payload": {...}}``), ``headers`` (key/value pairs, the
operation under ``op`` or ``__op``), ``partition`` and ``offset``.  The
same decoder serves a batch read, a file stream and a Kafka stream (cast
``value``/header values to string first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake import config
from txnlake.functions.scalar import epoch_micros

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]))),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Row shapes of the captured tables (fixed values): column and type, key first.
TABLES = {
    "customers": "id STRING, email STRING, country STRING, kyc_level SMALLINT, risk_band STRING, "
                 "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "accounts": "id STRING, customer_id STRING, currency STRING, country STRING, status STRING, "
                "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    "transactions": "id STRING, account_id STRING, type STRING, status STRING, amount DECIMAL(20,6), "
                    "currency STRING, merchant_name STRING, merchant_category STRING, country STRING, "
                    "created_at TIMESTAMP_NTZ, settled_at TIMESTAMP_NTZ",
    "outbox": "id STRING, aggregate_type STRING, aggregate_id STRING, event_type STRING, payload STRING, "
              "created_at TIMESTAMP_NTZ",
}

DECODED_COLUMNS = ["seq", "id", "account_id", "amount", "currency", "created_at", "op"]


def to_records(events: DataFrame, wrap_every: int = 2) -> DataFrame:
    """Render events ``(seq, id, account_id, amount, currency, created_at, op)``
    as CDC records; every ``wrap_every``-th row uses the envelope shape."""
    iso = F.date_format(F.col("created_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    row = F.struct(F.col("id"), F.col("account_id"), F.col("amount").cast("string").alias("amount"),
                   F.col("currency"), iso.alias("created_at"))
    wrapped = F.to_json(F.struct(F.lit("transactions").alias("schema"), row.alias("payload")))
    value = F.when(F.col("seq") % wrap_every == 0, wrapped).otherwise(F.to_json(row))
    header_key = F.when(F.col("seq") % 2 == 0, F.lit("__op")).otherwise(F.lit("op"))
    headers = F.array(F.struct(header_key.alias("key"), F.col("op").alias("value")))
    return events.select(F.col("account_id").alias("key"), value.alias("value"),
                         headers.alias("headers"), F.lit(0).alias("partition"),
                         F.col("seq").alias("offset"))


def header(headers: Column, *names: str) -> Column:
    """First header value whose key equals one of ``names`` (case-insensitive)."""
    wanted = [n.lower() for n in names]
    hit = F.filter(headers, lambda h: F.lower(h["key"]).isin(*wanted))
    return F.when(F.size(hit) > 0, hit[0]["value"].cast("string"))


def sequence() -> Column:
    """Arrival order over all partitions: (partition, offset) as one number."""
    return (F.shiftleft(F.coalesce(F.col("partition"), F.lit(0)).cast("bigint"), 44)
            + F.col("offset"))


def decode(records: DataFrame) -> DataFrame:
    """Records -> create events ready for the velocity rule.

    Drops: null values, values that are not JSON objects, operations other
    than create (``op``/``__op`` header or ``__op`` field; an empty one is a create), rows without
    account or amount, amounts that are not decimals.  A missing currency
    defaults to VND (an explicit null does not); a missing or empty event time
    falls back to the processing time.

    Each object is parsed once into ``map<string,string>`` (nested values
    come back as JSON text), which gives both the field values and whether
    a key is present; the envelope's payload is parsed a second time only
    when it is an object.
    """
    as_map = "map<string,string>"
    value = F.col("value").cast("string")
    r = records.where(value.isNotNull()).select("*", F.from_json(value, as_map).alias("_root"))
    payload = F.col("_root").getItem("payload")
    is_envelope = F.coalesce(F.ltrim(payload).startswith("{"), F.lit(False))
    r = r.where(F.col("_root").isNotNull()).select(
        "*", F.when(is_envelope, F.from_json(payload, as_map)).otherwise(F.col("_root")).alias("_row"))
    row = F.col("_row")
    op = F.coalesce(header(F.col("headers"), "op", "__op"), row.getItem("__op"))
    amount_text = row.getItem("amount")
    amount = F.expr("try_cast(_row['amount'] AS DECIMAL(20,6))")
    currency = F.when(F.map_contains_key(row, "currency"), row.getItem("currency")) \
                .otherwise(F.lit(config.DEFAULT_CURRENCY))
    created_text = row.getItem("created_at")
    parsed = F.expr("try_cast(_row['created_at'] AS TIMESTAMP)")
    created = F.when(F.coalesce(created_text, F.lit("")) == "", F.current_timestamp()).otherwise(parsed)
    out = r.where(F.col("_row").isNotNull()).select(
        sequence().alias("seq"),
        row.getItem("id").alias("id"),
        row.getItem("account_id").alias("account_id"),
        amount.alias("amount"),
        currency.alias("currency"),
        created.cast("timestamp_ntz").alias("created_at"),
        op.alias("op"),
        amount_text.alias("_amount_text"),
    )
    keep = (F.coalesce(F.col("op"), F.lit("")).isin("", "c") &
            F.col("account_id").isNotNull() & (F.col("account_id") != "") &
            F.col("_amount_text").isNotNull() & (F.col("_amount_text") != "") &
            F.col("amount").isNotNull() & F.col("created_at").isNotNull())
    return out.where(keep).drop("_amount_text")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds ``value`` as a generated column: filters and projections above don't compute it again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _object_or_payload(df: DataFrame, name: str, text: Column) -> DataFrame:
    """Adds a JSON object's fields as text, or those of the object under ``payload``; null if it is neither."""
    as_map = "map<string,string>"
    df = _once(df, f"{name}_whole", F.from_json(text, as_map))
    whole = F.col(f"{name}_whole")
    inner = whole.getItem("payload")
    return _once(df, name, F.when(F.coalesce(F.ltrim(inner).startswith("{"), F.lit(False)),
                                  F.from_json(inner, as_map)).otherwise(whole)).drop(f"{name}_whole")


def decode_rows(records: DataFrame, ddl: str) -> DataFrame:
    """Records of one table -> changes: ``_partition, _offset, op`` and the row's columns.

    ``ddl`` names the row's columns and types, its key first (``TABLES``).
    ``op`` is ``d`` for a row that is gone: by its header or ``__op`` field, by
    a field ``__deleted`` that says true, or as a tombstone (null value).  A
    change without an operation counts as ``c``; ``c``, ``u`` and ``r`` (snapshot)
    carry the row as it is.  A tombstone's key is the record's key: an object
    with the key column, such an object under ``payload``, or the bare value.

    Every text is parsed once: a parse that a filter or several columns use
    would otherwise be repeated for each of them.

    Dropped: values that are not JSON objects, other operations, changes
    without a key.  A column that is missing or doesn't parse is null.
    """
    fields = T.StructType.fromDDL(ddl).fields
    key = fields[0].name
    r = records.select("partition", "offset", "headers", "key", F.col("value").cast("string").alias("value"))
    r = _object_or_payload(r, "_row", F.col("value"))
    # a record's key counts only where the row doesn't name it
    r = _object_or_payload(r, "_key", F.when(F.col("_row").getItem(key).isNull(), F.col("key")))
    gone = F.col("value").isNull() | (F.lower(F.col("_row").getItem("__deleted")) == "true")
    op = F.lower(F.coalesce(header(F.col("headers"), "op", "__op"), F.col("_row").getItem("__op"), F.lit("c")))
    op = F.when(F.coalesce(gone, F.lit(False)), "d").when(op == "", "c").otherwise(op)
    bare = F.when(F.col("_key").isNull(), F.col("key"))
    columns = [F.coalesce(F.col("_row").getItem(key), F.col("_key").getItem(key), bare).alias(key)]
    for f in fields[1:]:
        kind = f.dataType.simpleString()
        via = "timestamp" if kind == "timestamp_ntz" else kind
        columns.append(F.expr(f"try_cast(_row['{f.name}'] AS {via})").cast(f.dataType).alias(f.name))
    out = r.where(F.col("value").isNull() | F.col("_row").isNotNull()).select(
        F.coalesce("partition", F.lit(0)).alias("_partition"), F.col("offset").alias("_offset"),
        op.alias("op"), *columns)
    return out.where(F.col("op").isin("c", "u", "r", "d") & F.col(key).isNotNull() & (F.col(key) != ""))


def to_change_records(changes: DataFrame, ddl: str) -> DataFrame:
    """Render changes (``_partition, _offset, op`` and a row's columns) as records.

    All the forms that ``decode_rows`` knows come up, by turns of the offset.
    """
    columns = []
    for f in T.StructType.fromDDL(ddl).fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "timestamp_ntz":
            c = F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    key, turn, gone = T.StructType.fromDDL(ddl).fields[0].name, F.col("_offset") % 3, F.col("op") == "d"
    row = F.struct(*columns)
    image = F.when(turn == 0, F.to_json(F.struct(F.lit("row").alias("schema"), row.alias("payload")))) \
        .otherwise(F.to_json(row))
    record_key = F.when(turn == 0, F.col(key)).when(turn == 1, F.to_json(F.struct(key))).otherwise(
        F.to_json(F.struct(F.lit("key").alias("schema"), F.struct(key).alias("payload"))))
    name = F.when(turn == 1, "__op").otherwise("op")
    return changes.select(
        record_key.alias("key"), F.when(~gone | (turn == 2), image).alias("value"),
        F.array(F.struct(name.alias("key"), F.col("op").alias("value"))).alias("headers"),
        F.col("_partition").cast("int").alias("partition"), F.col("_offset").cast("long").alias("offset"))


def with_event_micros(events: DataFrame) -> DataFrame:
    return events.withColumn("ts_us", epoch_micros("created_at"))
