"""Create-request rules as batch jobs.

Requests arrive as rows with an arrival ``seq``.  The per-request handler
(validate -> look up key -> reserve -> domain checks -> insert) becomes a
set-based classification: a request claims its idempotency key only if it
passes every check, so the claimer of a key is its first fully valid
request; earlier requests of the key were rejected on their own, later ones
are replays (same canonical hash) or conflicts (other hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.hashing import request_hash
from txnlake.functions.scalar import full_match, iso_utc_micros, uuid5

# Namespace for deterministic transaction / outbox ids derived from the
# request key (RFC 4122 URL namespace; a retried task regenerates the same id).
ID_NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
EMAIL_PATTERN = r"[^@\s]+@[^@\s]+\.[^@\s]+"

TRANSACTION_BODY = ["account_id", "type", "amount", "currency", "merchant_name",
                    "merchant_category", "description", "country"]


def _errors(checks: list[tuple[str, Column]]) -> Column:
    """Comma-separated names of the failed checks, in the given order."""
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in checks])


def transaction_field_errors() -> Column:
    amount = F.expr("try_cast(amount AS DECIMAL(20,6))")
    return _errors([
        ("account_id", F.col("account_id").isNull()),
        ("type", F.col("type").isNull() | ~F.col("type").isin(*config.TRANSACTION_TYPES)),
        ("amount", amount.isNull() | (amount <= 0)),
        ("currency", F.col("currency").isNull() | ~full_match("currency", config.CURRENCY_PATTERN)),
        ("merchant_name", F.col("merchant_name").isNull()),
        ("country", F.col("country").isNull() | ~full_match("country", config.COUNTRY_PATTERN)),
    ])


def check_transactions(requests: DataFrame) -> DataFrame:
    return requests.withColumn("errors", transaction_field_errors())


def transaction_reasons(requests: DataFrame, accounts: DataFrame) -> DataFrame:
    """Field validation, account existence and currency agreement (no key logic)."""
    acc = accounts.select(F.col("id").alias("account_id"), F.col("currency").alias("_acc_cur"),
                          F.lit(True).alias("_acc"))
    j = check_transactions(requests).join(acc, "account_id", "left")
    return j.withColumn("reason", _domain_reason())


def _domain_reason() -> Column:
    return (F.when(F.col("errors") != "", F.lit("INVALID"))
             .when(F.col("_acc").isNull(), F.lit("UNKNOWN_ACCOUNT"))
             .when(F.col("currency") != F.col("_acc_cur"), F.lit("CURRENCY_MISMATCH"))
             .otherwise(F.lit("OK")))


#: Arrival order of keys that earlier batches have stored: before any request.
STORED_SEQ = -(1 << 62)


def classify_requests(requests: DataFrame, accounts: DataFrame,
                      endpoint: str = config.TRANSACTION_ENDPOINT,
                      stored: DataFrame | None = None) -> DataFrame:
    """Outcome and response code of every create-transaction request.

    INVALID 422 (field validation) -> MISSING_KEY 400 (null or empty) -> for a
    known key: REPLAY 201 (same hash as the claimer) / CONFLICT 409 ->
    UNKNOWN_ACCOUNT or CURRENCY_MISMATCH 400 -> NEW 201.

    ``stored`` holds the ``idempotency_records`` of earlier batches: their
    keys are claimed already.
    """
    r = transaction_reasons(requests, accounts).withColumn(
        "request_hash", request_hash(endpoint, TRANSACTION_BODY))
    has_key = F.coalesce(F.col("idem_key"), F.lit("")) != ""
    # first fully valid request per key; partial aggregation keeps a hot key cheap
    claimed = r.where((F.col("reason") == "OK") & has_key).select(
        F.col("idem_key").alias("_key"), F.col("seq"), F.col("request_hash").alias("hash"))
    if stored is not None:
        claimed = claimed.unionByName(stored.where(F.col("endpoint") == endpoint).select(
            F.col("idem_key").alias("_key"), F.lit(STORED_SEQ).alias("seq"),
            F.col("request_hash").alias("hash")))
    claims = claimed.groupBy("_key").agg(F.min(F.struct("seq", "hash")).alias("_c"))
    # rows without a key join nothing; a key of their own spreads them over the tasks
    own = F.concat(F.lit("\x00"), F.col("seq").cast("string"))
    j = r.withColumn("_key", F.when(has_key, F.col("idem_key")).otherwise(own)) \
         .join(claims, "_key", "left")
    claim_seq, claim_hash = F.col("_c.seq"), F.col("_c.hash")
    outcome = (F.when(F.col("reason") == "INVALID", F.lit("INVALID"))
                .when(~has_key, F.lit("MISSING_KEY"))
                .when(claim_seq.isNull() | (F.col("seq") < claim_seq), F.col("reason"))
                .when(F.col("seq") == claim_seq, F.lit("NEW"))
                .when(F.col("request_hash") == claim_hash, F.lit("REPLAY"))
                .otherwise(F.lit("CONFLICT")))
    code = (F.when(outcome == "INVALID", 422).when(outcome.isin("NEW", "REPLAY"), 201)
             .when(outcome == "CONFLICT", 409).otherwise(400))
    return j.withColumn("outcome", outcome).withColumn("code", code.cast("int")) \
            .withColumn("transaction_id", F.when(
                has_key & claim_seq.isNotNull(), transaction_id(endpoint, F.col("idem_key")))) \
            .drop("_c", "_key", "_acc", "_acc_cur")


def transaction_id(endpoint: str, key: Column) -> Column:
    return uuid5(F.concat(F.lit(endpoint + ":"), key), ID_NAMESPACE)


def new_transactions(classified: DataFrame) -> DataFrame:
    """Rows to insert for NEW requests: status PENDING, metadata ``{}``."""
    return classified.where(F.col("outcome") == "NEW").select(
        F.col("transaction_id").alias("id"), "account_id", "type",
        F.lit("PENDING").alias("status"),
        F.expr("cast(amount AS DECIMAL(20,6))").alias("amount"),
        F.col("amount").alias("amount_text"), "currency",
        "merchant_name", "merchant_category", "description", "country",
        F.lit("{}").alias("metadata"), "created_at", F.lit(None).cast("timestamp_ntz").alias("settled_at"))


def idempotency_records(classified: DataFrame, endpoint: str = config.TRANSACTION_ENDPOINT) -> DataFrame:
    """Stored (endpoint, key, hash, response code, response body) per claimed key."""
    body = F.to_json(F.struct(F.col("transaction_id").alias("id"), F.lit("PENDING").alias("status")))
    return classified.where(F.col("outcome") == "NEW").select(
        F.lit(endpoint).alias("endpoint"), "idem_key", "request_hash",
        F.lit(201).alias("response_code"), body.alias("response_body"), "created_at")


def outbox_events(new_txns: DataFrame) -> DataFrame:
    """One ``TransactionCreated`` event per new transaction; amount as text."""
    payload = F.to_json(F.struct(
        F.col("id"), F.col("account_id"), F.col("type"), F.col("status"),
        F.coalesce(F.col("amount_text"), F.col("amount").cast("string")).alias("amount"),
        F.col("currency"),
        F.col("merchant_name"), F.col("merchant_category"), F.col("country"),
        iso_utc_micros("created_at").alias("created_at")), {"ignoreNullFields": "false"})
    return new_txns.select(
        uuid5(F.concat(F.col("id"), F.lit(":TransactionCreated")), ID_NAMESPACE).alias("id"),
        F.lit("transaction").alias("aggregate_type"), F.col("id").alias("aggregate_id"),
        F.lit("TransactionCreated").alias("event_type"), payload.alias("payload_json"),
        "created_at")


def customer_outcomes(requests: DataFrame, existing: DataFrame) -> DataFrame:
    """CREATED 201 / CONFLICT 409 (email taken, case-insensitive) / INVALID.

    INVALID is 422 for a malformed field (email, country, a KYC level that is
    not a number) and 400 for a value that is not allowed (KYC level, risk band).
    Row checks come first (a rejected row never takes its email); among
    valid rows the first per ``lower(email)`` wins unless the email exists.
    """
    number = F.expr("try_cast(kyc_level AS INT)")
    kyc = F.coalesce(number, F.lit(config.DEFAULT_KYC_LEVEL))
    not_a_number = F.col("kyc_level").isNotNull() & number.isNull()
    band = F.coalesce(F.col("risk_band"), F.lit(config.DEFAULT_RISK_BAND))
    errors = _errors([
        ("email", F.col("email").isNull() | ~full_match("email", EMAIL_PATTERN)),
        ("country", F.col("country").isNull() | ~full_match("country", config.COUNTRY_PATTERN)),
        ("kyc_level", not_a_number | ~kyc.between(0, 3)),
        ("risk_band", ~band.isin(*config.RISK_BANDS)),
    ])
    r = requests.withColumn("errors", errors).withColumn("_email", F.coalesce(F.lower("email"), F.concat(
        F.lit("\x00"), F.col("seq").cast("string"))))
    taken = existing.select(F.lower("email").alias("_email")).distinct() \
                    .withColumn("_taken", F.lit(True))
    first = r.where(F.col("errors") == "").groupBy("_email").agg(F.min("seq").alias("_first"))
    j = r.join(first, "_email", "left").join(taken, "_email", "left")
    outcome = (F.when(F.col("errors") != "", F.lit("INVALID"))
                .when(F.coalesce(F.col("_taken"), F.lit(False)) | (F.col("seq") != F.col("_first")),
                      F.lit("CONFLICT"))
                .otherwise(F.lit("CREATED")))
    malformed = F.col("errors").rlike("email|country") | not_a_number
    code = (F.when(outcome == "CREATED", 201).when(outcome == "CONFLICT", 409)
             .when(malformed, 422).otherwise(400))
    return j.select(*requests.columns, "errors", outcome.alias("outcome"), code.cast("int").alias("code"))


def account_outcomes(requests: DataFrame, customers: DataFrame, existing: DataFrame) -> DataFrame:
    """CREATED 201 / CONFLICT 409 (open account per customer+currency) / INVALID 422 /
    UNKNOWN_CUSTOMER 400.

    Field checks, then the customer must exist, then at most one open
    (status <> CLOSED) account per (customer, currency): existing open
    accounts block, and among requests the first valid one wins.
    """
    country = F.coalesce(F.col("country"), F.lit(config.DEFAULT_ACCOUNT_COUNTRY))
    errors = _errors([
        ("customer_id", F.col("customer_id").isNull()),
        ("currency", F.col("currency").isNull() | ~full_match("currency", config.CURRENCY_PATTERN)),
        ("country", ~full_match(country, config.COUNTRY_PATTERN)),
    ])
    cust = customers.select(F.col("id").alias("customer_id"), F.lit(True).alias("_cust"))
    open_acc = existing.where(F.col("status") != "CLOSED") \
                       .select("customer_id", "currency").distinct().withColumn("_open", F.lit(True))
    r = requests.withColumn("errors", errors).join(cust, "customer_id", "left")
    valid = (F.col("errors") == "") & F.col("_cust").isNotNull()
    first = r.where(valid).groupBy("customer_id", "currency").agg(F.min("seq").alias("_first"))
    j = r.join(first, ["customer_id", "currency"], "left") \
         .join(open_acc, ["customer_id", "currency"], "left")
    outcome = (F.when(F.col("errors") != "", F.lit("INVALID"))
                .when(F.col("_cust").isNull(), F.lit("UNKNOWN_CUSTOMER"))
                .when(F.coalesce(F.col("_open"), F.lit(False)) | (F.col("seq") != F.col("_first")),
                      F.lit("CONFLICT"))
                .otherwise(F.lit("CREATED")))
    code = F.when(outcome == "CREATED", 201).when(outcome == "CONFLICT", 409) \
            .when(outcome == "INVALID", 422).otherwise(400)
    return j.select(*requests.columns, "errors", outcome.alias("outcome"),
                    code.cast("int").alias("code"))


def cascade_delete(customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                   flags: DataFrame, deleted_customers: DataFrame) -> dict[str, DataFrame]:
    """Remaining rows after deleting customers (accounts, transactions, flags follow)."""
    cust = customers.join(deleted_customers.select("id"), "id", "left_anti")
    acc = accounts.join(cust.select(F.col("id").alias("customer_id")), "customer_id", "left_semi")
    acc_ids = acc.select(F.col("id").alias("account_id"))
    return {
        "customers": cust,
        "accounts": acc,
        "transactions": transactions.join(acc_ids, "account_id", "left_semi"),
        "risk_flags": flags.join(acc_ids, "account_id", "left_semi"),
    }


def with_updated_at(df: DataFrame, as_of: Column | str) -> DataFrame:
    """Refresh ``updated_at`` to the time of the update (explicit, never the clock)."""
    ts = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return df.withColumn("updated_at", ts)


def new_customers(outcomes: DataFrame, created_at: Column | str) -> DataFrame:
    """Customer rows for CREATED requests, with the create defaults applied."""
    ts = F.lit(created_at).cast("timestamp_ntz") if isinstance(created_at, str) else created_at
    return outcomes.where(F.col("outcome") == "CREATED").select(
        uuid5(F.concat(F.lit("customer:"), F.lower("email")), ID_NAMESPACE).alias("id"),
        "email", "country",
        F.coalesce(F.expr("try_cast(kyc_level AS INT)"), F.lit(config.DEFAULT_KYC_LEVEL)).cast("smallint").alias("kyc_level"),
        F.coalesce(F.col("risk_band"), F.lit(config.DEFAULT_RISK_BAND)).alias("risk_band"),
        ts.alias("created_at"), ts.alias("updated_at"))


def new_accounts(outcomes: DataFrame, created_at: Column | str) -> DataFrame:
    """Account rows for CREATED requests: status ACTIVE, country default VN."""
    ts = F.lit(created_at).cast("timestamp_ntz") if isinstance(created_at, str) else created_at
    return outcomes.where(F.col("outcome") == "CREATED").select(
        uuid5(F.concat_ws(":", F.lit("account"), "customer_id", "currency", F.col("seq").cast("string")),
              ID_NAMESPACE).alias("id"),
        "customer_id", "currency",
        F.coalesce(F.col("country"), F.lit(config.DEFAULT_ACCOUNT_COUNTRY)).alias("country"),
        F.lit("ACTIVE").alias("status"), ts.alias("created_at"), ts.alias("updated_at"))

