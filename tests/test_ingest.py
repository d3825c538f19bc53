"""Ingest rules: idempotency scenario, sequential model on the fixture, outbox."""

import datetime as dt
import json

from pyspark.sql import functions as F

from txnlake.operators import ingest
from txnlake.plans import queries as Q
from txnlake.sources import fixtures as fx

REQ = ("seq LONG, idem_key STRING, account_id STRING, type STRING, amount STRING, currency STRING, "
       "merchant_name STRING, merchant_category STRING, description STRING, country STRING, "
       "created_at TIMESTAMP_NTZ")
ACC = "id STRING, customer_id STRING, currency STRING, country STRING, status STRING"


def _req(seq, key, amount, acct="A1", cur="VND", country="VN", typ="PAYMENT"):
    return (seq, key, acct, typ, amount, cur, "Cafe", None, None, country,
            dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seq))


def test_replay_and_conflict(spark):
    accounts = spark.createDataFrame([("A1", "C1", "VND", "VN", "ACTIVE")], ACC)
    reqs = spark.createDataFrame([
        _req(1, "k1", "123.45"), _req(2, "k1", "123.45"), _req(3, "k1", "200.00"),
        _req(4, None, "1.00"), _req(5, "k2", "-1"), _req(6, "k3", "5", acct="A9"),
        _req(7, "k3", "5"), _req(8, "k3", "5"), _req(9, "k4", "5", cur="USD")], REQ)
    out = {r.seq: (r.outcome, r.code) for r in ingest.classify_requests(reqs, accounts).collect()}
    assert out == {1: ("NEW", 201), 2: ("REPLAY", 201), 3: ("CONFLICT", 409),
                   4: ("MISSING_KEY", 400), 5: ("INVALID", 422), 6: ("UNKNOWN_ACCOUNT", 400),
                   7: ("NEW", 201), 8: ("REPLAY", 201), 9: ("CURRENCY_MISMATCH", 400)}
    # k3: the failed request 6 rolled back, so 7 (first valid) claims the key


def test_stored_keys_and_empty_keys(spark):
    accounts = spark.createDataFrame([("A1", "C1", "VND", "VN", "ACTIVE")], ACC)
    first = ingest.classify_requests(spark.createDataFrame(
        [_req(1, "k1", "123.45"), _req(2, "", "1.00"), _req(3, None, "1.00")], REQ), accounts)
    assert {r.seq: (r.outcome, r.code) for r in first.collect()} == {
        1: ("NEW", 201), 2: ("MISSING_KEY", 400), 3: ("MISSING_KEY", 400)}
    stored = ingest.idempotency_records(first)
    assert [(r.idem_key, r.response_code) for r in stored.collect()] == [("k1", 201)]
    again = ingest.classify_requests(spark.createDataFrame(
        [_req(1, "k1", "123.45"), _req(2, "k1", "200.00"), _req(3, "k2", "5")], REQ), accounts,
        stored=stored)
    got = {r.seq: (r.outcome, r.code, r.transaction_id) for r in again.collect()}
    known = first.where("seq = 1").first().transaction_id
    assert got[1] == ("REPLAY", 201, known) and got[2][:2] == ("CONFLICT", 409)
    assert got[3][:2] == ("NEW", 201)


def test_bad_request_input_is_not_defaulted(spark, tmp_path):
    from txnlake.sources.requests import read_requests
    p = tmp_path / "in.json"
    p.write_text('{"seq": 1, "email": "a@x.com", "country": "VN", "kyc_level": "abc"}\nnot json\n'
                 '{"seq": 2, "email": "b@x.com", "country": "VN", "kyc_level": 9}\n'
                 '{"seq": 3, "email": "c@x.com", "country": "VN"}')
    rows = read_requests(spark, str(p), "customers")
    assert [r.seq for r in rows.collect() if r._corrupt_record] == [None]
    out = ingest.customer_outcomes(rows.where("seq is not null"),
                                   spark.createDataFrame([], "id STRING, email STRING"))
    assert {r.seq: (r.outcome, r.code) for r in out.collect()} == {
        1: ("INVALID", 422), 2: ("INVALID", 400), 3: ("CREATED", 201)}


def sequential_model(requests, accounts):
    """Per-request handler order: validate, key, lookup, domain checks, claim."""
    acc = {a["id"]: a["currency"] for a in accounts}
    store, out = {}, {}
    for r in sorted(requests, key=lambda r: r["seq"]):
        if r["errors"]:
            out[r["seq"]] = "INVALID"
            continue
        if r["idem_key"] is None:
            out[r["seq"]] = "MISSING_KEY"
            continue
        if r["idem_key"] in store:
            out[r["seq"]] = "REPLAY" if store[r["idem_key"]] == r["request_hash"] else "CONFLICT"
            continue
        if r["account_id"] not in acc:
            out[r["seq"]] = "UNKNOWN_ACCOUNT"
            continue
        if r["currency"] != acc[r["account_id"]]:
            out[r["seq"]] = "CURRENCY_MISMATCH"
            continue
        store[r["idem_key"]] = r["request_hash"]
        out[r["seq"]] = "NEW"
    return out


def test_set_based_equals_sequential_on_fixture(spark, sf_small):
    classified = Q.classified_df(spark, sf_small).collect()
    accounts = [r.asDict() for r in fx.accounts(spark, sf_small).collect()]
    model = sequential_model([r.asDict() for r in classified], accounts)
    assert {r.seq: r.outcome for r in classified} == model
    assert {"NEW", "REPLAY", "CONFLICT", "INVALID"} <= set(model.values())


def test_fixture_outcome_counts_sf001(spark):
    counts = {r.outcome: r["count"] for r in
              Q.classified_df(spark, "/root/testdata/sf0.01").groupBy("outcome").count().collect()}
    assert counts["NEW"] == 4433 and counts["REPLAY"] == 1383 and counts["CONFLICT"] == 1166
    assert counts["INVALID"] == 2397 and counts["MISSING_KEY"] == 141
    assert counts["UNKNOWN_ACCOUNT"] == 173 and counts["CURRENCY_MISMATCH"] == 307


def test_outbox_payload(spark):
    accounts = spark.createDataFrame([("A1", "C1", "VND", "VN", "ACTIVE")], ACC)
    reqs = spark.createDataFrame([_req(1, "k1", "123.45")], REQ)
    new = ingest.new_transactions(ingest.classify_requests(reqs, accounts))
    ev = ingest.outbox_events(new).collect()[0]
    body = json.loads(ev.payload_json)
    assert ev.event_type == "TransactionCreated" and ev.aggregate_type == "transaction"
    assert body["amount"] == "123.45" and body["status"] == "PENDING"
    assert body["created_at"] == "2024-01-01T00:00:01+00:00"
    assert body["merchant_category"] is None and body["id"] == ev.aggregate_id


def test_customers_and_accounts(spark):
    existing = spark.createDataFrame([("c0", "taken@x.com")], "id STRING, email STRING")
    reqs = spark.createDataFrame([
        (1, "a@x.com", "VN", 1, "LOW"), (2, "A@X.com", "VN", 1, "LOW"), (3, "TAKEN@x.com", "VN", 0, "LOW"),
        (4, "b@x.com", "VN", 7, "LOW"), (5, "b@x.com", "VN", 1, "LOW"), (6, "bad", "VN", 1, "LOW")],
        "seq LONG, email STRING, country STRING, kyc_level INT, risk_band STRING")
    out = {r.seq: r.outcome for r in ingest.customer_outcomes(reqs, existing).collect()}
    assert out == {1: "CREATED", 2: "CONFLICT", 3: "CONFLICT", 4: "INVALID", 5: "CREATED", 6: "INVALID"}
    customers = spark.createDataFrame([("1",), ("2",)], "id STRING")
    acc = spark.createDataFrame([("X", "2", "USD", "VN", "ACTIVE"), ("Y", "1", "USD", "VN", "CLOSED")], ACC)
    areq = spark.createDataFrame([(1, "1", "USD", "VN"), (2, "1", "USD", "VN"), (3, "2", "USD", "VN"),
                                  (4, "3", "USD", "VN"), (5, "1", "usd", "VN")],
                                 "seq LONG, customer_id STRING, currency STRING, country STRING")
    out = {r.seq: r.outcome for r in ingest.account_outcomes(areq, customers, acc).collect()}
    assert out == {1: "CREATED", 2: "CONFLICT", 3: "CONFLICT", 4: "UNKNOWN_CUSTOMER", 5: "INVALID"}


def test_request_files_roundtrip_and_defaults(spark, tmp_path):
    from txnlake.sources.requests import read_requests, write_requests
    reqs = spark.createDataFrame([(1, "x@y.com", "VN", None, None)],
                                 "seq LONG, email STRING, country STRING, kyc_level SMALLINT, risk_band STRING")
    write_requests(reqs, str(tmp_path / "c"))
    back = read_requests(spark, str(tmp_path / "c"), "customers")
    out = ingest.customer_outcomes(back, spark.createDataFrame([], "id STRING, email STRING"))
    row = ingest.new_customers(out, "2024-01-01 00:00:00").collect()[0]
    assert (row.kyc_level, row.risk_band, row.created_at) == (0, "LOW", dt.datetime(2024, 1, 1))
    touched = ingest.with_updated_at(spark.createDataFrame([row]), "2024-02-01 00:00:00").collect()[0]
    assert touched.updated_at == dt.datetime(2024, 2, 1)
