"""Stream: decode guards, stream = window model (also out of order), restart."""

import datetime as dt
import json
import tempfile
from decimal import Decimal


from txnlake.sources import cdc
from txnlake.streaming.velocity import read_alerts, read_flags, start_velocity_stream
from tests.test_velocity import SCHEMA, _events, fast_model


def _write_records(spark, rows, path):
    df = spark.createDataFrame(rows, SCHEMA)
    cdc.to_records(df).coalesce(1).write.mode("append").json(path)


def test_decode_guards(spark, tmp_path):
    lines = [
        {"value": None, "offset": 1},
        {"value": "[1, 2]", "offset": 2},
        {"value": "not json", "offset": 3},
        {"value": json.dumps({"id": "x", "account_id": "A1"}), "offset": 4},             # no amount
        {"value": json.dumps({"id": "x", "account_id": "A1", "amount": "abc"}), "offset": 5},
        {"value": json.dumps({"id": "x", "account_id": "A1", "amount": "5"}), "offset": 6,
         "headers": [{"key": "OP", "value": "u"}]},                                        # update
        {"value": json.dumps({"payload": {"id": "p", "account_id": "A2", "amount": "7.5",
                                          "currency": "USD", "created_at": "2024-01-01T00:00:01Z"}}),
         "offset": 7, "headers": [{"key": "__op", "value": "c"}]},
        {"value": json.dumps({"id": "b", "account_id": "A3", "amount": 3,
                              "created_at": "2024-01-01T00:00:02.5+00:00"}), "offset": 8},  # no currency
        {"value": json.dumps({"id": "n", "account_id": "A4", "amount": "1", "currency": None,
                              "created_at": "2024-01-01T00:00:03Z", "__op": "c"}), "offset": 9},
        {"value": json.dumps({"id": "d", "account_id": "A5", "amount": "2", "__op": "d",
                              "created_at": "2024-01-01T00:00:03Z"}), "offset": 10},
    ]
    p = tmp_path / "in.json"
    p.write_text("\n".join(json.dumps(x) for x in lines))
    out = cdc.decode(spark.read.schema(cdc.RECORD_SCHEMA).json(str(p))).orderBy("seq").collect()
    assert [(r.seq, r.account_id, r.amount, r.currency) for r in out] == [
        (7, "A2", Decimal("7.500000"), "USD"),
        (8, "A3", Decimal("3.000000"), "VND"),
        (9, "A4", Decimal("1.000000"), None),
    ]
    assert out[1].created_at == dt.datetime(2024, 1, 1, 0, 0, 2, 500000)


def _run(spark, src, sink, ckpt, files_per_trigger=None):
    q = start_velocity_stream(spark, src, sink, ckpt, max_files_per_trigger=files_per_trigger)
    q.awaitTermination()


def test_stream_equals_model_out_of_order_and_restart(spark):
    rows = _events(500, 4, seed=21, ordered=False, span_s=1800)
    base = tempfile.mkdtemp(prefix="velo-")
    src, sink, ckpt = f"{base}/src", f"{base}/sink", f"{base}/ckpt"
    chunks = [rows[i:i + 125] for i in range(0, len(rows), 125)]
    # two files, run, then two more files and a restart from the checkpoint
    for c in chunks[:2]:
        _write_records(spark, c, src)
    _run(spark, src, sink, ckpt, files_per_trigger=1)
    for c in chunks[2:]:
        _write_records(spark, c, src)
    _run(spark, src, sink, ckpt, files_per_trigger=1)

    model = fast_model(rows)
    alerts = read_alerts(spark, sink).collect()
    want_hits = {s for s, (n, t) in model.items()
                 if n >= 5 or t >= (Decimal(2000000) if rows[s][4] == "VND" else Decimal(100))}
    assert {a.seq for a in alerts} == want_hits
    for a in alerts:
        assert (a.count_5m, a.sum_5m) == model[a.seq]
    flags = read_flags(spark, sink)
    assert flags.count() == flags.select("event_id").distinct().count()
    # flags hold the first hit per id, as a one-shot batch computation gives
    from txnlake.operators import velocity
    first = velocity.flags(spark.createDataFrame(alerts))
    assert sorted((r.event_id, r.count_5m) for r in first.collect()) == \
        sorted((r.event_id, r.count_5m) for r in flags.collect())


def test_orphan_flags_wait_for_their_account(spark, tmp_path):
    """Flags of an unknown account are parked, and stored once it has arrived; the source is a DataFrame."""
    from txnlake.streaming.velocity import read_orphans
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    t0 = dt.datetime(2024, 1, 1)
    rows = lambda lo, hi: [(k, str(k), ["A1", "A2"][k % 2], Decimal(900), "USD",
                            t0 + dt.timedelta(minutes=k), "c") for k in range(lo, hi)]
    known = ["A1"]
    accounts = lambda s: s.createDataFrame([(a,) for a in known], "id STRING")

    def run():
        stream = spark.readStream.schema(cdc.RECORD_SCHEMA).json(src)
        start_velocity_stream(spark, stream, sink, ckpt, accounts=accounts).awaitTermination()

    _write_records(spark, rows(0, 10), src)
    run()
    parked = read_orphans(spark, sink)
    assert {r.account_id for r in parked.collect()} == {"A2"} and parked.count() > 0
    assert {r.account_id for r in read_flags(spark, sink).collect()} == {"A1"}
    waiting = {r.event_id for r in parked.collect()}
    known.append("A2")
    _write_records(spark, rows(10, 12), src)
    run()
    assert read_orphans(spark, sink).count() == 0
    flags = read_flags(spark, sink)
    assert waiting <= {r.event_id for r in flags.collect()}
    # by event time nothing is recent; by storing time all is, and in the last batch what had waited
    from txnlake.operators import marts
    assert marts.serve_risk_flags(flags).count() == 0
    assert marts.serve_risk_flags(flags, by="stored_at").count() == flags.count()
    last = flags.where(flags.stored_at == flags.agg({"stored_at": "max"}).first()[0])
    assert waiting <= {r.event_id for r in last.collect()}
    assert flags.count() == flags.select("event_id").distinct().count()


def test_late_events_go_aside_and_state_ends_with_the_watermark(spark, tmp_path):
    """A late event counts nowhere; the others count as if it weren't there; timers leave no state behind."""
    from txnlake.config import VelocityConfig
    from txnlake.streaming.velocity import read_late
    src, sink, ckpt = str(tmp_path / "src"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    t0, cfg = dt.datetime(2024, 1, 1), VelocityConfig(lateness_seconds=60)
    row = lambda k, account, second: (k, str(k), account, Decimal(150), "USD",
                                      t0 + dt.timedelta(seconds=second), "c")
    batches = [[row(k, ["A1", "A2"][k % 2], k) for k in range(100)] + [row(100, "A3", 200)],
               # the watermark is at 140 s: 139 s is late, 140 s is not; an account may have late events only
               [row(101, "A1", 139), row(102, "A1", 140), row(103, "A4", 30), row(104, "A2", 150)],
               # far ahead: nothing of before can count any more
               [row(105, "A5", 4000)]]
    late = {101, 103}
    for batch in batches:
        _write_records(spark, batch, src)
        start_velocity_stream(spark, src, sink, ckpt, cfg).awaitTermination()
    assert {r.seq for r in read_late(spark, sink).collect()} == late
    model = fast_model([r for b in batches for r in b if r[0] not in late])
    alerts = read_alerts(spark, sink).collect()
    assert {a.seq: (a.count_5m, a.sum_5m) for a in alerts} == model  # every single event is over the sum
    state = spark.read.format("statestore").option("path", ckpt).option("stateVarName", "window").load()
    assert {r.key.account_id for r in state.select("key").collect()} == {"A5"}


def test_ingest_stream_is_the_same_for_any_split_and_after_a_replay(spark, tmp_path):
    """However requests are dealt into batches, a key's first valid request claims it; replayed batches agree."""
    from pyspark.sql import functions as F
    from txnlake.operators import ingest
    from txnlake.streaming import ingest as stream_ingest
    t0 = dt.datetime(2024, 1, 1)
    cols = "seq LONG, idem_key STRING, account_id STRING, type STRING, amount STRING, currency STRING, " \
           "merchant_name STRING, merchant_category STRING, description STRING, country STRING, " \
           "created_at TIMESTAMP_NTZ"
    # a third of the requests on one key; invalid ones, unknown accounts, no keys, replays and conflicts
    rows = [(k, "hot" if k % 3 == 0 else None if k % 17 == 1 else f"k{k % 11}",
             "A9" if k % 7 == 2 else "A1", "PAYMENT", "0" if k % 5 == 4 else str(1 + k % 2), "VND", "Cafe", None,
             None, "VN", t0 + dt.timedelta(seconds=k)) for k in range(90)]
    accounts = lambda s: s.createDataFrame([("A1", "VND")], "id STRING, currency STRING")
    df = spark.createDataFrame(rows, cols)
    # only an answer of 201 names a transaction
    told = ["seq", "outcome", "code", F.when(F.col("code") == 201, F.col("transaction_id")).alias("id")]
    want = sorted(tuple(r) for r in ingest.classify_requests(df, accounts(spark)).select(*told).collect())
    assert {w[1] for w in want} >= {"NEW", "REPLAY", "CONFLICT", "INVALID", "UNKNOWN_ACCOUNT", "MISSING_KEY"}
    for name, cuts in (("one", [0, 90]), ("many", [0, 1, 4, 40, 41, 90])):
        sink = str(tmp_path / name)
        write = stream_ingest._classify_batch(sink, accounts, "POST /v1/transactions")
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            batch = df.where(F.col("seq").between(a, b - 1))
            write(batch, n)
            if n % 2 == 0:
                write(batch, n)  # the same batch again, after its claims were stored
        got = sorted(tuple(r) for r in stream_ingest.read_outcomes(spark, sink).select(*told).collect())
        assert got == want, name
        claims = stream_ingest.claims_table(spark, sink).read()
        assert claims.count() == claims.select("idem_key").distinct().count() == sum(w[1] == "NEW" for w in want)
        assert stream_ingest.read_transactions(spark, sink).count() == claims.count()
        assert stream_ingest.read_outbox(spark, sink).count() == claims.count()


class _Map(dict):
    """Map state in memory that counts what is read."""

    def __init__(self):
        super().__init__()
        self.read, self.written = 0, 0

    def getValue(self, key):
        self.read += 1
        return self[key]

    def updateValue(self, key, value):
        self.written += 1
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def containsKey(self, key):
        return key in self

    def iterator(self):
        return iter(list(self.items()))


class _Handle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, _Map())

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def _frame(rows):
    import pandas as pd
    us = [int((r[5] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for r in rows]
    return pd.DataFrame({"seq": [r[0] for r in rows], "id": [r[1] for r in rows], "account_id": [r[2] for r in rows],
                         "currency": [r[4] for r in rows], "amount": [r[3] for r in rows], "ts_us": us})


def test_chunked_state_equals_the_model_for_any_order_and_split():
    from txnlake.streaming.velocity import TrailingWindowProcessor
    for seed in range(30):
        rows = sorted(_events(150, 1, seed=seed, ordered=seed % 3 == 0, span_s=[300, 900, 3000][seed % 3]))
        got, size = {}, [1, 7, 40][seed // 3 % 3]
        processor = TrailingWindowProcessor(300, chunk=[2, 5, 16][seed % 3])
        processor.init(_Handle())
        for at in range(0, len(rows), size):
            for out in processor.handleInputRows(("A",), iter([_frame(rows[at:at + size])]), None):
                got |= {int(s): (n, x) for s, n, x in zip(out["seq"], out["count_5m"], out["sum_5m"])}
        assert got == fast_model(rows)


def test_a_batch_opens_only_chunks_that_it_can_change():
    from txnlake.streaming.velocity import TrailingWindowProcessor
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, str(k), "A", Decimal(1), "USD", t0 + dt.timedelta(milliseconds=25 * k), "c") for k in range(13000)]
    handle = _Handle()
    processor = TrailingWindowProcessor(300, chunk=100)
    processor.init(handle)
    list(processor.handleInputRows(("A",), iter([_frame(rows[:12900])]), None))
    entries = handle.maps["entries"]
    assert len(entries) > 100
    entries.read = entries.written = 0
    out, = processor.handleInputRows(("A",), iter([_frame(rows[12900:])]), None)
    assert out["count_5m"].tolist() == [12001] * 100
    assert entries.read <= 4 and entries.written <= 4


def test_an_idle_account_loses_its_state_by_one_timer():
    from types import SimpleNamespace
    from txnlake.streaming.velocity import TrailingWindowProcessor
    handle = _Handle()
    processor = TrailingWindowProcessor(300, idle_ttl_seconds=60)
    processor.init(handle)
    rows = _events(20, 1, seed=1)
    for at, now in ((0, 1000), (10, 9000)):
        list(processor.handleInputRows(("A",), iter([_frame(rows[at:at + 10])]), SimpleNamespace(
            getCurrentProcessingTimeInMs=lambda now=now: now)))
    assert handle.timers == [69000]
    list(processor.handleExpiredTimer(("A",), None, None))
    assert not handle.maps["window"] and not handle.maps["entries"]
