"""Velocity rule: goldens, batch = window model, skew slicing."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from txnlake import config
from txnlake.operators import velocity
from txnlake.streaming.velocity import window_totals

SCHEMA = "seq LONG, id STRING, account_id STRING, amount DECIMAL(20,6), currency STRING, created_at TIMESTAMP_NTZ, op STRING"


def window_model(events, window_s=300):
    """From the definition: an entry is gone once it and all before it were too old for a later arrival."""
    width, out = dt.timedelta(seconds=window_s), {}
    by_account = {}
    for e in sorted(events, key=lambda e: e[0]):
        by_account.setdefault(e[2], []).append((e[0], e[5], e[3]))
    for entries in by_account.values():
        for k, (seq, now, _) in enumerate(entries):
            # entry i has left if some arrival j <= k found entries 0..i too old
            gone = [any(all(t < entries[j][1] - width for _, t, _ in entries[:i + 1])
                        for j in range(i, k + 1)) for i in range(k + 1)]
            inside = [a for (_, t, a), g in zip(entries, gone) if not g and t >= now - width]
            out[seq] = (len(inside), sum(inside, Decimal(0)))
    return out


def fast_model(events, window_s=300):
    """The same, through the stream's window function (itself tested against the definition)."""
    out = {}
    for account in {e[2] for e in events}:
        mine = sorted((e for e in events if e[2] == account), key=lambda e: e[0])
        times = [int((e[5] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for e in mine]
        n, s, _ = window_totals(times, [int(e[3].scaleb(6)) for e in mine], 0, window_s * 1_000_000)
        out |= {e[0]: (a, Decimal(b).scaleb(-6)) for e, a, b in zip(mine, n, s)}
    return out


@pytest.mark.parametrize("ordered", [True, False])
def test_window_totals_equal_the_definition(ordered):
    for seed in range(6):
        rows = _events(60, 2, seed=seed, ordered=ordered, span_s=900)
        assert fast_model(rows) == window_model(rows)


def test_window_totals_go_on_from_held_entries():
    rows = _events(120, 1, seed=4, ordered=False, span_s=900)
    t = [int((e[5] - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) for e in rows]
    a = [int(e[3].scaleb(6)) for e in rows]
    whole = window_totals(t, a, 0, 300_000_000)
    n1, s1, front = window_totals(t[:50], a[:50], 0, 300_000_000)
    n2, s2, _ = window_totals(t[front:], a[front:], 50 - front, 300_000_000)
    assert (n1 + n2, s1 + s2) == whole[:2]


def _events(n, accounts, seed, ordered=True, span_s=3600):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    # microsecond offsets on a coarse grid, so equal times (ties) occur too
    draw = [rnd.randint(0, span_s * 4) * 250000 for _ in range(n)]
    times = sorted(draw) if ordered else draw
    rows = []
    for i, t in enumerate(times):
        acct = f"A{rnd.randint(0, accounts - 1)}"
        amt = Decimal(rnd.randint(1, 5000)) / Decimal(100)
        rows.append((i, str(i), acct, amt, "VND" if acct[-1] in "02468" else "USD",
                     base + dt.timedelta(microseconds=t), "c"))
    return rows


def test_six_payments_golden(spark):
    base = dt.datetime(2024, 3, 1, 10, 0, 0)
    rows = [(i, f"t{i}", "ACC1", Decimal("250000.00"), "VND", base + dt.timedelta(seconds=10 * i), "c")
            for i in range(6)]
    hits = velocity.velocity_hits(spark.createDataFrame(rows, SCHEMA)).orderBy("seq").collect()
    assert [(h.seq, h.count_5m, h.sum_5m, h.reason) for h in hits] == [
        (4, 5, Decimal("1250000.000000"), "VELOCITY_COUNT"),
        (5, 6, Decimal("1500000.000000"), "VELOCITY_COUNT")]
    flags = velocity.flags(spark.createDataFrame(hits)).collect()
    assert len(flags) == 1 and flags[0].count_5m == 5
    assert flags[0].window_start == dt.datetime(2024, 3, 1, 10, 0)
    assert flags[0].window_end == dt.datetime(2024, 3, 1, 10, 5)


def test_batch_equals_model_on_ordered_input(spark):
    rows = _events(600, 7, seed=11)
    got = {r.seq: (r.count_5m, r.sum_5m) for r in
           velocity.trailing_window(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == fast_model(rows)


def test_time_slices_do_not_change_results(spark):
    rows = _events(800, 3, seed=5, span_s=4 * 3600)
    df = spark.createDataFrame(rows, SCHEMA)
    small = config.VelocityConfig(slice_seconds=300)
    large = config.VelocityConfig(slice_seconds=10 ** 7)
    a = {r.seq: (r.count_5m, r.sum_5m) for r in velocity.trailing_window(df, small).collect()}
    b = {r.seq: (r.count_5m, r.sum_5m) for r in velocity.trailing_window(df, large).collect()}
    assert a == b == fast_model(rows)


def test_ties_count_only_earlier_arrivals(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [(i, str(i), "A1", Decimal("1"), "USD", t, "c") for i in range(3)]
    got = sorted((r.seq, r.count_5m) for r in
                 velocity.trailing_window(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_null_currency_uses_other_threshold(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(0, "x", "A1", Decimal("150"), None, t, "c")]
    hits = velocity.velocity_hits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [h.reason for h in hits] == ["VELOCITY_SUM"]


def test_flag_id_is_uuid5(spark):
    import uuid
    t = dt.datetime(2024, 1, 1, 0, 3, 0)
    rows = [(0, "x", "A1", Decimal("150"), "USD", t, "c")]
    hit = velocity.velocity_hits(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    ns = uuid.UUID(config.FLAG_NAMESPACE)
    assert hit.event_id == str(uuid.uuid5(ns, "A1:2024-01-01T00:05:00+00:00:VELOCITY_SUM"))


def test_alert_message_shape(spark):
    import json
    t = dt.datetime(2024, 1, 1, 0, 3, 0)
    rows = [(0, "tx9", "A1", Decimal("150"), "USD", t, "c")]
    msg = velocity.alert_messages(velocity.velocity_hits(spark.createDataFrame(rows, SCHEMA))).collect()[0]
    body = json.loads(msg.value)
    assert msg.key == "A1"
    assert body["window"] == {"start": "2024-01-01T00:00:00+00:00", "end": "2024-01-01T00:05:00+00:00"}
    assert body["sum_5m"] == "150.000000" and body["count_5m"] == 1 and body["tx_example"] == "tx9"


def test_events_without_a_time_are_kept(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(k, f"t{k}", "a" if k != 4 else None, Decimal(k), "USD", at, "c") for k, at in enumerate(
        [None, t, None, t + dt.timedelta(seconds=10), None, None, t + dt.timedelta(days=3)], 1)]
    got = {r.seq: (r.count_5m, r.sum_5m) for r in
           velocity.trailing_window(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (1, 1), 3: (2, 4), 5: (3, 9), 6: (4, 15),  # by arrival among themselves
                   2: (1, 2), 4: (1, 4), 7: (1, 7)}
