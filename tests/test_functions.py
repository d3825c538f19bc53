import json
import hashlib
import random
import uuid

from pyspark.sql import functions as F

from txnlake import config
from txnlake.functions.hashing import request_hash
from txnlake.functions.scalar import floor_window, full_match, iso_utc_micros, uuid5


def test_uuid5_matches_python(spark):
    rnd = random.Random(3)
    names = ["", "a", "A1:2024-01-01T00:05:00+00:00:VELOCITY_SUM", "héllo ✓"] + \
        ["".join(rnd.choice("abcXYZ:-0123 ") for _ in range(rnd.randint(1, 40))) for _ in range(200)]
    df = spark.createDataFrame([(n,) for n in names], "name STRING")
    got = {r.name: r.u for r in df.select("name", uuid5("name").alias("u")).collect()}
    ns = uuid.UUID(config.FLAG_NAMESPACE)
    assert got == {n: str(uuid.uuid5(ns, n)) for n in names}


def test_request_hash_matches_python_including_non_ascii(spark):
    rows = [("A1", "12.30", "VN", "VND", None, "coffee", "Cafe 1", "PAYMENT"),
            ("A2", "1.00", "VN", "USD", "tip ☕ and 😀", None, "Café Ré", "FEE")]
    cols = ["account_id", "amount", "country", "currency", "description", "merchant_category",
            "merchant_name", "type"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in cols))
    got = [r.h for r in df.select(request_hash("POST /v1/transactions", cols).alias("h")).collect()]
    want = []
    for row in rows:
        body = dict(zip(cols, row))
        text = json.dumps({"endpoint": "POST /v1/transactions", "body": body},
                          separators=(",", ":"), sort_keys=True)
        want.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
    assert got == want


def test_request_hash_matches_python_for_any_character(spark):
    """Control characters, quotes, backslashes, DEL and everything above, in short and long texts."""
    rnd = random.Random(8)
    codes = [*range(1, 160), 0xFF, 0x100, 0x2028, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    texts = [chr(c) for c in codes] + ["", "\\u001b", '"\\"'] + [
        "".join(chr(rnd.choice(codes)) for _ in range(rnd.randint(1, 30))) for _ in range(150)]
    df = spark.createDataFrame([(t, None) for t in texts], "b STRING, a STRING")
    got = {r.b: r.h for r in df.select("b", request_hash('POST "/x"', ["b", "a"]).alias("h")).collect()}
    for t in texts:
        want = json.dumps({"endpoint": 'POST "/x"', "body": {"a": None, "b": t}}, sort_keys=True,
                          separators=(",", ":"))
        assert got[t] == hashlib.sha256(want.encode()).hexdigest(), repr(t)


def test_full_match_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("VN",), ("VN\n",), ("vn",), ("VNM",)], "c STRING")
    got = [r.ok for r in df.select(full_match("c", "[A-Z]{2}").alias("ok")).collect()]
    assert got == [True, False, False, False]


def test_floor_window_and_iso(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 7, 59, 999999),)], "t TIMESTAMP_NTZ")
    s, e = floor_window("t", 300)
    r = df.select(s.alias("s"), e.alias("e"), iso_utc_micros("t").alias("iso")).collect()[0]
    assert r.s == dt.datetime(2024, 1, 1, 0, 5) and r.e == dt.datetime(2024, 1, 1, 0, 10)
    assert r.iso == "2024-01-01T00:07:59.999999+00:00"
