import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from txnlake.operators import marts
from txnlake.sources.tables import AppendTable, VersionedTable, WatermarkTable


def test_insert_if_absent_twice_equals_once(spark):
    path = tempfile.mkdtemp(prefix="app-") + "/t"
    t = AppendTable(spark, path, ["id"])
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "id STRING, v INT")
    t.insert_if_absent(batch, order_by=["v"])
    t.insert_if_absent(batch, order_by=["v"])
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", 1), ("b", 5)]


def test_versioned_table_pointer_flip(spark):
    root = tempfile.mkdtemp(prefix="ver-")
    vt = VersionedTable(spark, root)
    assert vt.read() is None
    vt.overwrite(spark.range(3).toDF("x"))
    first = vt.current_path()
    vt.overwrite(vt.read().where("x > 0"))   # reads the old version, writes a new one
    assert vt.current_path() != first and vt.read().count() == 2


def test_watermark_table(spark):
    wm = WatermarkTable(spark, tempfile.mkdtemp(prefix="wm-"))
    assert wm.get("transactions") == dt.datetime(1970, 1, 1)
    wm.set_from("transactions", spark.createDataFrame([(dt.datetime(2024, 1, 2),)], "m TIMESTAMP_NTZ"))
    wm.set_from("customers", spark.createDataFrame([(dt.datetime(2024, 1, 3),)], "m TIMESTAMP_NTZ"))
    assert wm.get("transactions") == dt.datetime(2024, 1, 2)
    assert wm.get("customers") == dt.datetime(2024, 1, 3)


@pytest.mark.parametrize("bad", [0, 366, "7", True])
def test_serving_parameter_bounds(spark, bad):
    gmv = spark.createDataFrame([], "day_utc DATE, currency STRING, tx_count LONG, total_amount DECIMAL(38,6)")
    with pytest.raises(ValueError):
        marts.serve_gmv_daily(gmv, "VND", bad, "2024-01-01")


def test_serving_limits(spark):
    mart = spark.createDataFrame([], "merchant_name_norm STRING, tx_count LONG, total_amount DECIMAL(38,6)")
    with pytest.raises(ValueError):
        marts.serve_top_merchants(mart, 101)
    with pytest.raises(ValueError):
        marts.serve_gmv_daily(spark.createDataFrame([], "day_utc DATE, currency STRING"), "VNDX", 3, "2024-01-01")
    flags = spark.createDataFrame([], "account_id STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, count_5m LONG, sum_5m DECIMAL(38,6), reason STRING, created_at TIMESTAMP_NTZ")
    with pytest.raises(ValueError):
        marts.serve_risk_flags(flags, 25)


def test_top_merchants_current_vs_any_version(spark):
    from decimal import Decimal
    fact = spark.createDataFrame(
        [(1, Decimal("10"), "VND", dt.datetime(2024, 1, 9)), (2, Decimal("5"), "USD", dt.datetime(2024, 1, 9)),
         (3, Decimal("7"), "VND", dt.datetime(2023, 1, 1))],
        "merchant_sk LONG, amount DECIMAL(20,6), currency STRING, created_at TIMESTAMP_NTZ")
    dim = spark.createDataFrame([(1, "cafe", False), (2, "cafe", True), (3, "shop", True)],
                                "merchant_sk LONG, merchant_name_norm STRING, is_current BOOLEAN")
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    cur = [tuple(r) for r in marts.top_merchants(fact, dim, as_of).collect()]
    assert cur == [("cafe", 1, Decimal("5.000000"))]       # spend under version 1 drops out
    by_name = sorted(tuple(r) for r in marts.top_merchants(fact, dim, as_of, by="name").collect())
    assert by_name == [("cafe", "USD", 1, Decimal("5.000000")), ("cafe", "VND", 1, Decimal("10.000000"))]


def test_lookback_rereads_are_removed_by_insert_if_absent(spark):
    from txnlake.operators.incremental import incremental, next_watermark
    src = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 10, 0)), ("b", dt.datetime(2024, 1, 1, 11, 0)),
         ("late", dt.datetime(2024, 1, 1, 10, 55))],   # committed after the first run read 11:00
        "id STRING, created_at TIMESTAMP_NTZ")
    path = tempfile.mkdtemp(prefix="lb-") + "/t"
    table = AppendTable(spark, path, ["id"])
    first = src.where(F.col("id") != "late")
    assert table.insert_if_absent(incremental(first, "2024-01-01 00:00:00"), ["created_at"]) == 2
    wm = first.agg(next_watermark(first, "2024-01-01 00:00:00")).collect()[0][0]
    assert wm == dt.datetime(2024, 1, 1, 11, 0)
    # without a margin the late row is missed; with a 10-minute lookback it is
    # read, and the re-read copy of "b" is not appended twice
    assert incremental(src, wm).count() == 0
    again = incremental(src, wm, lookback="10 minutes")
    assert table.insert_if_absent(again, ["created_at"]) == 1
    assert sorted(r.id for r in table.read().collect()) == ["a", "b", "late"]
