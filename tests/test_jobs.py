"""Hourly job: first run loads, re-run is a no-op, a later hour adds rows."""

import tempfile

from pyspark.sql import functions as F

from txnlake.plans import jobs
from txnlake.sources import fixtures as fx
from txnlake.sources.tables import VersionedTable


def _sources(spark, sf, until=None):
    txns = fx.transactions(spark, sf).select(*fx.TRANSACTION_COLUMNS)
    if until:
        txns = txns.where(F.col("created_at") <= F.lit(until).cast("timestamp_ntz"))
    return {"customers": fx.customers(spark, sf), "accounts": fx.accounts(spark, sf),
            "transactions": txns}


def test_hourly_job_is_incremental_and_idempotent(spark, sf_small):
    root = tempfile.mkdtemp(prefix="wh-")
    r1 = jobs.run_hourly(spark, root, _sources(spark, sf_small, "1998-01-01"), "2001-12-01 00:00:00")
    assert r1.fact_appended > 0 and r1.staged["transactions"] > 0
    r2 = jobs.run_hourly(spark, root, _sources(spark, sf_small, "1998-01-01"), "2001-12-01 01:00:00")
    assert r2.fact_appended == 0 and r2.staged["transactions"] == 0
    r3 = jobs.run_hourly(spark, root, _sources(spark, sf_small), "2001-12-01 02:00:00")
    assert r3.fact_appended > 0

    fact = spark.read.parquet(f"{root}/cur/fact_transactions")
    stg = spark.read.parquet(f"{root}/stg/transactions")
    # every staged transaction is in the fact exactly once or waits as unresolved
    assert fact.count() == fact.select("transaction_bk", "created_date").distinct().count()
    unresolved = VersionedTable(spark, f"{root}/cur/fact_unresolved").read().count()
    assert fact.count() + unresolved == stg.count()
    # one current row per key in every dimension, keys stable and unique
    for name, bk, sk in [("dim_customer", "customer_bk", "customer_sk"),
                         ("dim_account", "account_bk", "account_sk"),
                         ("dim_merchant", "merchant_name_norm", "merchant_sk")]:
        d = VersionedTable(spark, f"{root}/cur/{name}").read()
        assert d.where("is_current").groupBy(bk).count().where("count > 1").count() == 0
        assert d.select(sk).distinct().count() == d.count()
    gmv = VersionedTable(spark, f"{root}/cur/mv_gmv_daily").read()
    assert gmv.agg(F.sum("tx_count")).collect()[0][0] == fact.count()


def test_failed_gate_leaves_nothing_behind(spark, sf_small):
    """A batch that fails the gate fails again on the next run and reaches no table."""
    import pytest
    from txnlake.operators.quality import DataQualityError
    from txnlake.sources.tables import path_exists
    root = tempfile.mkdtemp(prefix="wh-")
    sources = _sources(spark, sf_small, "1996-01-01")
    bad = dict(sources, customers=sources["customers"].withColumn(
        "country", F.when(F.col("id") == "1", "v1").otherwise(F.col("country"))))
    for hour in (0, 1):
        with pytest.raises(DataQualityError):
            jobs.run_hourly(spark, root, bad, f"2001-12-01 0{hour}:00:00")
        assert not path_exists(spark, f"{root}/stg/customers")
        assert VersionedTable(spark, f"{root}/cur/dim_customer").read() is None
    fine = jobs.run_hourly(spark, root, sources, "2001-12-01 02:00:00")
    assert fine.staged["customers"] > 0


def test_rows_committed_after_the_extract_are_staged_next_time(spark, tmp_path):
    """The watermark comes from the stored batch, not from a second read of the source."""
    from txnlake.sources.tables import WatermarkTable
    src, root = str(tmp_path / "src"), str(tmp_path / "wh")
    row = lambda i, at, n: spark.createDataFrame([(i, {"k": n})], "id STRING, payload MAP<STRING, INT>") \
        .withColumn("created_at", F.lit(at).cast("timestamp_ntz"))
    row("a", "2024-01-01 00:00:00", 1).write.parquet(src)
    wm = WatermarkTable(spark, f"{root}/meta/watermarks")
    source = lambda: spark.read.parquet(src)
    batch = jobs._extract(spark, root, wm, "outbox", source(), "2024-02-01 00:00:00")
    row("b", "2024-01-02 00:00:00", 2).write.mode("append").parquet(src)
    assert jobs._append(spark, root, wm, "outbox", batch) == 1
    again = jobs._extract(spark, root, wm, "outbox", source(), "2024-02-01 01:00:00")
    assert jobs._append(spark, root, wm, "outbox", again) == 1
    stored = spark.read.parquet(f"{root}/stg/outbox").orderBy("id").collect()
    assert [(r.id, r.payload) for r in stored] == [("a", '{"k":1}'), ("b", '{"k":2}')]


def test_a_lost_flip_leaves_the_previous_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), keep=2)
    table.overwrite(spark.range(1))
    table.write(spark.range(2))  # a crash before the flip
    assert table.read().count() == 1
    for n in (3, 4, 5):
        table.overwrite(spark.range(n))
        assert table.read().count() == n
    assert len(table._pointers()) == 2


def test_bootstrap_demo_row(spark):
    """One current row per dimension and a fact row built from their keys."""
    import datetime as dt
    from txnlake.operators import facts, scd2
    from txnlake.operators.surrogate import dense_rank_keys
    t0 = dt.datetime(2024, 1, 1)
    cust = scd2.build_dim(spark.createDataFrame(
        [("C1", "demo@example.com", "VN", 1, "LOW", t0)],
        "id STRING, email STRING, country STRING, kyc_level INT, risk_band STRING, as_of TIMESTAMP_NTZ"),
        scd2.CUSTOMER_DIM)
    acc = scd2.build_dim(spark.createDataFrame(
        [("AA", "C1", "VND", "VN", "ACTIVE", t0, 1)],
        "id STRING, customer_bk STRING, currency STRING, country STRING, status STRING, as_of TIMESTAMP_NTZ, seq LONG"),
        scd2.ACCOUNT_DIM)
    mer = scd2.build_dim(spark.createDataFrame(
        [("Starbucks Phu Nhuan", "coffee", "VN", t0)],
        "merchant_name STRING, merchant_category STRING, country STRING, as_of TIMESTAMP_NTZ"),
        scd2.MERCHANT_DIM)
    keyed = [dense_rank_keys(d, [s.bk, "version"], out_col=sk) for d, s, sk in
             [(acc, scd2.ACCOUNT_DIM, "account_sk"), (cust, scd2.CUSTOMER_DIM, "customer_sk"),
              (mer, scd2.MERCHANT_DIM, "merchant_sk")]]
    txn = spark.createDataFrame(
        [("T11", "AA", "PAYMENT", "PENDING", "250000.00", "VND", " starbucks phu nhuan", "coffee", "VN",
          dt.datetime(2024, 1, 2, 3, 4, 5), None)],
        "id STRING, account_id STRING, type STRING, status STRING, amount STRING, currency STRING, "
        "merchant_name STRING, merchant_category STRING, country STRING, created_at TIMESTAMP_NTZ, "
        "settled_at TIMESTAMP_NTZ").withColumn("amount", F.col("amount").cast("decimal(20,6)"))
    fact, unresolved = facts.build_fact(txn, *keyed)
    row = fact.collect()[0]
    assert (row.customer_sk, row.account_sk, row.merchant_sk) == (1, 1, 1)
    assert row.created_date == dt.date(2024, 1, 2) and unresolved.count() == 0


TABLES = ["cur/dim_customer", "cur/dim_account", "cur/dim_merchant", "cur/fact_unresolved",
          "cur/mv_gmv_daily", "cur/mv_top_merchants"]


def _contents(spark, root):
    """Every table of the warehouse as sorted rows."""
    out = {t: VersionedTable(spark, f"{root}/{t}").read() for t in TABLES}
    out["fact"] = spark.read.parquet(f"{root}/cur/fact_transactions")
    for name in ("customers", "accounts", "transactions"):
        out[name] = spark.read.parquet(f"{root}/stg/{name}")
    return {n: sorted(map(str, df.select(*sorted(df.columns)).collect())) for n, df in out.items()}


class _Cut(Exception):
    pass


def _cutting(monkeypatch, step, before):
    """Let a run die right after ``step``'s work, or right after it was recorded."""
    from txnlake.sources.tables import RunLog
    real = RunLog.mark

    def mark(self, name, rows):
        if name == step and before:
            raise _Cut(name)
        real(self, name, rows)
        if name == step:
            raise _Cut(name)

    monkeypatch.setattr(RunLog, "mark", mark)


def test_a_run_cut_off_at_every_step_ends_with_the_same_tables(spark, sf_small, monkeypatch):
    """Run 2 dies at each step in turn, first before the step is recorded (so it is done twice), then
    after; every call goes on where the last one stopped."""
    import shutil
    first, second = "2001-12-01 00:00:00", "2001-12-01 01:00:00"
    base = tempfile.mkdtemp(prefix="wh-")
    jobs.run_hourly(spark, f"{base}/cut", _sources(spark, sf_small, "1998-01-01"), first)
    shutil.copytree(f"{base}/cut", f"{base}/plain")
    want = jobs.run_hourly(spark, f"{base}/plain", _sources(spark, sf_small), second)
    assert want.fact_appended > 0
    cuts = 0
    # of the dimensions and of the marts, which run side by side, one each: the others are done by then
    steps = ["extract.accounts", "validate", "stage.transactions", "dim.dim_customer", "resolve", "facts",
             "unresolved", "mart.gmv", "done"]
    for step in steps:
        for before in (True, False):
            with monkeypatch.context() as patch:
                _cutting(patch, step, before)
                try:
                    jobs.run_hourly(spark, f"{base}/cut", _sources(spark, sf_small), second)
                except _Cut:
                    cuts += 1
    assert cuts == 2 * len(steps)
    got = jobs.run_hourly(spark, f"{base}/cut", _sources(spark, sf_small), second)
    assert _contents(spark, f"{base}/cut") == _contents(spark, f"{base}/plain")
    assert got.watermarks == want.watermarks and got.unresolved == want.unresolved


def test_a_cut_before_the_mart_loses_no_day(spark, sf_small, monkeypatch):
    """Facts appended by a run that died before the mart are in it after the next run, whose batch is empty."""
    root = tempfile.mkdtemp(prefix="wh-")
    jobs.run_hourly(spark, root, _sources(spark, sf_small, "1998-01-01"), "2001-12-01 00:00:00")
    for before in (True, False):
        with monkeypatch.context() as patch:
            _cutting(patch, "facts", before)
            try:
                jobs.run_hourly(spark, root, _sources(spark, sf_small, "1999-06-01" if before else None),
                                f"2001-12-01 0{1 + before}:00:00")
            except _Cut:
                pass
    last = jobs.run_hourly(spark, root, _sources(spark, sf_small), "2001-12-01 05:00:00")
    assert last.fact_appended == 0
    gmv = VersionedTable(spark, f"{root}/cur/mv_gmv_daily").read()
    facts = spark.read.parquet(f"{root}/cur/fact_transactions").count()
    assert gmv.agg(F.sum("tx_count")).first()[0] == facts > 0


def test_updates_and_deletes_reach_staging_and_dimensions(spark, tmp_path):
    """Accounts as a change log: a closed account gets a second version, a deleted one leaves staging."""
    from txnlake.operators import changelog
    root = str(tmp_path / "wh")
    row = "_partition INT, _offset LONG, op STRING, id STRING, customer_id STRING, currency STRING, " \
          "country STRING, status STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
    import datetime as dt
    day = lambda n: dt.datetime(2024, 1, n)
    customers = spark.createDataFrame(
        [(str(i), f"c{i}@x.org", "VN", 1, "LOW", day(1), day(1)) for i in (1, 2)],
        "id STRING, email STRING, country STRING, kyc_level SMALLINT, risk_band STRING, "
        "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")
    txn = "id STRING, account_id STRING, type STRING, status STRING, amount DECIMAL(20,6), currency STRING, " \
          "merchant_name STRING, merchant_category STRING, country STRING, created_at TIMESTAMP_NTZ, " \
          "settled_at TIMESTAMP_NTZ"
    from decimal import Decimal
    pay = lambda *rows: spark.createDataFrame(
        [(i, a, "PAYMENT", "PENDING", Decimal(5), "VND", "Cafe", "coffee", "VN", at, None)
         for i, a, at in rows], txn)
    change = lambda *rows: spark.createDataFrame(
        [(0, o, op, i, c, "VND", "VN", status, day(1), at) for o, op, i, c, status, at in rows], row)
    jobs.run_hourly(spark, root, {"customers": customers, "transactions": pay(("t1", "A1", day(2)))},
                    "2024-01-03 00:00:00", changes={"accounts": change(
                        (1, "c", "A1", "1", "ACTIVE", day(1)), (2, "c", "A2", "2", "ACTIVE", day(1)))})
    got = jobs.run_hourly(spark, root, {"customers": customers, "transactions": pay(("t2", "A1", day(4)))},
                          "2024-01-05 00:00:00", changes={"accounts": change(
                              (4, "u", "A1", "1", "CLOSED", day(3)), (3, "d", "A2", "2", "ACTIVE", day(3)),
                              (1, "c", "A1", "1", "ACTIVE", day(1)))})
    assert got.staged["accounts"] == 3 and got.fact_appended == 1
    staged = jobs.staged(spark, root, "accounts").collect()
    assert [(r.id, r.status) for r in staged] == [("A1", "CLOSED")]
    dim = VersionedTable(spark, f"{root}/cur/dim_account").read()
    versions = sorted((r.account_bk, r.version, r.status, r.is_current) for r in dim.collect())
    assert versions == [("A1", 1, "ACTIVE", False), ("A1", 2, "CLOSED", True), ("A2", 1, "ACTIVE", True)]
    keys = {(r.account_bk, r.version): r.account_sk for r in dim.collect()}
    facts = {r.transaction_bk: r.account_sk for r in spark.read.parquet(f"{root}/cur/fact_transactions").collect()}
    assert facts == {"t1": keys["A1", 1], "t2": keys["A1", 2]} and len(set(keys.values())) == 3
    assert changelog.POSITION[0] not in jobs.staged(spark, root, "accounts").columns


def test_a_dimension_load_writes_the_touched_buckets(spark, tmp_path):
    """Ten changed customers rewrite at most ten of the buckets."""
    import glob
    import os
    from txnlake.operators import scd2
    root = str(tmp_path / "wh")
    feed = lambda n, band, at: spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.col("id"), F.lit("@x.org")).alias("email"),
        F.lit("VN").alias("country"), F.lit(1).cast("smallint").alias("kyc_level"),
        F.lit(band).alias("risk_band"), F.lit(at).cast("timestamp_ntz").alias("as_of"))
    jobs.load_dim(spark, root, scd2.CUSTOMER_DIM, "customer_sk", feed(2000, "LOW", "2024-01-01"))
    size = lambda: {f: os.path.getsize(f) for f in glob.glob(
        f"{root}/cur/dim_customer/*/*/*.parquet")}
    before = size()
    assert jobs.load_dim(spark, root, scd2.CUSTOMER_DIM, "customer_sk", feed(10, "HIGH", "2024-02-01")) <= 10
    written = sum(n for f, n in size().items() if f not in before)
    assert written < sum(before.values()) / 4
    dim = VersionedTable(spark, f"{root}/cur/dim_customer").read()
    assert dim.count() == 2010 and dim.select("customer_sk").distinct().count() == 2010
    assert dim.agg(F.max("customer_sk")).first()[0] == 2010
    assert jobs.load_dim(spark, root, scd2.CUSTOMER_DIM, "customer_sk", feed(0, "LOW", "2024-03-01")) == 0
