"""Keys with few rows go in one window; hot ones by time slice, with the same rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests import test_asof
from txnlake.operators import asof, hotkeys, scd2
from txnlake.plans import queries
from txnlake.session import reliable_checkpoint


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_counts_every_row_and_finds_none(spark):
    rows = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 4, "k STRING")
    assert sorted(map(str, (r.k for r in hotkeys.hot_keys(rows, "k", 3).collect()))) == ["None", "a"]
    assert hotkeys.hot_keys(rows, "k", 5) is None


def test_lookup_by_slices_equals_the_definition(spark):
    span = 60 * 24 * 900
    for seed, most in ((3, 0), (4, 60)):
        rng = random.Random(seed)
        versions = test_asof.overlapping_versions(rng, 90, span)
        facts = test_asof.facts_of(rng, 250, span)
        want = sorted(((i, *test_asof.winner(versions, k, t)) for i, k, t in facts), key=str)
        assert test_asof.run(spark, versions, facts, hot_rows=most) == want
        inner = test_asof.run(spark, versions, facts, hot_rows=most, how="inner")
        assert inner == [w for w in want if w[1] is not None]


def test_lookup_of_keys_with_few_rows_is_one_window(spark):
    at = test_asof.at
    parts = reliable_checkpoint(asof.segments(spark.createDataFrame(
        [("a", 1, at(0), at(9), "x"), ("a", 2, at(9), None, "y")], test_asof.VERSIONS), "k", ["tag"], overlapping=False))
    facts = reliable_checkpoint(spark.createDataFrame([(1, "a", at(3)), (2, None, at(4))], "id INT, key STRING, ts TIMESTAMP_NTZ"))
    found = asof.lookup(facts, F.col("key"), "ts", parts, "d_")
    assert sorted(map(tuple, found.select("id", "d_tag").collect())) == [(1, "x"), (2, None)]
    assert sum(line.lstrip(" :+-").startswith("Window [") for line in _plan(found).splitlines()) == 1


def test_fold_by_slices_equals_the_model(spark):
    rng = random.Random(5)
    start = dt.datetime(2020, 1, 1)
    rows = [(rng.choice(["A", "A", "B", "C", None]), "1", "VND", "VN", rng.choice(["ACTIVE", "CLOSED"]),
             start + dt.timedelta(hours=rng.randrange(20_000)), n) for n in range(200)]
    feed = spark.createDataFrame(rows, "id STRING, customer_bk STRING, currency STRING, country STRING, "
                                       "status STRING, as_of TIMESTAMP_NTZ, seq LONG")
    whole, cut, mixed = (sorted(map(tuple, scd2.build_dim(feed, scd2.ACCOUNT_DIM, hot_rows=most).collect()), key=str)
                         for most in (1000, 0, 60))
    assert whole == cut == mixed and len(whole) > 60
    # a change without a key has no version
    assert {r[0] for r in whole} == {"A", "B", "C"}


def test_stored_transactions_are_the_staged_ones(spark, tmp_path):
    day = dt.datetime(1998, 1, 1)
    rng = random.Random(6)
    lines = [(rng.choice([1, 2, 3, 9, None]), rng.choice([1, 2, 7]), rng.choice([1, 2, 7]), rng.choice([1, 2, None]),
              1.0, float(rng.randrange(5)), .0, .0, "A", "O", day + dt.timedelta(days=rng.randrange(4))) for _ in range(80)]
    tables = {
        "lineitem": (lines, "l_orderkey LONG, l_partkey LONG, l_suppkey LONG, l_linenumber INT, l_quantity DOUBLE, l_extendedprice "
                            "DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
        "orders": ([(k, 5, "F", 1., day, "1-URGENT") for k in (1, 2, 2, 3)],
                   "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
        "part": ([(1, "p", "t"), (2, "q", "t")], "p_partkey LONG, p_name STRING, p_type STRING"),
        "supplier": ([(1, 1), (2, 2)], "s_suppkey LONG, s_nationkey INT")}
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    columns = ["id", "account_id", "amount", "merchant_name", "created_at"]

    def bag(df):
        return sorted(map(tuple, df.select(*columns).collect()), key=str)

    staged = queries.staged_transactions(spark, str(tmp_path))
    stored = queries.stored_transactions(spark, str(tmp_path))
    assert bag(stored) == bag(staged) and [r for r in bag(stored) if r[0] is None]
    late = F.col("created_at") > F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    assert bag(queries.stored_transactions(spark, str(tmp_path), keep=late)) == bag(staged.where(late))
