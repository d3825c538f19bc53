"""As-of lookup and history join against one-row-at-a-time models."""

import datetime as dt
import inspect
import random

import pytest
from pyspark.sql import functions as F

from txnlake.operators import asof
from txnlake.session import reliable_checkpoint

T0 = dt.datetime(2024, 1, 1)
VERSIONS = "k STRING, version INT, valid_from TIMESTAMP_NTZ, valid_to TIMESTAMP_NTZ, tag STRING"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def winner(versions, key, t):
    """The definition: latest valid_from, then version, among those that contain t."""
    hits = [(v[2], v[1], v[4]) for v in versions
            if key is not None and t is not None and v[0] == key and v[2] is not None and v[2] <= t
            and (v[3] is None or t < v[3])]
    return max(hits)[1:] if hits else (None, None)


def overlapping_versions(rng, n, span):
    """Any intervals: nested, equal, open, inverted, empty, without a start; a third on one key."""
    out = []
    for v in range(n):
        key = "hot" if rng.random() < .34 else rng.choice("abc")
        start = rng.randrange(span)
        end = None if rng.random() < .1 else at(start + rng.choice([-5, 0, 1, 7, span // 9, span // 2]))
        out.append((key, v, None if rng.random() < .03 else at(start), end, f"t{v}"))
    return out


def facts_of(rng, n, span):
    rows = [(i, rng.choice(["hot", "a", "b", "c", "absent", None]),
             None if rng.random() < .05 else at(rng.randrange(-3, span + 40))) for i in range(n)]
    return [*rows, *rows[:3]]


FACTS = "id INT, key STRING, ts TIMESTAMP_NTZ, _key STRING, _take INT"


def run(spark, versions, facts, **options):
    dim = spark.createDataFrame(versions, VERSIONS)
    table = spark.createDataFrame([(*f, "x", 1) for f in facts], FACTS)
    got = asof.asof_lookup(table, F.col("key"), "ts", dim, "k", ["version", "tag"], "d_", **options)
    assert got.columns == ["id", "key", "ts", "_key", "_take", "d_version", "d_tag"]
    return sorted(((r.id, r.d_version, r.d_tag) for r in got.collect()), key=str)


# spans of an hour, of a few slices and of many slices of 30 days
@pytest.mark.parametrize("seed,span", [(1, 60), (2, 60 * 24 * 100), (3, 60 * 24 * 900)])
def test_lookup_equals_the_definition_for_any_intervals(spark, seed, span):
    rng = random.Random(seed)
    versions, facts = overlapping_versions(rng, 90, span), facts_of(rng, 250, span)
    want = sorted(((i, *winner(versions, k, t)) for i, k, t in facts), key=str)
    assert run(spark, versions, facts) == want
    assert sum(v is not None for _, v, _ in want) > 50
    inner = run(spark, versions, facts, how="inner")
    assert inner == [w for w in want if w[1] is not None]


def test_lookup_without_overlaps(spark):
    rng = random.Random(9)
    versions = []
    for key in ("hot", "a", "b"):
        cuts = sorted(rng.sample(range(0, 60 * 24 * 700), 60 if key == "hot" else 8))
        versions += [(key, n, at(a), at(b) if key != "b" or n % 3 else at((a + b) // 2), f"{key}{n}")
                     for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    facts = facts_of(rng, 300, 60 * 24 * 700)
    want = sorted(((i, *winner(versions, k, t)) for i, k, t in facts), key=str)
    assert run(spark, versions, facts, overlapping=False) == want == run(spark, versions, facts)


def test_empty_sides(spark):
    rng = random.Random(4)
    facts = facts_of(rng, 5, 60)
    assert run(spark, [], facts) == sorted(((i, None, None) for i, *_ in facts), key=str)
    assert run(spark, overlapping_versions(rng, 5, 60), []) == []


def test_joined_history_resolves_like_two_lookups(spark):
    """At any time an account resolves through the joined history as step by step."""
    rng = random.Random(1)
    span = 60 * 24 * 200
    accounts = [(k, n, s, e, rng.choice(["hot", "a", "b", "gone"])) for k, n, s, e, _ in
                overlapping_versions(rng, 40, span)]
    customers = overlapping_versions(rng, 60, span)
    left = reliable_checkpoint(asof.segments(
        spark.createDataFrame(accounts, VERSIONS).withColumn("av", F.col("version")), "k", ["av", "tag"]))
    right = reliable_checkpoint(asof.segments(
        spark.createDataFrame(customers, VERSIONS).withColumn("cv", F.col("version")), "k", ["cv"]))
    joined = reliable_checkpoint(asof.join_histories(left, "tag", right))
    facts = facts_of(rng, 300, span)
    table = spark.createDataFrame([(*f, "x", 1) for f in facts], FACTS)
    got = sorted(((r.id, r.h_av, r.h_cv) for r in
                  asof.lookup(table, F.col("key"), "ts", joined, "h_").collect()), key=str)
    want = []
    for i, k, t in facts:
        av, customer = winner(accounts, k, t)
        want.append((i, av, winner(customers, customer, t)[0]))
    assert got == sorted(want, key=str)
    assert sum(c is not None for _, _, c in want) > 20
    # segments of an account are disjoint
    rows = sorted((r["_key"], r["_from"], r["_to"]) for r in joined.collect())
    assert all(a[0] != b[0] or (a[2] is not None and a[2] <= b[1]) for a, b in zip(rows, rows[1:]))


def test_no_lists_and_no_cross_products(spark):
    assert "collect_list" not in inspect.getsource(asof)
    rng = random.Random(4)
    dim = spark.createDataFrame(overlapping_versions(rng, 5, 60), VERSIONS)
    facts = spark.createDataFrame([(*f, "x", 1) for f in facts_of(rng, 5, 60)], FACTS)
    plan = asof.asof_lookup(facts, F.col("key"), "ts", dim, "k", ["tag"], "d_")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "collect_list" not in plan
