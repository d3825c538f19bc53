"""Operator 6: exact top-k by inner product of quantised vectors."""

import math

import numpy as np
from pyspark.sql import functions as F

from txnlake.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, uid long, v string, norm double"


def brute(rows, k):
    ok = [(i, np.floor(256 * np.array(v, float))) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, vq) in enumerate(ok):
        if q is None or q % 50:
            continue
        best = sorted((-float(vq @ v), 1 << 62 if i is None else i)
                      for b, (i, v) in enumerate(ok) if a != b and len(v) == len(vq))[:k]
        out += [(q, r, None if i == 1 << 62 else i, int(-s)) for r, (s, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def _run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x", .5) for i, v in rows], SCHEMA)
    got = top_k(df, F.col("vec_id") % 50 == 0, **options)
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()), key=str)


def test_equals_brute_force_over_lengths_and_ties(llm_spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(700, 8))
    v *= rng.choice([.05, .3, 1, 1, 4], 700)[:, None]
    v[100:400] = v[100]                       # many equal vectors
    v[400:420] = 0
    v[420:520] = v[0] + rng.normal(size=(100, 8)) * .01
    rows = [(int(i), x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    want = brute([(i, [float(np.float32(y)) for y in x]) for i, x in rows], 5)
    assert _run(llm_spark, rows) == want
    # small blocks, buckets and seed: every pruning path
    assert _run(llm_spark, rows, query_block=4, bucket_rows=16, seed_rows=12) == want


def test_pruning_takes_place(llm_spark):
    from txnlake.llm import topk
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(size=(400, 16)))
    v = v[np.argsort(-np.linalg.norm(v, axis=1))]
    v[:8] *= 4
    block = topk.Block(np.arange(5) + 1000, np.arange(5), v[:5] * .5, 5)
    block.floor = np.sort(block.v @ v.T, axis=1)[:, -5]
    seen = topk.search_bucket(block, np.arange(400), np.arange(400), v, np.linalg.norm(v, axis=1))
    for q, (near, scores) in enumerate(seen):
        want = np.flatnonzero(v @ block.v[q] >= block.floor[q])
        assert set(want) == set(near) and (scores >= block.floor[q]).all()


def test_edges(llm_spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]),
            (250, []), (300, [1.0, 2.0, 3.0]), (0, [1.0, 2.0]), (None, [5.0, 5.0]), (7, [-1.0, 0.5]),
            (350, [0.0, 0.0])]
    assert _run(llm_spark, rows) == brute(rows, 5)
    assert _run(llm_spark, [(1, [1.0])]) == [] and _run(llm_spark, []) == []


def test_copies_that_are_the_longest_vectors(llm_spark):
    """Squared length 3: its root squared rounds below 3, so the copies' cosine is above 1 in doubles."""
    assert 3 / (math.sqrt(3) * math.sqrt(3)) > 1
    ids = np.random.default_rng(5).permutation(60) * 10
    one = [1 / 256] * 3
    rows = [(int(i), one) for i in ids[:40]] + [(int(i), [1 / 256, 0.0, 0.0]) for i in ids[40:]]
    want = brute(rows, 5)
    assert len(want) == 60
    assert _run(llm_spark, rows) == want
    # copies over several buckets, with no floor from the seed and with one
    assert _run(llm_spark, rows, bucket_rows=4, seed_rows=1) == want
    assert _run(llm_spark, rows, bucket_rows=4, seed_rows=12) == want
