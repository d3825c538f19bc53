"""Operator 13: links at cosine 0.95 or more and their components."""

import math
from collections import Counter

import numpy as np
import pytest

from txnlake.llm import vector_dedup as vd

SCHEMA = "vec_id long, embedding array<float>, key string, v string, id int, codes string, n_links int"


def brute(rows, cosine=0.95):
    """Every pair, no hashing; rows of their own whatever their ids."""
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)
          and any(v)]
    links = [set() for _ in rows]
    for a in ok:
        va = np.array(rows[a][1], float)
        for b in ok:
            vb = rows[b][1]
            if a < b and len(va) == len(vb) and va @ np.array(vb, float) / (
                    np.linalg.norm(va) * np.linalg.norm(vb)) >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = []
    for a, (vec_id, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[x][0] for x in seen if rows[x][0] is not None]
        least = min(ids) if ids else None
        out.append((vec_id, len(links[a]), least, vec_id == least))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "k", "x", 1, "c", 2) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in vd.near_vectors(df, **options).collect()), key=str)


def planted(seed=3):
    """Clusters as chains (links not transitive), tight groups, exact copies, and strangers."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(240, 16))
    chain = [base[0]]
    for _ in range(20):
        step = rng.normal(size=16)
        chain.append(chain[-1] + .22 * np.linalg.norm(chain[-1]) * step / np.linalg.norm(step))
    tight = base[1] + .02 * rng.normal(size=(150, 16))
    v = np.concatenate([base, chain, tight, np.repeat(base[2:4], 40, 0), 3.7 * base[5:9]])
    ids = rng.permutation(len(v)) * 7
    return [(int(i), x.astype(np.float32).tolist()) for i, x in zip(ids, v)]


def test_equals_brute_force(llm_spark):
    rows = planted()
    want = brute(rows)
    sizes = Counter(c for _, _, c, _ in want)
    assert max(n for _, n, *_ in want) > 140                        # a group
    assert any(sizes[c] > n + 2 for _, n, c, _ in want if n)        # a chain: linked by others only
    assert run(llm_spark, rows) == want
    # many tables and bits, and buckets of several blocks
    assert run(llm_spark, rows, bucket_rows=16, block_rows=32, recall=1 - 1e-9) == want


def test_recall_of_pairs_at_the_threshold():
    """Pairs at cosine 0.951 meet in a table as often as the rule says, at any size."""
    rng = np.random.default_rng(11)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    away = rng.normal(size=a.shape)
    away -= (away * a).sum(1)[:, None] * a
    away /= np.linalg.norm(away, axis=1)[:, None]
    b = .951 * a + math.sqrt(1 - .951 ** 2) * away
    for classes in (500, 10 ** 5, 10 ** 9):
        bits, tables = vd.rule(classes, .95, .99, 512)
        planes = np.random.default_rng([vd.SEED, 64]).standard_normal((64, tables * bits))
        same = ((a @ planes > 0) == (b @ planes > 0)).reshape(len(a), tables, bits).all(2).any(1)
        assert same.mean() >= .98
        assert classes / 2 ** bits <= 512 or bits == 31


def test_rule_grows_with_the_input():
    rules = [vd.rule(n, .95, .999, 512) for n in (0, 1, 600, 10 ** 4, 10 ** 6, 10 ** 9)]
    assert rules == sorted(rules) and rules[0] == (1, 4)


def test_merge_joins_long_paths():
    n = 2000
    order = np.random.default_rng(0).permutation(n)
    parent = vd.merge(np.arange(n + 1), order[:-1], order[1:])
    assert (parent[:n] == 0).all() and parent[n] == n


def test_edges(llm_spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]),
            (250, []), (300, [1.0, 2.0, 3.0]), (0, [1.0, 2.0]), (None, [1.0, 2.0]), (7, [-1.0, 0.5]),
            (350, [0.0, 0.0]), (351, [0.0, -0.0]), (None, None), (-4, [2.0, 4.0]), (9, [3.0, 6.0]),
            (10, [1e30, 2e30]), (11, [1e-30, 2e-30]), (None, [-5.0, 0.1]), (None, [-5.0, 0.1])]
    assert run(llm_spark, rows) == brute([(i, v and [x if x is None else float(np.float32(x)) for x in v])
                                          for i, v in rows])
    assert run(llm_spark, []) == [] and run(llm_spark, [(3, None)]) == [(3, 0, 3, True)]


def test_double_components(llm_spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.0000001e200]), (3, [1e-300, 0.0]), (4, [1.0, 1e-300])]
    df = llm_spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vd.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 1, 3, False)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(llm_spark, sf):
    import duckdb

    path = f"/root/testdata/{sf}"
    got = vd.op13_vector_dedup(llm_spark, path)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"),
                          ("kept", "boolean")]
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.execute(vd.OP13_SQL).fetchall())
