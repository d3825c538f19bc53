"""Operator 7: BagMinHash near-duplicates."""

import random
from collections import Counter, defaultdict

import numpy as np

from tests.llm.conftest import EDGES, documents
from txnlake.llm import minhash
from txnlake.llm.components import components


def bag(text):
    w = (text or "").lower().split()
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def brute(docs):
    """Least doc_id by component of the pairs at 0.8 or more; wordless texts are alone."""
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    bags = {d: bag(t) for d, t in docs}
    by = defaultdict(list)
    for d, b in bags.items():
        for s in b:
            by[s].append(d)
    for a, b in {(a, b) for v in by.values() for i, a in enumerate(v) for b in v[i + 1:]}:
        common = sum((bags[a] & bags[b]).values())
        if common >= .8 * (sum(bags[a].values()) + sum(bags[b].values()) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d, _ in docs}


def _classes(spark, docs):
    return {r.doc_id: r.class_id for r in minhash.near_duplicates(documents(spark, docs)).collect()}


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    for share, heavy in ((.8, 1), (.5, 1), (.8, 9), (.6, 300)):
        true, seen = [], []
        for _ in range(60):
            e = rng.integers(1, 2**62, 80).astype(np.uint64)
            wa = rng.integers(1, heavy + 1, 80)
            wb, other, change = wa.copy(), e.copy(), rng.random(80) > share
            wb[change] = rng.integers(1, heavy + 1, change.sum())
            if heavy == 1:
                other[change] = rng.integers(1, 2**62, change.sum()).astype(np.uint64)
            s = minhash.bag_signatures(np.repeat([0, 1], 80), np.concatenate([e, other]),
                                       np.concatenate([wa, wb]), 2, 96)
            a, b = dict(zip(e.tolist(), wa.tolist())), dict(zip(other.tolist(), wb.tolist()))
            c = sum(min(n, b.get(k, 0)) for k, n in a.items())
            true.append(c / (sum(a.values()) + sum(b.values()) - c))
            seen.append((s[0] == s[1]).mean())
        assert abs(np.mean(true) - np.mean(seen)) < .025


def _near_copies(rnd, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(llm_spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randint(0, 60))
                      for _ in range(rnd.randint(1, 120))) for _ in range(60)]
    for base in list(texts[:20]):
        if len(base.split()) > 20:
            texts += _near_copies(rnd, base, 4, 3)
    big = " ".join(f"word{k}" for k in range(150))
    texts += _near_copies(rnd, big, 60, 5)       # buckets beyond the small size
    texts += [big] * 15
    rnd.shuffle(texts)
    docs = list(enumerate(texts))
    assert _classes(llm_spark, docs) == brute(docs)


def test_large_buckets_are_finished(llm_spark):
    """Star rounds reach every component that all pairs would reach."""
    rnd = random.Random(9)
    base = [f"t{k}" for k in range(60)]
    texts = []
    for k in range(40):                          # a chain: neighbours are near, the ends are not
        w = list(base)
        w[:k] = [f"n{j}" for j in range(k)]
        texts.append(" ".join(w))
    rnd.shuffle(texts)
    docs = list(enumerate(texts))
    assert _classes(llm_spark, docs) == brute(docs)


def _packed(rnd, n):
    h = np.array(sorted(rnd.sample(range(1 << 40), n)), np.uint64)
    return h.tobytes() + np.array([rnd.choice([1, 1, 1, 2, 7]) for _ in range(n)], np.uint32).tobytes()


def test_block_overlaps_equal_pair_overlaps():
    """Both ways of counting, dense columns in several slices, empty overlaps."""
    rnd = random.Random(3)
    base = _packed(rnd, 50)
    bags = [base] * 9 + [_packed(rnd, rnd.randint(1, 60)) for _ in range(10)]
    for k in range(40):
        h = np.frombuffer(base, np.uint64, 50).copy()
        c = np.frombuffer(base, np.uint32, 50, 400).copy()
        for _ in range(rnd.randint(0, 30)):
            c[rnd.randrange(50)] = rnd.randint(1, 5)
            h[rnd.randrange(50)] += np.uint64(rnd.randint(0, 3))
        keep = np.unique(h, return_index=True)[1]
        bags.append(h[keep].tobytes() + c[keep].tobytes())
    a, b = bags[::2], bags[1::2]
    want = [[minhash.overlap(x, y) for y in b] for x in a]
    for columns, dense in ((4096, 64), (16, 4), (4096, 1), (8, 1 << 30)):
        assert np.allclose(minhash.overlaps(a, b, columns, dense), want, atol=1e-6)


def test_strays_meet_their_buckets(llm_spark, monkeypatch):
    """A large group, many texts below 0.8 to it and linked among themselves or through it; small blocks."""
    rnd = random.Random(12)
    base = [f"w{k}" for k in range(80)]
    texts = []
    for k in range(150):
        w = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4, 5, 6])):
            w[rnd.randrange(80)] = f"x{rnd.randint(0, 10**6)}"
        texts.append(" ".join(w))
    docs = list(enumerate(texts))
    want = brute(docs)
    assert len(set(want.values())) > 10
    assert _classes(llm_spark, docs) == want
    real = minhash.stray_links
    monkeypatch.setattr(minhash, "stray_links", lambda *a: real(*a, block_rows=8))
    assert _classes(llm_spark, docs) == want


def test_components(spark):
    rnd = random.Random(10)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(k, k + 1) for k in range(100, 160)]
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}


def test_edges(llm_spark, edges, nothing):
    got = minhash.near_duplicates(edges).collect()
    assert len(got) == len(EDGES)
    assert {r.doc_id: r.class_id for r in got} == {1: 1, 2: 2, None: None, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8}
    stage = minhash.near_dedup_stage(llm_spark, edges, "")
    assert stage.columns == edges.columns
    assert sorted(str(r.doc_id) for r in stage.collect()) == ["1", "2", "3", "4", "5", "7", "8", "None"]
    assert minhash.near_duplicates(nothing).count() == 0
    assert minhash.near_dedup_stage(llm_spark, nothing, "").count() == 0
