"""Operator 11: ranked lexical search by NRA."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from txnlake.llm import ranked_search as rs
from txnlake.llm.ranked_search import Lists, ranked_search, term_slices

from .conftest import documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
ITEMS = "item_id long, text string, doc_id long, terms string, n long, tf long, item string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """The contract, one document at a time."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    total, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            n = sum(b.values())
            m = 100 - 25 + (25 * n * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if b[t])
            if s > 0:
                scored.append((-s, math.inf if d is None else d))
        out += [(item, r, None if d == math.inf else d, -s)
                for r, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, k, **options):
    table = spark.createDataFrame([(i, t, 1, "t", 2, 3, "x") for i, t in items], ITEMS)
    return sorted((tuple(r) for r in ranked_search(documents(spark, docs), table, k, **options).collect()),
                  key=str)


def corpus(seed=0, docs=400):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" if i % 3 else f"Wört{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(1, 60), p=share / share.sum())))
            for i in rng.permutation(docs)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 30)))) for i in range(25)]
    return rows + [(d + docs, t) for d, t in rows[:80]] + rows[:5], items


def test_equals_brute_force_with_ties_and_chunks(llm_spark):
    docs, items = corpus()
    want = brute(docs, items, 7)
    assert len({(i, s) for i, _, _, s in want}) < len(want)              # ties
    assert run(llm_spark, docs, items, 7) == want
    assert run(llm_spark, docs, items, 7, chunk_docs=9, chunk_postings=30, block_bytes=200) == want


def test_nra_reads_on_until_scores_are_final():
    rng = np.random.default_rng(2)
    for seed in range(30):
        docs, wide = 500, 6
        has = rng.random((docs, wide)) < rng.choice([.02, .3, .95], wide)
        doc, term = np.nonzero(has)
        tf = rng.integers(1, 9 if seed % 2 else 2, len(doc))
        n = rng.integers(10, 60 if seed % 3 else 11, docs)
        weights = rng.integers(0, 5000, wide)
        lists = Lists(np.arange(docs), n, doc, term, tf, docs, int(n.sum()), weights)
        times = {t: int(rng.integers(1, 4)) for t in range(wide)}
        scores = np.zeros(docs, np.int64)
        np.add.at(scores, lists.doc, np.concatenate(
            [np.full(b - a, times[t]) for t, (a, b) in lists.at.items()]) * lists.impact)
        for floor in (1, int(np.sort(scores)[-3])):
            places, found = lists.nra(times, 10, floor, first=4)
            least = max(floor, 1, int(np.sort(scores)[-10]))
            assert set(places) == set(np.flatnonzero(scores >= least))
            assert (found == scores[places]).all()


def test_nra_stops_early():
    """A document far above all others: common lists are not read to their end."""
    docs = 20_000
    doc = np.concatenate([np.arange(docs), np.arange(docs), [7]])
    term = np.repeat([0, 1, 2], [docs, docs, 1])
    tf = np.ones(len(doc), np.int64)
    tf[[7, docs + 7]] = 50
    lists = Lists(np.arange(docs), np.full(docs, 20), doc, term, tf, docs, 20 * docs,
                  np.array([10, 10, 9000]))
    places, _ = lists.nra({0: 1, 1: 1, 2: 1}, 1, 1)
    assert places.tolist() == [7] and lists.read < 1000


def test_slices_cut_no_term():
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = "".join(rng.choice(list("aBé9 .漢\n"), rng.integers(0, 60))).encode()
        for size in (1, 3, 8, 1000):
            got = [w for part in term_slices(text, size) for w in part]
            assert got == [w.encode() for w in terms(text.decode())]


def test_edges(llm_spark, nothing):
    docs = [(1, None), (2, ""), (None, "one null id"), (3, " \n\t "), (4, "one"), (5, "ONE two"), (5, "ONE two"),
            (6, "One, two; three"), (7, "long one " * 40_000), (8, "é漢字 ünïcode\r\nÉ"), (None, "one null id")]
    items = [(1, "one two"), (1, "one two"), (None, "null id"), (2, None), (3, ""), (4, "absent"),
             (5, "é漢字 É one one one"), (6, "ünïcode " * 3000)]
    assert run(llm_spark, docs, items, 4) == brute(docs, items, 4)
    assert run(llm_spark, docs, [], 4) == [] and run(llm_spark, [], items, 4) == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(llm_spark, sf):
    import duckdb

    path = f"/root/testdata/{sf}"
    got = rs.op11_ranked_search(llm_spark, path)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{path}/{name}.parquet'")
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == sorted(con.execute(rs.OP11_SQL).fetchall())
    assert len({i for i, *_ in rows}) == con.execute("select count(*) from benchmark").fetchone()[0]
