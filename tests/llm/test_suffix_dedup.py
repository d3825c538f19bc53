"""Operator 9: repeated byte strings across documents."""

import hashlib
import random

import numpy as np
import pytest

from tests.llm.conftest import EDGES, documents
from txnlake.llm.suffix_dedup import suffix_dedup
from txnlake.llm.suffix_sort import BlindTrie, deep_shallow


def brute(docs, length):
    first = {}
    for d, t in docs:
        key = -(1 << 63) if d is None else d
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < (-(1 << 63) if d is None else d):
                gone[i:i + length] = b"\1" * length
        spans = [i for i in range(len(t)) if gone[i] and not (i and gone[i - 1])]
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _run(df, **options):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256)
                   for r in suffix_dedup(df, **options).collect()), key=str)


@pytest.mark.parametrize("shallow", [2, 8, 13, 40])
def test_deep_shallow_order(shallow):
    rnd = random.Random(13)
    raw = bytes(rnd.choice(b"ab") for _ in range(600)) + bytes(64)
    data, starts = np.frombuffer(raw, np.uint8), np.arange(500)
    order, group = deep_shallow(data, starts, 20, shallow)
    words = [raw[i:i + 20] for i in order.tolist()]
    assert words == sorted(raw[i:i + 20] for i in range(500))
    for p in range(1, 500):
        assert (group[p] == group[p - 1]) == (words[p] == words[p - 1])


def test_blind_trie_order():
    rnd = random.Random(14)
    strings = [bytes(rnd.choice(b"abc") for _ in range(6)) for _ in range(300)]
    trie = BlindTrie(6)
    for k, s in enumerate(strings):
        trie.insert(s, k)
    leaves = list(trie.leaves())
    assert [strings[m[0]] for m in leaves] == sorted(set(strings))
    assert all({strings[k] for k in m} == {strings[m[0]]} for m in leaves)


@pytest.mark.parametrize("batch_bytes", [2500, 1 << 20])
def test_equals_brute_force(llm_spark, batch_bytes):
    rnd = random.Random(15)
    docs, pool = [], []
    for k in range(160):
        letters = rnd.choice(["ab", "abcdefgh ", "a", "xyzé ~ü"])
        t = "".join(rnd.choice(letters) for _ in range(rnd.choice([0, 10, 49, 50, 51, 200, 600])))
        for _ in range(rnd.randint(0, 4) if pool else 0):
            p = rnd.choice(pool)
            a, i = rnd.randint(0, max(0, len(p) - 40)), rnd.randint(0, len(t))
            t = t[:i] + p[a:a + rnd.choice([49, 50, 60, 84, 85, 120, 400])] + t[i:]
        t = rnd.choice(pool) if pool and rnd.random() < .1 else t
        pool.append(t)
        docs.append((k * 3, t))
    rnd.shuffle(docs)
    want = brute([(d, t.encode()) for d, t in docs], 50)
    assert sum(w[2] for w in want) > 1000
    assert _run(documents(llm_spark, docs), batch_bytes=batch_bytes) == want


def test_a_passage_of_many_documents(llm_spark):
    passage = "this very passage of well over fifty words " * 3
    docs = [(k, f"{k * 7919 % 1009} own start {passage} own end {k * 104729 % 997}") for k in range(300)]
    assert _run(documents(llm_spark, docs), batch_bytes=3000) == brute([(d, t.encode()) for d, t in docs], 50)


def test_edges(llm_spark, edges, nothing):
    rows = [r for r in EDGES if r[0] != 7] + [(None, "y" * 60), (-5, "y" * 70), (9, "x" * 60), (9, "x" * 60)]
    assert _run(documents(llm_spark, rows)) == brute([(d, (t or "").encode()) for d, t in rows], 50)
    assert len(_run(edges)) == len(EDGES)
    assert suffix_dedup(nothing).count() == 0
