"""Operator 12: phrase collocations by SON partitioning."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from txnlake.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, phrase string, word string, n long, h long, size int, rank int"


def brute(rows, support, best):
    """The contract, with one counter per language."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for size in range(1, 6):
                counts[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        n = totals[lang]
        wanted = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        inner = Counter()
        for p, a in wanted.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inner[p[i:i + size]] = max(inner[p[i:i + size]], a)
        scored = []
        for p, a in wanted.items():
            if inner[p] >= a:
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            phrase = " ".join(p)
            scored.append((-score, -a, phrase.encode(), phrase, a, l, r, n, score))
        out += [(lang, rank, *x[3:]) for rank, x in enumerate(sorted(scored)[:best], 1)]
    return sorted(out)


def run(spark, rows, support, best, **options):
    df = spark.createDataFrame([(i, t, g, "p", "w", 1, 2, 3, 4) for i, (t, g) in enumerate(rows)], SCHEMA)
    got = co.collocations(df.repartition(options.pop("parts", 3)), support=support, best=best, **options)
    return sorted(tuple(r) for r in got.collect())


def corpus(seed=0, docs=300):
    rng = np.random.default_rng(seed)
    words = [f"W{i}" for i in range(60)] + ["é", "漢字", "a b", "x_y", "\x01"]
    share = 1 / np.arange(1, len(words) + 1)
    fixed = ["Alpha beta GAMMA delta", "one one one one one one", "alpha beta", "é 漢字\té"]
    rows = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.integers(1, 8)):
            parts.append(" ".join(rng.choice(words, rng.integers(1, 9), p=share / share.sum())))
            parts.append(str(rng.choice(fixed)))
            parts.append(str(rng.choice([". ", ", ", " ", "\n", "\t\t", "!?", "\x0b"])))
        rows.append((" ".join(parts), [None, "en", "en", "de"][rng.integers(4)]))
    return rows


@pytest.mark.parametrize("parts,options", [
    (3, {}),
    # streams of few tokens, many shards, and filters that let much through
    (7, {"tokens": 50, "shards": 5, "filter_bits": 256}),
    (1, {"tokens": 7, "shards": 2})])
def test_equals_brute_force(llm_spark, parts, options):
    rows = corpus()
    want = brute(rows, 20, 15)
    assert max(Counter(x[0] for x in want).values()) == 15 and len({x[0] for x in want}) == 3
    assert run(llm_spark, rows, 20, 15, parts=parts, **options) == want


def test_streams_count_each_place_once():
    """However a text is cut into streams, every phrase is counted as often as it stands there."""
    rows = corpus(5, 12)
    batch = pa.RecordBatch.from_arrays([pa.array([g or "und" for _, g in rows]),
                                        pa.array([t.encode() for t, _ in rows])], ["lang", "text"])

    everything = co.Bloom(np.full(1, (1 << 64) - 1, np.uint64), 64)

    def counted(most, size):
        out, full = Counter(), co.SLICE
        co.SLICE = size
        try:
            for stream in co.streams(iter([batch]), most):
                for n, ids, places, _ in co.phrases(stream, stream.hashes(), everything):
                    out.update(tuple(stream.names[x - 1] for x in ids[p:p + n]) for p in places)
        finally:
            co.SLICE = full
        return out

    whole = counted(1 << 30, 1 << 20)
    assert whole and all(counted(most, size) == whole for most, size in ((1, 1 << 20), (3, 1 << 20), (10, 1 << 20)))


def test_slices_cut_no_word():
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = "".join(rng.choice(list("aB\x01é \t.\n,漢"), rng.integers(0, 50))).encode()
        whole = [w for part in co.word_slices(text, 1000) for w in part if w]
        for size in (1, 3, 8):
            got = [w for part in co.word_slices(text, size) for w in part if w]
            assert [w for w in got if w != b"\n"] == [w for w in whole if w != b"\n"]
            assert got == whole


def test_filter_loses_nothing():
    prints = np.random.default_rng(0).integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2)
    words = np.zeros(4, np.uint64)
    for probe in range(co._PROBES):
        at = (prints >> np.uint64(32 * probe)) & np.uint64(255)
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(int), np.uint64(1) << (at & np.uint64(63)))
    assert co.Bloom(words, 256).holds(prints).all()


def test_filter_from_a_table(llm_spark):
    prints = np.random.default_rng(0).integers(-(1 << 63), (1 << 63) - 1, 300)
    df = llm_spark.createDataFrame([(int(x),) for x in prints], "h long")
    got = co.bloom(df, 1 << 16)
    assert got.holds(prints.view(np.uint64)).all()
    others = np.random.default_rng(1).integers(0, 1 << 63, 10_000).astype(np.uint64)
    assert got.holds(others).mean() < .01


def test_edges(llm_spark):
    rows = [(None, "en"), ("", None), (" \t\n..", "en"), ("a b a b a b", None), ("a b", "und"), ("long tail " * 60_000, "en"),
            ("é漢字 ü " * 4, ""), ("é漢字 ü " * 4, ""), ("x" * 100_000 + " y " + "x" * 100_000 + " y", "en")]
    for support in (1, 2, 5):
        assert run(llm_spark, rows, support, 9) == brute(rows, support, 9)
    assert run(llm_spark, [], 1, 5) == [] and run(llm_spark, [(None, None)], 1, 5) == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(llm_spark, sf):
    import duckdb

    path = f"/root/testdata/{sf}"
    got = co.op12_collocations(llm_spark, path)
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"),
                          ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/documents.parquet'")
    rows = sorted(tuple(r) for r in got.collect())
    assert rows and rows == sorted(con.execute(co.OP12_SQL).fetchall())
