"""Operator 1: best-fit packing under source and duplicate conflicts."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tests.llm.conftest import EDGES, documents
from txnlake.llm.packing import best_fit, best_fit_packing, pack_stage, words


def brute(sizes, sources, clusters, capacity):
    """Tightest compatible bin by looking at all of them."""
    bins, out = [], [None] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(b["left"], n) for n, b in enumerate(bins) if b["left"] >= sizes[k]
                and not (sources[k] >= 0 and sources[k] in b["s"])
                and not (clusters[k] >= 0 and clusters[k] in b["c"])]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"left": capacity, "s": set(), "c": set()})
        out[k] = (n, capacity - bins[n]["left"])
        bins[n]["left"] -= sizes[k]
        bins[n]["s"].add(sources[k])
        bins[n]["c"].add(clusters[k])
    return out


def test_best_fit_equals_brute_force():
    rnd = random.Random(1)
    for _ in range(40):
        n = rnd.randint(1, 120)
        sizes = [rnd.randint(1, 50) for _ in range(n)]
        sources = [rnd.choice([-1, 0, 0, 0, 1, 2, 3]) for _ in range(n)]
        clusters = [rnd.choice([-1, -1, 0, 1, 2]) for _ in range(n)]
        assert best_fit(sizes, sources, clusters, 50) == brute(sizes, sources, clusters, 50)


def _check(df, docs, capacity):
    rows = df.collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r["cell"], r["bin"]].append(r)
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["size"]
        assert at <= capacity
    return rows, bins


def test_whole_documents_and_conflicts(llm_spark):
    rnd = random.Random(2)
    docs = [(k, " ".join("w" * 3 for _ in range(rnd.randint(0, 90))), rnd.choice("aab")) for k in range(300)]
    docs += [(1000 + k, "copy of one text", f"s{k}") for k in range(40)]
    df = documents(llm_spark, docs)
    out = best_fit_packing(df.select("doc_id", "text", "source"), words(F.col("text")) + 1,
                           F.col("source"), F.xxhash64("text"), capacity=32, cell_pieces=64)
    rows, bins = _check(out, docs, 32)
    size = defaultdict(int)
    for r in rows:
        assert r["start"] == 32 * r["piece"]
        size[r["doc_id"]] += r["size"]
    assert size == {d: len(t.split()) + 1 for d, t, _ in docs}
    source, text = {d: s for d, _, s in docs}, {d: t for d, t, _ in docs}
    for held in bins.values():
        assert len({source[r["doc_id"]] for r in held}) == len(held)
        assert len({text[r["doc_id"]] for r in held}) == len(held)


def test_edges(llm_spark, edges, nothing):
    rows, _ = _check(pack_stage(llm_spark, edges, ""), EDGES, 2048)
    whole = defaultdict(int)
    for r in rows:
        whole[r["doc_id"]] += r["size"]
    assert whole[1] == whole[2] == whole[3] == 1 and whole[7] == 30_001 and whole[5] == 2 * 8
    assert pack_stage(llm_spark, nothing, "").count() == 0


def test_bins_do_not_depend_on_settings_or_file_layout(llm_spark):
    rnd = random.Random(3)
    docs = documents(llm_spark, [(k, "w " * rnd.randint(0, 90), rnd.choice("abc")) for k in range(400)]
                     + [(7777, "one row many times", "d")] * 150)

    def bins(df):
        return sorted(map(tuple, best_fit_packing(df, words(F.col("text")) + 1, F.col("source"),
                                                  F.xxhash64("text"), capacity=32, cell_pieces=128).collect()))

    want = bins(docs)
    before = llm_spark.conf.get("spark.sql.shuffle.partitions")
    llm_spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert bins(docs.orderBy(F.desc("doc_id")).repartition(5)) == want
    finally:
        llm_spark.conf.set("spark.sql.shuffle.partitions", before)
    copies = [r for r in want if r[0] == 7777]
    assert len(copies) == 150 == len({(r[4], r[5]) for r in copies}) and len({r[4] for r in copies}) > 1


def test_null_source_and_cluster_are_in_conflict_with_nothing(llm_spark):
    docs = documents(llm_spark, [(k, "two words", None) for k in range(8)])
    rows = best_fit_packing(docs, words(F.col("text")) + 1, F.col("source"), F.lit(None).cast("string"),
                            capacity=24).collect()
    assert len({(r.cell, r.bin) for r in rows}) == 1
