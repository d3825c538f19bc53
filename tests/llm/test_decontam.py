"""Operator 2: greedy string tiling against benchmark items."""

import random

from tests.llm.conftest import documents
from txnlake.llm import decontam


def brute_tiles(item, doc, least):
    """Longest common unmarked run, again and again, by looking at all places."""
    a, b, total = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and a[i + n] and b[j + n]
                       and item[i + n] == doc[j + n]):
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        a[i:i + n], b[j:j + n] = [False] * n, [False] * n
        total += n


def test_tiling_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(150):
        item = [rnd.choice("abcde") for _ in range(rnd.randint(1, 25))]
        doc = [rnd.choice("abcde") for _ in range(rnd.randint(0, 20))]
        for _ in range(2):
            k = rnd.randint(0, len(item))
            doc += item[k:k + rnd.randint(3, 12)]
        least = rnd.randint(2, 4)
        tiles = decontam.greedy_tiles(item, doc, least)
        assert sum(n for *_, n in tiles) == brute_tiles(item, doc, least)
        for i, j, n in tiles:
            assert item[i:i + n] == doc[j:j + n] and n >= least


WORDS = [f"w{k}" for k in range(60)]
ITEM = " ".join(WORDS[:40])


def _leaks(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contaminated(documents(spark, rows), bench).collect()
    return {(r.doc_id, r.item_id): round(r.coverage, 3) for r in out}


def test_reordered_and_partial_passages(llm_spark):
    rows = [(1, "x " + ITEM + " y"), (2, " ".join(WORDS[20:40] + ["z"] + WORDS[:20])),
            (3, " ".join(WORDS[:12])), (4, "nothing of it"), (5, ITEM.upper().replace(" ", ", ")),
            (6, " ".join(w for p in zip(WORDS[:40], ["q"] * 40) for w in p))]
    assert _leaks(llm_spark, rows, [(7, ITEM)]) == {(1, 7): 1.0, (2, 7): 1.0, (5, 7): 1.0}


def test_blocks_give_the_same_leaks(llm_spark):
    items = [(k, " ".join(f"i{k}_{j}" for j in range(20))) for k in range(12)]
    docs = documents(llm_spark, [(k, f"before {items[k % 12][1]} after") for k in range(30)])
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.contaminated(docs, bench).collect()
    small = decontam.contaminated(docs, bench, block_chars=300).collect()
    assert sorted(whole) == sorted(small) and len(whole) == 30


def test_edges(llm_spark, edges, nothing):
    items = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "same words in two rows of it"),
             (4, "long long long long long long long")]
    bench = llm_spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(edges, bench).collect()}
    assert got == {(4, 3), (5, None), (6, None), (7, 4)}
    kept = decontam.drop_contaminated(edges, bench)
    assert kept.columns == edges.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, None, 3, 8}
    assert decontam.contaminated(nothing, bench).count() == 0
    assert decontam.contaminated(edges, bench.where("false")).count() == 0
    assert decontam.drop_contaminated(edges, bench.where("false")).count() == edges.count()


def test_items_that_repeat_a_phrase(llm_spark):
    """Few distinct seeds, many words: copies leak, documents with part of the repeats may not."""
    phrase = " ".join(WORDS[:10])
    chorus, word = " ".join([phrase] * 20), " ".join(["la"] * 20)
    own = " ".join(f"u{k}" for k in range(150))
    rows = [(1, f"x {chorus} y"), (2, f"x {word} y"), (3, " ".join([phrase] * 10)),
            (4, " ".join([phrase] * 9)), (5, " ".join(["la"] * 9)), (6, f"a {phrase} b {own[:60]}")]
    items = [(1, chorus), (2, word), (3, f"{own} {phrase}")]
    assert _leaks(llm_spark, rows, items) == {(1, 1): 1.0, (2, 2): 1.0, (3, 1): .5}


def test_seed_bound_drops_no_leak():
    rnd = random.Random(8)
    found = 0
    for _ in range(300):
        unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 6))]
        item = (unit * 30)[:rnd.randint(8, 60)] + [rnd.choice("abcde") for _ in range(rnd.randint(0, 12))]
        k = rnd.randint(0, len(item))
        doc = item[k:] + ["z"] + item[:k][rnd.randint(0, 8):]
        want = brute_tiles(item, doc, 5) / len(item)
        got = decontam.Seeds([(1, " ".join(item))], 5).judge(" ".join(doc), .5)
        assert [round(share, 9) for _, share, *_ in got] == [round(want, 9)] * (want >= .5)
        found += want >= .5
    assert found > 100
