"""Operator 2, benchmark decontamination by greedy string tiling.

The token n-grams (``min_match`` words) of the benchmark items are the seeds.
A document's n-grams are looked up among them; each (document, item) pair
whose seeds stand on enough of the item's words is tiled: the longest common
run of unmarked words is marked in both texts again and again, down to
``min_match`` words.  Runs are found by running Karp-Rabin: one pass over a
text gives the hashes of its word windows for every search length, and equal
hashes are compared word by word.  The share of an item's words that the tiles
cover is its coverage, so passages whose parts were reordered count in full.
A pair at ``threshold`` or more is a leak.

The benchmark goes to the tasks in blocks of at most ``block_chars``
characters, each a bounded broadcast; the corpus is read once per block.
Benchmarks up to that size, whatever the corpus, need one pass.  Nothing is
shuffled.

Defined cases: words are runs of visible characters, lower-cased, without
punctuation at their ends.  Null or empty texts, and items of fewer than
``min_match`` words, match nothing unless the item is a short one whose words
stand in a row in the document (its own length is then the least match).
Items without any word never match.  Repeated documents and items are judged
each.  Empty tables give an empty result.  Extra columns are ignored, or kept
by ``drop_contaminated``.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnlake.llm.common import read_table, ready

_EDGE = ".,;:!?\"'()[]{}<>*_#-"
_BASE = np.uint64(0x100000001B3)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def tokens(text: str | None) -> list[str]:
    return [w for w in (w.strip(_EDGE) for w in (text or "").lower().split()) if w]


class RunningHash:
    """Running Karp-Rabin hash of a word sequence, modulo 2**64.

    One pass keeps the running sum of ``ids[i] * BASE**-i`` (the base is odd, so
    it has an inverse).  The hash of a window of any length is then a difference
    of two sums, brought to the window's end by one power: nothing is hashed
    again for another length.  Equal hashes are still compared word by word.
    """

    def __init__(self, ids: np.ndarray):
        size = len(ids)
        self.powers = np.ones(size + 1, np.uint64)
        np.cumprod(np.full(size, _BASE, np.uint64), out=self.powers[1:])
        inverse = np.ones(size, np.uint64)
        np.cumprod(np.full(max(0, size - 1), _INVERSE, np.uint64), out=inverse[1:])
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(ids * inverse, out=self.sums[1:])

    def windows(self, n: int) -> np.ndarray:
        """The hash of every window of ``n`` words."""
        size = len(self.sums) - 1
        if size < n:
            return np.zeros(0, np.uint64)
        return (self.sums[n:] - self.sums[:size - n + 1]) * self.powers[n - 1:size]


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Running hash of every window of ``n`` word ids."""
    return RunningHash(ids).windows(n)


def greedy_tiles(item: list, doc: list, min_match: int) -> list[tuple[int, int, int]]:
    """Non-overlapping (item start, doc start, length), longest first.

    The search length is halved towards ``min_match``.  At each length, unmarked
    windows of the item are looked up by hash among the document's; equal
    windows grow to the next mark or mismatch and are taken longest first.
    """
    item_free, doc_free = [True] * len(item), [True] * len(doc)
    code: dict = defaultdict(lambda: len(code) + 1)
    a = np.array([code[w] for w in item], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.array([code[w] for w in doc], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    running_a, running_b = RunningHash(a), RunningHash(b)
    tiles: list[tuple[int, int, int]] = []
    length = min(len(item), len(doc))
    while length >= min_match:
        longest = 0
        ha, hb = running_a.windows(length), running_b.windows(length)
        places = defaultdict(list)
        for j in np.flatnonzero(np.isin(hb, ha)).tolist():
            places[hb[j]].append(j)
        found = []
        for i in np.flatnonzero(np.isin(ha, hb)).tolist():
            if not item_free[i]:
                continue
            for j in places[ha[i]]:
                if i and j and item_free[i - 1] and doc_free[j - 1] and item[i - 1] == doc[j - 1]:
                    continue  # not the start of its run
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item_free[i + n]
                       and doc_free[j + n] and item[i + n] == doc[j + n]):
                    n += 1
                if n >= length:
                    found.append((-n, i, j))
        again = False
        for n, i, j in sorted(found):
            n = -n
            if all(item_free[i:i + n]) and all(doc_free[j:j + n]):
                item_free[i:i + n], doc_free[j:j + n] = [False] * n, [False] * n
                tiles.append((i, j, n))
            else:
                again = True  # partly marked since: what is left may still be long enough
            longest = max(longest, n)
        if not again:
            length = min_match if length > min_match and length < 2 * min_match else (
                length // 2 if length > min_match else 0)
    return tiles


class Seeds:
    """The seed n-grams of one block of items."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        self.words = {k: tokens(text) for k, (_, text) in enumerate(items)}
        self.ids = [i for i, _ in items]
        self.least = {k: min(min_match, len(w)) for k, w in self.words.items() if w}
        self.code = {w: k + 1 for k, w in enumerate(sorted(set().union(*self.words.values(), set())))}
        self.lengths = sorted(set(self.least.values()))
        # per seed the items that hold it, and how often
        self.by_hash: dict[int, dict[int, list[tuple[int, int]]]] = {
            n: defaultdict(list) for n in self.lengths}
        for k, n in self.least.items():
            for h, times in Counter(window_hashes(self.encode(self.words[k]), n).tolist()).items():
                self.by_hash[n][h].append((k, times))
        self.sorted = {n: np.array(sorted(t), np.uint64) for n, t in self.by_hash.items()}

    def encode(self, words: list[str]) -> np.ndarray:
        get = self.code.get
        ids = np.array([get(w, 0) for w in words], np.uint64)
        return ids * np.uint64(0x9E3779B97F4A7C15)

    def seeded(self, words: list[str], threshold: float) -> list[int]:
        """Items whose seeds in the document could reach the threshold."""
        running = RunningHash(self.encode(words))
        hits: dict[int, list] = defaultdict(list)
        places: dict[int, int] = defaultdict(int)  # of an item, where a hit seed stands
        for n in self.lengths:
            h = running.windows(n)
            if not len(h):
                continue
            at = np.searchsorted(self.sorted[n], h)
            known = self.sorted[n][np.minimum(at, len(self.sorted[n]) - 1)] == h
            for x in set(h[known].tolist()):
                for k, times in self.by_hash[n][x]:
                    hits[k].append(x)
                    places[k] += times
        # a place covers at most the seed's words; what survives that is marked word by word
        return [k for k, xs in hits.items()
                if places[k] * self.least[k] / len(self.words[k]) >= threshold
                and self.reach(k, xs) >= threshold]

    def reach(self, k: int, hits: list[int]) -> float:
        """Share of the item's words under any occurrence of the seeds: no tiling covers more."""
        n, words = self.least[k], self.words[k]
        at = np.flatnonzero(np.isin(window_hashes(self.encode(words), n), np.array(hits, np.uint64)))
        edges = np.zeros(len(words) + 1, np.int64)
        edges[at] += 1
        np.subtract.at(edges, at + n, 1)
        return np.count_nonzero(np.cumsum(edges[:-1])) / len(words)

    def judge(self, text: str | None, threshold: float) -> list[tuple[int, float, int, int]]:
        words = tokens(text)
        out = []
        for k in self.seeded(words, threshold):
            tiles = greedy_tiles(self.words[k], words, self.least[k])
            covered = sum(n for _, _, n in tiles)
            share = covered / len(self.words[k])
            if share >= threshold:
                out.append((self.ids[k], share, covered, len(tiles)))
        return out


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``block_chars`` characters (one item at least)."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = row.text or ""
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5,
                 min_match: int = 5, block_chars: int = 8 << 20) -> DataFrame:
    """(doc_id, item_id, coverage, matched_words, tiles) of every leak."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, coverage double, matched_words long, tiles long"
    texts = docs.select("doc_id", "text")
    out = None
    for block in _blocks(benchmark, block_chars):
        part = texts.mapInPandas(_leaks(spark.sparkContext.broadcast(block), threshold, min_match),
                                 schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _leaks(shared, threshold: float, min_match: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seeds = Seeds(shared.value, min_match)
        for batch in batches:
            rows = [(d, *leak) for d, t in zip(batch["doc_id"], batch["text"])
                    for leak in seeds.judge(t, threshold)]
            frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "coverage", "matched_words",
                                                "tiles"])
            yield frame.astype({"doc_id": "Int64", "item_id": "Int64", "coverage": float,
                                "matched_words": "int64", "tiles": "int64"})
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5,
                      min_match: int = 5, block_chars: int = 8 << 20) -> DataFrame:
    """``docs`` without the documents that leak an item, all columns kept."""
    spark = docs.sparkSession
    schema: StructType = docs.schema
    for block in _blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            import pyarrow as pa

            seeds = Seeds(shared.value, min_match)
            for batch in batches:
                clean = [not seeds.judge(t, threshold) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    ready(spark)
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that leak a benchmark item go."""
    ready(spark)
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))
