"""Operator 5: minimax contiguous partition."""

import random
from collections import Counter, defaultdict
from zlib import crc32

from tests.llm.conftest import documents
from txnlake.llm import sharding


def least(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, runs, held = (low + high) // 2, 1, 0
        for s in sizes:
            if held + s > mid:
                runs, held = runs + 1, 0
            held += s
        low, high = (low, mid) if runs <= shards else (mid + 1, high)
    return low


class Listed(sharding.Borders):
    """Borders of a list instead of a table."""

    def __init__(self, borders, rows):
        self.list, self.total, self.rows, self.reads = borders, borders[-1], rows, 0
        self.width = self.total
        self.read([(0, self.total)])

    def read(self, spans):
        self.reads += 1
        width = self.width = max(1, min(-(-sum(b - a + 1 for a, b in spans) // self.rows),
                                        self.width // 2))
        buckets = defaultdict(list)
        for x in self.list:
            if any(a <= x <= b for a, b in spans):
                buckets[x // width].append(x)
        marks = {(min(v), max(v), len(v)) for v in buckets.values()}
        edges = {0, self.total} | {x for a, b in spans for x in (self.lookup(a, True), self.lookup(b, False))}
        marks |= {(e, e, 1) for e in edges if not any(lo <= e <= hi for lo, hi, _ in marks)}
        self.lo, self.hi, n = map(list, zip(*sorted(marks)))
        self.fine = [x <= 2 for x in n]

    def lookup(self, at, below):
        if at <= 0 or at >= self.total:
            return 0 if at <= 0 else self.total
        return max((x for x in self.list if x <= at), default=0) if below else \
            min(x for x in self.list if x >= at)


def test_capacity_is_minimal_with_a_coarse_summary():
    rnd = random.Random(5)
    reads = 0
    for _ in range(300):
        sizes = [rnd.choice([1, rnd.randint(1, 50), rnd.randint(1, 3000)]) for _ in range(rnd.randint(1, 200))]
        if rnd.random() < .3:
            sizes[rnd.randrange(len(sizes))] = sum(sizes) // 3 + 1
        shards, borders = rnd.choice([1, 2, 3, 16]), []
        for s in sizes:
            borders.append((borders[-1] if borders else 0) + s)
        b = Listed(borders, rnd.choice([8, 20, 50]))
        capacity = sharding.least_capacity(b, max(sizes), shards)
        assert capacity == least(sizes, shards)
        cuts = sharding.balanced_cuts(b, capacity, shards)
        assert cuts[-1] == borders[-1] and set(cuts) <= {0, *borders}
        assert all(0 <= y - x <= capacity for x, y in zip([0, *cuts], cuts))
        reads = max(reads, b.reads)
    assert reads > 1  # refinement was needed


def test_groups_sizes_and_slots(llm_spark):
    rnd = random.Random(6)
    rows = [(k, "é" * rnd.randint(0, 40)) for k in range(200)] + [(500 + k, "copies of this") for k in range(90)]
    rows += [(None, None), (900, None), (901, ""), (902, ""), (902, "")]
    out = sharding.shard_by_bytes(documents(llm_spark, rows), 16, summary_rows=20).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 1, None if t is None else crc32(t.encode())) for d, t in rows)
    slots, shards, size = defaultdict(list), defaultdict(set), Counter()
    for r in out:
        slots[r.shard].append(r.slot)
        shards[bytes(r.th)].add(r.shard)
        size[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    groups = defaultdict(int)
    first = {}
    for d, t in rows:
        groups[t] += len((t or "").encode()) + 1
        first[t] = min(first.get(t, 10**9), -1 if d is None else d)
    assert max(size.values()) == least([groups[t] for t in sorted(groups, key=lambda t: (first[t], str(t)))], 16)


def test_empty(nothing):
    assert sharding.shard_by_bytes(nothing).count() == 0
